"""Stable ids: UUID version 5 out of built-in SHA-1."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F

# The id namespaces.
HN_NAMESPACE = uuid.UUID("8f0f9f6b-4c3c-4f4a-9d2a-6c4c8f1f3b21")
X_USER_NAMESPACE = uuid.UUID("5c8533ab-54d8-5d3f-ace6-f9315930dbda")
X_POST_NAMESPACE = uuid.UUID("2d1e9ea0-3d02-5df9-a537-224ccac256db")


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """RFC 9562 version 5: SHA-1 of namespace and name, version and variant set.

    ``translate`` turns the first nibble of the clock field into its variant
    form (binary 10xx).
    """
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), name.cast("binary")))

    def piece(start: int, length: int) -> Column:
        return F.substring(digest, start, length)

    variant = F.translate(piece(17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(piece(1, 8), F.lit("-"), piece(9, 4), F.lit("-5"), piece(14, 3), F.lit("-"),
                    variant, piece(18, 3), F.lit("-"), piece(21, 12))


def hn_id(value: Column) -> Column:
    """Id of an HN user name or post id; both share one namespace."""
    return uuid5(HN_NAMESPACE, F.concat(F.lit("HackerNews|"), value))


def x_post_id(source_id: Column) -> Column:
    return uuid5(X_POST_NAMESPACE, F.concat(F.lit("X:"), F.when(source_id != "", source_id)))


def x_user_id(source_id: Column, username: Column) -> Column:
    """By source id when there is one, else by name, else null."""
    name = F.coalesce(F.concat(F.lit("X:"), source_id), F.concat(F.lit("X:username:"), username))
    return uuid5(X_USER_NAMESPACE, name)
