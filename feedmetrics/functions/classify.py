"""Post, tag and relation types."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from feedmetrics.functions.text import strip
from feedmetrics.schemas import HN_ITEM_TYPES

# Which marker tag wins, and the type it stands for.
HN_TYPE_PRIORITY = (("comment", "comment"), ("job", "job"), ("poll", "poll"),
                    ("ask_hn", "ask"), ("story", "story"))
# Tag prefixes that point at another object.
HN_TAG_PREFIXES = (("author_", "author"), ("story_", "story_reference"),
                   ("comment_", "comment_reference"), ("poll_", "poll_reference"),
                   ("job_", "job_reference"))
# Reference types in priority order, with the post type they give.
X_REFERENCE_TYPES = (("retweeted", "retweet"), ("replied_to", "reply"), ("quoted", "quote"))


def _first_match(rules, default: str | None = None) -> Column:
    """CASE over (condition, value) rules."""
    result = F
    for condition, value in rules:
        result = result.when(condition, F.lit(value))
    return result if default is None else result.otherwise(F.lit(default))


def hn_type_from_tags(tags: Column) -> Column:
    """Item type by marker tag, null when no marker is present."""
    return _first_match((F.array_contains(tags, tag), kind) for tag, kind in HN_TYPE_PRIORITY)


def hn_post_type(item_type: Column, tags: Column) -> Column:
    """The landed type when it is a known one, else by tag, else unknown."""
    return F.coalesce(F.when(item_type.isin(*HN_ITEM_TYPES), item_type),
                      hn_type_from_tags(tags), F.lit("unknown"))


def hn_tag_type(tag: Column) -> Column:
    rules = [(tag.isin(*HN_ITEM_TYPES, "ask_hn"), "post_type")]
    rules += [(tag.startswith(prefix), kind) for prefix, kind in HN_TAG_PREFIXES]
    return _first_match(rules, "hn_tag")


def x_post_type(reference_types: Column) -> Column:
    """From the raw reference types of a post; no trimming, case matters."""
    return _first_match(((F.array_contains(reference_types, raw), kind)
                         for raw, kind in X_REFERENCE_TYPES), "tweet")


def x_relation_type(raw: Column) -> Column:
    """Trimmed, lower-cased reference type if it is a known one, else null."""
    value = F.lower(strip(raw))
    return F.when(value.isin(*(name for name, _ in X_REFERENCE_TYPES)), value)
