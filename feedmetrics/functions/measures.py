"""Numbers and stamps computed from a row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ENGAGEMENT_FIELDS = ("like_count", "retweet_count", "reply_count", "quote_count")


def engagement() -> Column:
    """Sum of the four interaction counts, a missing one counting as zero."""
    total = F.lit(0).cast("bigint")
    for name in ENGAGEMENT_FIELDS:
        total = total + F.coalesce(F.col(name), F.lit(0))
    return total


def latest_stamp(*stamps: Column) -> Column:
    """The latest of the given stamps; null only when all are null."""
    return F.greatest(*stamps)
