"""Keep-first deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order; null is a key value like others.

    ``row_number() = 1`` lets Spark put a WindowGroupLimit before the shuffle,
    so a map task sends at most one row per key: a hot key arrives as one row
    per task, however many rows it has.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_position", F.row_number().over(first))
            .where(F.col("_position") == 1).drop("_position"))


def keep_first_marked(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
                      again: str) -> DataFrame:
    """As keep_first, with a boolean column that says whether more rows of the key follow.

    A map task sends at most two rows per key for that.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_position", F.row_number().over(first)).where(F.col("_position") <= 2)
            .withColumn(again, F.lead("_position").over(first).isNotNull())
            .where(F.col("_position") == 1).drop("_position"))


def keep_first_identified(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """As keep_first, but rows with a null key are all kept.

    Those rows get their own position as a second key, so they spread over
    the shuffle instead of meeting in one null group.
    """
    own = F.when(F.col(key).isNull(), F.struct(*order))
    return keep_first(df, [F.col(key), own], order)
