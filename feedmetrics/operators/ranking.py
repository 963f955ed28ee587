"""Ranking within groups: top-k, and complete rankings of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group, numbered 1..k in ``rank``.

    The filter on row_number becomes a WindowGroupLimit ahead of the shuffle: a
    task sends at most k rows of a group, so the size of a group does not
    matter. Spark does that up to spark.sql.optimizer.windowGroupLimitThreshold
    rows; for rankings that may be longer there is ``rank_by_count``.
    """
    window = Window.partitionBy(*groups).orderBy(*order)
    return (df.withColumn("rank", F.row_number().over(window).cast("bigint"))
            .where(F.col("rank") <= k))


def rank_by_count(df: DataFrame, groups: Sequence[str], count: str, tie: str,
                  prefixes: Sequence[int] = (2, 6)) -> DataFrame:
    """Every row numbered in its group, by falling ``count``, then falling ``tie`` text, without a sort of the group.

    A window over the group would sort all of a day's tags in one task. Ranks
    are counted instead. A histogram of the counts says how many rows come
    before those with the same count; within a count, histograms of the tie
    text's first characters, a few at first and then more, say how many come
    before those that begin alike. Only rows of the same count that share the
    longest prefix are sorted together. So the many tags that occur once are
    spread by how they begin. The text must not be null, and a text may occur
    once with a count, or equal rows are numbered either way.

    Building the ranking runs nothing; the rows are shuffled once, for the last
    histogram and the sort alike.
    """
    keys = [f"_p{length}" for length in prefixes]
    rows = df.withColumns({key: F.substring(tie, 1, length) for key, length in zip(keys, prefixes)})
    levels, own = [*groups, count], [*groups, count, *keys]
    finest = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
    offsets = finest
    for level in range(len(keys) + 1):
        within, by = ([*groups], count) if level == 0 else ([*levels, *keys[:level - 1]], keys[level - 1])
        # One row for each value of ``by``: as many as there are counts, or ways to go on by a few characters.
        sizes = finest.groupBy(*within, by).agg(F.sum("_n").alias("_size"))
        before = Window.partitionBy(*within).orderBy(F.desc(by)).rowsBetween(Window.unboundedPreceding, -1)
        sizes = sizes.select(*(F.col(name).alias(f"_of_{name}") for name in [*within, by]),
                             F.coalesce(F.sum("_size").over(before), F.lit(0)).alias(f"_before{level}"))
        offsets = _same(offsets, sizes, [*within, by])
    earlier = sum((F.col(f"_before{level}") for level in range(len(keys) + 1)), F.lit(0))
    offsets = offsets.select(*(F.col(name).alias(f"_of_{name}") for name in own), earlier.alias("_earlier"))
    order = Window.partitionBy(*own).orderBy(F.desc(tie))
    placed = rows.withColumn("_place", F.row_number().over(order))
    return _same(placed, offsets, own).withColumn("rank", F.col("_place") + F.col("_earlier")).select(
        *df.columns, "rank")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Joins on equal values, null with null; the right side names them ``_of_...``, which go."""
    same = F.lit(True)
    for name in names:
        same &= F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    return left.join(right, same).drop(*(f"_of_{name}" for name in names))


def presentation_order(df: DataFrame) -> DataFrame:
    """Date, then rank where there is one. For display only: it sorts globally."""
    return df.orderBy(*(name for name in ("date", "rank") if name in df.columns))
