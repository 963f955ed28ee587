"""Exact deduplication: 128-bit content hash groups, checked byte by byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.base import staged, text_of


def content_hash(text: Column) -> Column:
    """MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def _winner(keep: str) -> Column:
    if keep == "largest":
        return F.max(F.struct("doc_id", "row"))
    if keep == "smallest":
        return F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    raise ValueError("keep is 'smallest' or 'largest'")


def _decided(members: DataFrame, groups: DataFrame, keep: str, key: list[str]) -> DataFrame:
    """members(doc_id, row, *key) and groups(*key, text_sha256) -> one decision per member."""
    winners = members.groupBy(*key).agg(_winner(keep).alias("winner"), F.count(F.lit(1)).alias("group_size"))
    return members.join(winners.join(groups, key), key).select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest",
                     hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by a 128-bit hash of the text. Aggregating by hash *and*
    text compares the bytes inside each group, and combines copies in the map
    tasks, so a text that a third of all rows repeat is shuffled once per task.
    Groups whose hash stands for more than one text (a collision) are decided
    again by their text.

    A null text is the empty text. A null id is never preferred to another one.
    Of rows that repeat both the text and the id that stays, exactly one is
    ``kept``. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    rows = rows.withColumn("hash", hashed(F.col("text")))
    members = staged(spark, rows.select("doc_id", "hash", F.monotonically_increasing_id().alias("row")), "dedup-rows")
    texts = rows.groupBy("hash", "text").agg(F.count(F.lit(1)).alias("copies"))
    texts = staged(spark, texts.select("hash", F.sha2("text", 256).alias("text_sha256")), "dedup-texts")
    collided = texts.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("hash")
    collided = staged(spark, collided, "dedup-collisions")
    if collided.isEmpty():
        return _decided(members, texts, keep, ["hash"])
    apart = rows.join(collided, "hash").select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    apart = staged(spark, apart, "dedup-collided")
    digests = apart.select("text").distinct().withColumn("text_sha256", F.sha2("text", 256))
    return _decided(members.join(collided, "hash", "left_anti"), texts, keep, ["hash"]).unionByName(
        _decided(apart, digests, keep, ["text"]))


def distinct_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       keep: str = "smallest") -> DataFrame:
    """The rows that stay, whole: one for each text, by the rules of ``exact_duplicates``.

    Hash and bytes of the text are the grouping key again; the row of the chosen
    id travels through the aggregation, so no join by id can bring a copy back.
    """
    pick = {"largest": F.max_by, "smallest": F.min_by}[keep]
    key = F.struct(text_of(text_column).alias("text"))
    order = F.col(id_column)
    if keep == "smallest":
        order = F.struct(order.isNull().alias("no_id"), order.alias("id"))
    else:
        order = F.struct(order.alias("id"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key["text"].alias("text"),
                        content_hash(key["text"]).alias("hash"), order.alias("order"))
    return whole.groupBy("hash", "text").agg(pick("row", "order").alias("row")).select("row.*")
