"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.base import staged, text_of
from feedmetrics.llm.components import connected

SEED = 42


def fingerprint(text: str, words_each: int = 3) -> int:
    """64 bits: each is set if over half of the shingle hashes have it set. No word: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < words_each:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(words_each)))))
    ones, step = np.zeros(64, dtype=np.int64), 1 << 16
    for at in range(0, len(shingles), step):
        part = shingles[at:at + step]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in part), dtype=">u8", count=len(part))
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 words_each: int = 3) -> DataFrame:
    """(doc_id, bits): the fingerprint as a bigint, for every row."""

    @F.pandas_udf("bigint")
    def bits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, words_each) for t in batch], dtype="int64")

    return docs.select(F.col(id_column).alias("doc_id"), bits(text_of(text_column)).alias("bits"))


def _segments(bits: Column) -> list[Column]:
    return [F.shiftrightunsigned(bits, 32), bits.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint"))]


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b) of different values of ``bits`` that differ in at most ``max_bits`` of 64 bits.

    The fingerprint has two segments of 32 bits. At most three differing bits
    leave one segment with at most one of them, so each segment's table is
    probed with the ball of radius one around the segment. Of two segments that
    differ in one bit, one has a zero there: flipping zeros alone finds the pair
    from that side, with half the probes. The complete distance is part of the
    join condition, so no other candidate leaves the join.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments with balls of radius one find distances up to 3")
    masks = [F.lit(1 << bit).cast("bigint") for bit in range(32)]
    entry, probe = [], []
    for number, segment in enumerate(_segments(F.col("bits"))):
        entry.append(F.struct(F.lit(number).alias("segment"), segment.alias("key")))
        zeros = [F.struct(F.lit(number).alias("segment"), F.when(segment.bitwiseAND(mask) == 0, segment.bitwiseXOR(
            mask)).alias("key"), F.lit(False).alias("same")) for mask in masks]
        own = F.struct(F.lit(number).alias("segment"), segment.alias("key"), F.lit(True).alias("same"))
        probe += [own, *zeros]
    entries = distinct.select(F.col("bits").alias("b"), F.inline(F.array(*entry)))
    probes = distinct.select(F.col("bits").alias("a"), F.inline(F.array(*probe))).filter("key IS NOT NULL")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    once = ~F.col("same") | (F.col("a") < F.col("b"))
    found = probes.join(entries, (probes["segment"] == entries["segment"]) & (probes["key"] == entries["key"])
                        & near & once)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_each: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Equal fingerprints count once in the search, so exact and near copies that
    share one cost nothing however many they are. Components of the link graph
    are found by rounds of joins; the driver sees only their sizes.

    A null text is empty, and the zero fingerprint of a text without words links
    like any other. ``component_id`` is the smallest id reachable, null only
    where no row of the component has an id. Repeated rows each get a row; an
    empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    prints = staged(spark, fingerprints(docs, id_column, text_column, words_each), "simhash-prints")
    groups = staged(spark, prints.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "simhash-groups")
    roots = connected(spark, links(groups.select("bits"), max_bits))
    rooted = groups.join(roots, groups["bits"] == roots["node"], "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), "first_id")
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(firsts, "root").select("bits", "component_id")
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return prints.join(labels, "bits").select("doc_id", digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_each: int = 3,
                max_bits: int = 3) -> DataFrame:
    """The documents that stay when one of each component does: the one with the smallest id.

    Rows that share an id stand or fall together. Rows without an id stay only
    where their component has no id at all.
    """
    found = near_duplicates(docs, id_column, text_column, words_each, max_bits)
    stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("__stays")).distinct()
    return docs.join(stay, F.col(f"`{id_column}`").eqNullSafe(F.col("__stays")), "left_semi")
