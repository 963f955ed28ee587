"""Sharding by a permutation-filled lookup table (Maglev hashing)."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode("utf-8")).digest()[:7], "big")


def lookup_table(shards: Sequence[str], size: int) -> list[int]:
    """slot -> index of its shard. ``size`` is a prime above the number of shards.

    Every shard prefers the slots in an order of its own, offset + k * skip
    modulo the size. The shards take turns, each claiming the first free slot of
    its order, until no slot is free.
    """
    if not 0 < len(shards) < size or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("size must be a prime above the number of shards")
    if len(set(shards)) != len(shards):
        raise ValueError("shard names must differ")
    slot = [_number(f"{name}/offset") % size for name in shards]
    skip = [_number(f"{name}/skip") % (size - 1) + 1 for name in shards]
    owner, free = [-1] * size, size
    while free:
        for shard in range(min(len(shards), free)):
            while owner[slot[shard]] >= 0:
                slot[shard] = (slot[shard] + skip[shard]) % size
            owner[slot[shard]] = shard
            free -= 1
    return owner


def slot_of(key: Column, size: int) -> Column:
    """The slot of a key: 60 bits of its MD5 modulo the table size; a null key is the empty string."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % size


def shard_rows(rows: DataFrame, key_column: str, shards: Sequence[str], size: int = 65_537) -> DataFrame:
    """``rows`` with the columns ``slot`` and ``shard`` (columns of those names are replaced).

    The table has ``size`` small rows, whatever the data, so it is broadcast:
    one lookup places a row, and the rows are never shuffled. Rows with equal
    keys share a shard, so place by a key that is spread, such as the id. A null
    key is placed like the empty string. Adding or removing a shard moves few
    keys but its own.
    """
    spark: SparkSession = rows.sparkSession
    owners = F.split(F.lit(",".join(map(str, lookup_table(shards, size)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    table = spark.range(size).select(
        F.col("id").alias("__slot"),
        F.get(names, F.get(owners, F.col("id").cast("int")).cast("int")).alias("__shard"))
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("slot", "shard")]
    placed = rows.withColumn("__slot", slot_of(F.col(f"`{key_column}`"), size))
    return placed.join(F.broadcast(table), "__slot").select(
        *kept, F.col("__slot").alias("slot"), F.col("__shard").alias("shard"))
