"""Trie of conversation prefixes: node tables behind minimal perfect hashes of prefix digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedmetrics.llm.base import staged, text_of

ROOT = bytes(16)
KEY = ["hi", "lo"]


def numbered(conversations: DataFrame, id_column: str = "conv_id", turn_column: str = "turn",
             role_column: str = "role", text_column: str = "text") -> DataFrame:
    """(conv_id, nth, digest, bytes): each turn's place in its conversation, digest of role and text, text bytes."""
    turns = conversations.filter(F.col(f"`{id_column}`").isNotNull()).select(
        F.col(id_column).cast("bigint").alias("conv_id"), F.col(turn_column).alias("turn"),
        text_of(role_column).alias("role"), text_of(text_column).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # The role's length keeps (role, text) apart from other cuts of the same characters.
    content = F.concat(F.octet_length("role").cast("string"), F.lit("/"), "role", "text")
    return turns.select("conv_id", F.row_number().over(order).alias("nth"), F.unhex(F.md5(content)).alias("digest"),
                        F.octet_length("text").cast("bigint").alias("bytes"))


def shared_openings(turns: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """``turns`` rebuilt: conversation c takes its first h turns from conversation c - c % ``every``.

    h is the unsigned crc32 of the decimal c, modulo ``most``. All turns of the
    other conversation are taken if it has fewer, none if it is not there; c's
    own turns follow from its h-th on. At most ``most - 1`` turns are taken by at
    most ``every`` conversations, so the join stays in proportion.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % most
    own = turns.filter(F.col("nth") > h)
    opening = turns.filter((F.col("conv_id") % every == 0) & (F.col("nth") < most)).withColumnRenamed(
        "conv_id", "base")
    takers = turns.select("conv_id").distinct().withColumn("h", h).withColumn(
        "base", F.col("conv_id") - F.col("conv_id") % every)
    taken = takers.join(opening, "base").filter("nth <= h").select(*own.columns)
    return own.unionByName(taken)


PATHS = ("conv_id bigint, hi bigint, lo bigint, parent_hi bigint, parent_lo bigint, depth bigint, bytes bigint, "
         "below bigint")


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by conversation and place -> the digest of each prefix, chained, and of the prefix one turn shorter."""
    conversation, chain, depth = None, ROOT, 0
    for batch in batches:
        own, parents, depths = [], [], []
        for conv_id, digest in zip(batch["conv_id"].tolist(), batch["digest"]):
            if conv_id != conversation:
                conversation, chain, depth = conv_id, ROOT, 0
            parents.append(chain)
            chain, depth = hashlib.md5(chain + digest).digest(), depth + 1
            own.append(chain)
            depths.append(depth)
        if own:
            keys, above = _halves(own), _halves(parents)
            yield pd.DataFrame({
                "conv_id": batch["conv_id"], "hi": keys[:, 0], "lo": keys[:, 1], "parent_hi": above[:, 0],
                "parent_lo": above[:, 1], "depth": depths, "bytes": batch["bytes"],
                "below": batch["turns"] - np.array(depths)})


class SlotTable:
    """Minimal perfect hash of distinct 128-bit digests: n digests have the slots 0 to n - 1.

    On each level the digests left are hashed to twice as many places; those
    alone on theirs stay. A digest's slot is the rank of its place among the
    places taken. Each slot keeps its digest, so a digest that is not in the
    table is told from the one whose slot it hits.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.places, self.taken, start = [], [], 0
        left = np.arange(len(hi))
        while len(left):
            size = 2 * len(left)
            place = self._place(hi[left], lo[left], len(self.places), size)
            alone = np.bincount(place, minlength=size) == 1
            self.places.append((start, size))
            self.taken.append(alone)
            start += size
            left = left[~alone[place]]
            if len(self.places) > 200:
                raise ValueError("the same digest twice")
        self.taken = np.concatenate([np.zeros(0, dtype=bool), *self.taken])
        self.rank = np.cumsum(self.taken) - 1
        self.hi, self.lo = np.zeros(len(hi), dtype=np.int64), np.zeros(len(hi), dtype=np.int64)
        slots = self._slots(hi, lo)
        self.hi[slots], self.lo[slots] = hi, lo

    @staticmethod
    def _place(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        x = hi.astype(np.uint64) * np.uint64(2 * level + 1) + lo.astype(np.uint64)
        x = (x ^ (x >> np.uint64(31)) ^ np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        return ((x >> np.uint64(16)) % np.uint64(size)).astype(np.int64)

    def _slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        slots = np.full(len(hi), -1, dtype=np.int64)
        for level, (start, size) in enumerate(self.places):
            open_ = np.flatnonzero(slots < 0)
            place = start + self._place(hi[open_], lo[open_], level, size)
            slots[open_] = np.where(self.taken[place], self.rank[place], -1)
        return slots

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for those that are not in the table."""
        slots = self._slots(hi, lo)
        known = slots >= 0
        known[known] = (self.hi[slots[known]] == hi[known]) & (self.lo[slots[known]] == lo[known])
        return np.where(known, slots, -1)


def subtree_sums(shard: pd.DataFrame) -> pd.DataFrame:
    """Whole subtrees: (hi, lo, parent_hi, parent_lo, depth, leaves, saved) -> the sums over each node's subtree."""
    given = {c: shard[c].to_numpy(dtype=np.int64) for c in shard.columns if c != "shard"}
    table = SlotTable(given["hi"], given["lo"])
    slot = table.slots(given["hi"], given["lo"])
    parent, depth, leaves, saved = (np.zeros(len(slot), dtype=np.int64) for _ in range(4))
    parent[slot] = table.slots(given["parent_hi"], given["parent_lo"])
    depth[slot], leaves[slot], saved[slot] = given["depth"], given["leaves"], given["saved"]
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        inner = level[parent[level] >= 0]
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])
    return pd.DataFrame({"hi": table.hi, "lo": table.lo, "leaves": leaves, "saved": saved})


SUMS = "hi bigint, lo bigint, leaves bigint, saved bigint"


def _crown_sums(crown: DataFrame) -> DataFrame:
    """As ``subtree_sums`` for a tree of any size: each round doubles how far below a node its sums reach."""
    spark = crown.sparkSession
    state = staged(spark, crown.select(*KEY, "leaves", "saved", F.col("parent_hi").alias("up_hi"),
                                       F.col("parent_lo").alias("up_lo")), "trie-crown")
    while not (moving := state.filter("up_hi IS NOT NULL")).isEmpty():
        add = moving.groupBy(F.col("up_hi").alias("hi"), F.col("up_lo").alias("lo")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        above = state.select(F.col("hi").alias("up_hi"), F.col("lo").alias("up_lo"), F.col("up_hi").alias("next_hi"),
                             F.col("up_lo").alias("next_lo"))
        state = staged(spark, state.join(add, KEY, "left").join(above, ["up_hi", "up_lo"], "left").select(
            *KEY, (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            F.col("next_hi").alias("up_hi"), F.col("next_lo").alias("up_lo")), "trie-crown")
    return state.select(*KEY, "leaves", "saved")


def _end_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by node and bucket -> a SHA-256 per node; only the hash's state is held, however many rows a node has."""
    node, state = None, None
    for batch in batches:
        done = []
        for hi, lo, ids in zip(batch["hi"].tolist(), batch["lo"].tolist(), batch["ids"]):
            if (hi, lo) == node:
                state.update(b",")
            else:
                if node:
                    done.append((*node, state.hexdigest()))
                node, state = (hi, lo), hashlib.sha256()
            state.update(ids.encode())
        yield pd.DataFrame(done, columns=["hi", "lo", "ends_sha256"])
    if node:
        yield pd.DataFrame([(*node, state.hexdigest())], columns=["hi", "lo", "ends_sha256"])


def prefix_nodes(turns: DataFrame, conversations: DataFrame, shard_nodes: int = 1 << 14) -> DataFrame:
    """One row per distinct prefix of a conversation, from turns(conv_id, nth, digest, bytes).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. ``conversations`` holds all
    distinct ids, so those without turns count for the root.

    A prefix is known by the digest of its turns' digests, chained. Distinct
    digests are counted by a combined aggregate. A node of one conversation ends
    in a path that needs no sums. The others have a weight, the turns that their
    conversations have from there on, which bounds their subtree. Subtrees of at
    most ``shard_nodes`` are dealt into shards; a shard gives its digests slots
    by a minimal perfect hash, scatters counts into flat arrays and adds them up
    along parent slots in depth order. The nodes above, at most (turns /
    ``shard_nodes``) for each depth, are summed by rounds of joins that double
    their reach, so a very common first turn, or two equal conversations of any
    length, need no task of their own.

    A node's ends are hashed one after the other, as the digest asks: strings of
    up to 4,096 ids each are made in parallel, and the task that hashes them
    holds one at a time.
    """
    spark = turns.sparkSession
    length = F.count(F.lit(1)).over(Window.partitionBy("conv_id").orderBy("nth").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    rows = turns.withColumn("turns", length).sortWithinPartitions("conv_id", "nth")
    paths = staged(spark, rows.select("conv_id", "digest", "bytes", "turns").mapInPandas(_paths, PATHS), "trie-paths")

    zero = F.lit(0).cast("bigint")
    nodes = paths.groupBy(*KEY).agg(
        F.min("parent_hi").alias("parent_hi"), F.min("parent_lo").alias("parent_lo"), F.min("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("bytes"),
        F.sum(F.col("below") + 1).alias("weight"))
    nothing = F.lit(None).cast("bigint")
    members = conversations.select("conv_id", F.lit(1).alias("n"), F.lit(0).alias("turns")).unionByName(
        paths.agg(nothing.alias("conv_id"), F.lit(0).alias("n"), F.count(F.lit(1)).alias("turns")))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"),
                       F.sum("turns").alias("turns")).filter("n_convs > 0")
    root = root.select(zero.alias("hi"), zero.alias("lo"), nothing.alias("parent_hi"), nothing.alias("parent_lo"),
                       zero.alias("depth"), "conv_id", "n_convs", zero.alias("bytes"),
                       (F.col("turns") + F.col("n_convs")).alias("weight"))
    nodes = staged(spark, nodes.unionByName(root), "trie-nodes")

    above = [F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")]
    children = nodes.filter("parent_hi IS NOT NULL").groupBy(*above).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single"))
    parents = nodes.select(F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"),
                           F.col("conv_id").alias("parent_conv_id"), F.col("weight").alias("parent_weight"))
    info = nodes.join(children, KEY, "left").join(parents, ["parent_hi", "parent_lo"], "left")
    n_children = F.coalesce("n_children", zero)
    # Children of one conversation each are paths: they bring a leaf and save nothing.
    info = staged(spark, info.select(
        *KEY, "parent_hi", "parent_lo", "depth", "conv_id", "parent_conv_id", "n_convs",
        n_children.alias("n_children"), (F.col("n_convs") > 1).alias("common"),
        (F.col("weight") > shard_nodes).alias("heavy"),
        F.coalesce(F.col("parent_weight") > shard_nodes, F.lit(True)).alias("under_heavy"),
        (F.coalesce("single", zero) + (n_children == 0).cast("bigint")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "trie-info")

    light = info.filter("common AND NOT heavy")
    # All members of a node pass the same top of a light subtree, so its smallest member tells which.
    tops = light.filter("under_heavy").select(*KEY)
    passing = paths.select("conv_id", *KEY).unionByName(
        conversations.select("conv_id", zero.alias("hi"), zero.alias("lo")))
    passed = passing.join(tops, KEY)
    shards = max(1, -(-light.count() // shard_nodes))
    passed = passed.select("conv_id", F.pmod(F.xxhash64(*KEY), F.lit(shards)).alias("shard"))
    dealt = light.select(*KEY, "parent_hi", "parent_lo", "depth", "leaves", "saved", "conv_id").join(
        passed, "conv_id").drop("conv_id")
    dealt = dealt.fillna({"parent_hi": 0, "parent_lo": 1})  # above the root: no digest of a prefix
    summed = staged(spark, dealt.groupBy("shard").applyInPandas(subtree_sums, SUMS), "trie-sums")

    brought = light.filter("under_heavy AND parent_hi IS NOT NULL").select(*KEY, "parent_hi", "parent_lo").join(
        summed, KEY).groupBy(*above).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    crown = info.filter("heavy AND common").join(brought, KEY, "left").select(
        *KEY, "parent_hi", "parent_lo", (F.col("leaves") + F.coalesce("more_leaves", zero)).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", zero)).alias("saved"))
    sums = summed.unionByName(_crown_sums(crown)).select(*KEY, F.col("leaves").alias("all_leaves"),
                                                         F.col("saved").alias("all_saved"))

    ends = paths.filter("below = 0").select(*KEY, "conv_id")
    turnless = conversations.select("conv_id").join(paths.select("conv_id").distinct(), "conv_id", "left_anti")
    ends = ends.unionByName(turnless.select(zero.alias("hi"), zero.alias("lo"), "conv_id"))
    chunks = ends.groupBy(*KEY, F.shiftright("conv_id", 12).alias("bucket")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")), ",").alias("ids"))
    hashed = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "bucket").mapInPandas(
        _end_digests, "hi bigint, lo bigint, ends_sha256 string")

    found = info.join(sums, KEY, "left").join(hashed, KEY, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.when(F.col("common"), F.col("all_leaves")).otherwise(F.lit(1)).cast("bigint").alias("n_leaves"),
        F.when(F.col("common"), F.col("all_saved")).otherwise(zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame, every: int = 5, most: int = 9, shard_nodes: int = 1 << 14) -> DataFrame:
    """The prefix trie of conversations(conv_id, turn, role, text) whose openings are shared (``shared_openings``).

    Turns are ordered by turn, null first, ties by role and text. A null role or
    text is empty, and a turn without text is a turn. Rows without conv_id belong
    to no conversation and are left out. Repeated rows are turns of their own.
    A conversation whose turns are all left out by the rebuilding is a member of
    the root. An empty table gives an empty result, without a root; other
    columns are ignored.
    """
    spark = conversations.sparkSession
    turns = staged(spark, numbered(conversations), "trie-turns")
    return prefix_nodes(shared_openings(turns, every, most), turns.select("conv_id").distinct(), shard_nodes)
