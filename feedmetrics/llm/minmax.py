"""Near-duplicates by min-max hashing: smallest and largest hash under each permutation, banded, confirmed on sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.base import staged, text_of
from feedmetrics.llm.components import connected

MIX, LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * LAST
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Text -> its distinct shingles as rising 64-bit hashes, made of the hashes of their words."""

    def __init__(self, words_each: int, most: int = 500_000):
        self.words_each, self.most, self.known = words_each, most, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").lower().split()
        if len(self.known) > self.most:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(self.known.__getitem__, words), dtype=np.uint64, count=len(words))
        each = min(self.words_each, len(words))
        if not each:
            return hashes
        windows = np.full(len(words) - each + 1, each, dtype=np.uint64)
        for i in range(each):
            windows = _mixed(windows * MIX + hashes[i:i + len(windows)])
        return np.unique(windows)


class MinMax:
    """Band keys of sets: ``bands`` of ``rows`` values each, half of them of minima, half of maxima.

    Each of the ``bands * rows / 2`` permutations gives two values. Those of one
    permutation are in different bands, so a band's values are independent.
    """

    def __init__(self, bands: int, rows: int, seed: int):
        random = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.factors = random.integers(0, 1 << 63, bands * rows // 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.terms = random.integers(0, 1 << 63, bands * rows // 2, dtype=np.uint64)

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of minima, then maxima, for each set; no set is empty."""
        whole = np.concatenate(sets)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
        half = len(self.factors)
        found, under = np.empty((len(sets), 2 * half), dtype=np.uint64), np.empty_like(whole)
        for k in range(half):
            np.multiply(whole, self.factors[k], out=under)
            under += self.terms[k]
            found[:, k] = np.minimum.reduceat(under, starts)
            found[:, half + k] = np.maximum.reduceat(under, starts)
        return found

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        values = self.signatures(sets).reshape(len(sets), self.bands, self.rows)
        keys = np.zeros((len(sets), self.bands), dtype=np.uint64)
        for row in range(self.rows):
            keys = _mixed(keys * MIX + values[:, :, row])
        return keys.view(np.int64)


def _chunks(sets: list[np.ndarray], most: int = 1 << 17) -> Iterator[list[int]]:
    """Numbers of the sets that are not empty, a bounded count of hashes (or one set) at a time."""
    own, size = [], 0
    for k, s in enumerate(sets):
        if not len(s):
            continue
        if own and size + len(s) > most:
            yield own
            own, size = [], 0
        own.append(k)
        size += len(s)
    if own:
        yield own


def prints(docs: DataFrame, id_column: str, text_column: str, words_each: int, bands: int, rows: int,
           seed: int) -> DataFrame:
    """(doc_id, n, digest, keys) of every row: set size, digest of the set, band keys; both null for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, hashing = Shingler(words_each), MinMax(bands, rows, seed)
        for batch in batches:
            sets = [shingler(t) for t in batch["text"]]
            keys = [None] * len(sets)
            for own in _chunks(sets):
                for k, found in zip(own, hashing.keys([sets[k] for k in own])):
                    keys[k] = found
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "n": [len(s) for s in sets], "keys": keys,
                "digest": [hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets]})

    texts = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInPandas(run, f"doc_id {kind}, n bigint, keys array<bigint>, digest binary")


def _sets(docs: DataFrame, wanted: DataFrame, id_column: str, text_column: str, words_each: int) -> DataFrame:
    """wanted(node, digest, first_id) -> (node, members): each class's set, made again from a text that has it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(words_each)
        for batch in batches:
            sets = [shingler(t) for t in batch["text"]]
            digests = [hashlib.md5(s.tobytes()).digest() for s in sets]
            own = [k for k, d in enumerate(digests) if d == bytes(batch["digest"].iloc[k])]
            yield pd.DataFrame({"node": batch["node"].iloc[own], "members": [sets[k].view(np.int64) for k in own]})

    texts = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    found = texts.join(wanted, F.col("id").eqNullSafe(F.col("first_id"))).select("node", "digest", "text")
    # Rows that share an id and a set give a class its set more than once.
    return found.mapInPandas(run, "node bigint, members array<bigint>").dropDuplicates(["node"])


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("a_set"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("b_set"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size(F.array_intersect("a_set", "b_set")).alias("shared"),
        (F.size("a_set") + F.size("b_set")).alias("sizes"))
    return both.filter(100 * F.col("shared") >= percent * (F.col("sizes") - F.col("shared"))).select("a", "b")


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes differ more than this cannot be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_each: int = 2,
                    percent: int = 80, bands: int = 40, rows: int = 5, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    A document's set is its distinct shingles of ``words_each`` words, A-Z
    lower-cased; a shorter text is one shingle. Documents are linked when
    100 x intersection >= ``percent`` x union. Equal sets count once. Each set
    gets ``bands`` keys of ``rows`` values, so two sets of similarity s share
    none with probability (1 - s ** rows) ** bands: 1e-7 at 0.8 with the defaults.
    Every link given out is confirmed on the whole sets.

    Sets that share a key are a bucket, and no bucket is spread into its pairs.
    First each is compared with one of its bucket alone, that which meets most
    other sets under all its keys, so a group of near copies is joined by its
    original. Where a bucket then still holds several components, links between
    them are searched by rare shingles (``_remaining``), which finds every one.
    So the components are those of all similar sets that share a key.

    ``component_id`` is the smallest id reachable; ``kept`` says whether it is
    the row's own. A text that is null or has no words is linked with nothing.
    Rows that share an id are documents of their own, with null ids too; a
    component without any id has a null ``component_id``. Repeated rows each get
    a row; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    found = staged(spark, prints(docs, id_column, text_column, words_each, bands, rows, seed), "minmax-prints")
    classes = found.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    classes = staged(spark, classes.select(F.monotonically_increasing_id().alias("node"), "digest", "first_id", "n",
                                           "keys"), "minmax-classes")
    roots = _roots(docs, classes, id_column, text_column, words_each, percent)
    rooted = classes.join(roots, "node", "left").select("digest", "first_id", F.coalesce("root", "node").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(firsts, "root").select("digest", "component_id")
    # An empty set's digest is null and meets no class.
    joined = found.drop("keys").join(labels, "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def _roots(docs: DataFrame, classes: DataFrame, id_column: str, text_column: str, words_each: int,
           percent: int) -> DataFrame:
    """(node, root) of the classes that have a link."""
    spark = docs.sparkSession
    entries = classes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    buckets = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = staged(spark, entries.join(buckets, ["band", "key"]), "minmax-members")
    company = members.groupBy("node").agg(F.sum("size").alias("met"))
    chosen = members.join(company, "node").groupBy("band", "key").agg(
        F.max_by(F.struct("node", "n"), F.struct("met", "node")).alias("center"))
    stars = members.join(chosen, ["band", "key"]).select("node", "n", F.col("center.node").alias("center"),
                                                         F.col("center.n").alias("center_n"))
    stars = stars.filter("node <> center").filter(_similar_sizes("n", "center_n", percent))
    stars = staged(spark, stars.select(F.least("node", "center").alias("a"), F.greatest("node", "center").alias("b"))
                   .distinct(), "minmax-stars")
    # Any member of a bucket may be compared again.
    wanted = classes.select("node", "digest", "first_id").join(members.select("node").distinct(), "node", "left_semi")
    sets = staged(spark, _sets(docs, wanted, id_column, text_column, words_each), "minmax-sets")
    roots = staged(spark, connected(spark, _linked(stars, sets, percent)), "minmax-roots")

    now = members.select("band", "key", "node").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    open_ = now.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    nodes = now.join(open_, ["band", "key"], "left_semi").select("node", "root").distinct()
    pairs = _remaining(staged(spark, sets.join(nodes, "node"), "minmax-open"), percent)
    pairs = staged(spark, pairs.join(stars, ["a", "b"], "left_anti"), "minmax-pairs")
    more = staged(spark, _linked(pairs, sets, percent), "minmax-links")
    if more.isEmpty():
        return roots
    known = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return connected(spark, known.unionByName(more))


def _remaining(sets: DataFrame, percent: int) -> DataFrame:
    """sets(node, members, root) -> pairs (a, b) of different roots, all similar ones among them.

    Shingles are ordered by how many sets have them, the rarest first, the same
    order for all. Two similar sets share so many that the first one they share
    is early in both: among the first (1 - 2t / (1 + t)) of the smaller set and
    the first (1 - t) of the larger. From its places in both follows how many
    they can share at most. Shingles of one set alone are only counted.

    Under a shingle, sets of its most frequent root are not compared with each
    other, so a large group of near copies costs its size times the strays.
    """
    elements = sets.select("node", F.size("members").alias("n"), F.explode("members").alias("shingle"))
    common = elements.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    ordered = elements.join(common, "shingle").groupBy("node").agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("sets", "shingle"))).alias("rare"))

    def first(share: str) -> Column:
        """How many of n shingles come before the last ceil(share * n), and one more."""
        return F.col("n") - F.ceil(F.expr(share)) + 1

    ordered = ordered.select(
        "node", "n", first(f"n * {percent} / 100D").alias("as_larger"),
        first(f"n * {2 * percent} / {100 + percent}D").alias("as_smaller"), (F.col("n") - F.size("rare")).alias("alone"),
        "rare")
    kept = F.slice("rare", 1, F.greatest(F.col("as_larger") - F.col("alone"), F.lit(0)).cast("int"))
    entries = ordered.select("node", "n", "as_smaller", "alone", F.posexplode(kept).alias("index", "of"))
    entries = entries.select("node", "n", "as_smaller", (F.col("alone") + F.col("index") + 1).alias("place"),
                             F.col("of.shingle").alias("shingle"))
    entries = staged(sets.sparkSession, entries.join(sets.select("node", "root"), "node"), "minmax-rare")

    by_root = entries.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = by_root.groupBy("shingle").agg(F.max_by("root", F.struct("size", "root")).alias("main"),
                                             F.count(F.lit(1)).alias("roots")).filter("roots > 1").drop("roots")
    strays = entries.join(largest, "shingle").filter("root <> main").select(
        "shingle", *(F.col(c).alias(f"s_{c}") for c in ("node", "n", "as_smaller", "place", "root")))
    smaller = (F.col("s_n") <= F.col("n")) & (F.col("s_place") <= F.col("s_as_smaller"))
    larger = (F.col("n") <= F.col("s_n")) & (F.col("place") <= F.col("as_smaller"))
    most = F.least(F.col("n") - F.col("place"), F.col("s_n") - F.col("s_place")) + 1
    enough = (100 + percent) * most >= percent * (F.col("n") + F.col("s_n"))
    found = entries.join(strays, (entries["shingle"] == strays["shingle"]) & (F.col("root") != F.col("s_root"))
                         & (smaller | larger) & enough & _similar_sizes("n", "s_n", percent))
    return found.select(F.least("node", "s_node").alias("a"), F.greatest("node", "s_node").alias("b")).distinct()
