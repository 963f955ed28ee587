"""Scoring by prediction by partial matching: byte contexts, escapes, symbol exclusion."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from feedmetrics.llm.base import held_out, staged, text_of

END = b"\n"  # never inside a word: ends a text, and fills the context before its first byte
PACK_BYTES = 1 << 20


def plain(text: str) -> bytes:
    """The words of a text, A-Z lower-cased, joined by a space, and the end."""
    return b" ".join(text.encode("utf-8", "replace").lower().split()) + END


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-byte strings that end at each byte of the texts, as numbers; where each text begins."""
    lengths = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(END * order + t for t in texts), dtype=np.uint8).astype(np.int64)
    begins = np.cumsum(lengths + order) - (lengths + order)
    codes = np.zeros(len(data) - order, dtype=np.int64)
    for i in range(order + 1):
        codes = (codes << 8) | data[i:len(data) - order + i]
    real = np.ones(len(codes), dtype=bool)
    for i in range(order):
        real[begins[1:] - order + i] = False
    return codes[real], np.cumsum(lengths) - lengths


class BlockCounts:
    """Counts of a block's byte strings and words; those of texts held out are there with none.

    Words are numbered as they come, the end being number 0, so that the block's
    texts need to be cut into words only once.
    """

    def __init__(self, order: int):
        self.order, self.parts, self.waiting = order, [], 0
        self.words, self.seen = {END: 0}, np.zeros(1, dtype=np.int64)

    def add(self, texts: list[bytes], held: list[bool]) -> tuple[list[int], bytes]:
        """Counts texts; how many tokens each has, and the numbers of them all."""
        for part in (False, True):
            chosen = [t for t, h in zip(texts, held) if h == part]
            if not chosen:
                continue
            values, n = np.unique(grams_of(chosen, self.order)[0], return_counts=True)
            self.parts.append((values, np.zeros_like(n) if part else n))
            self.waiting += len(values)
        if self.waiting > 2_000_000:
            self._merge()
        split = [t.split() for t in texts]
        for own in split:
            own.append(END)
        for word in set(chain.from_iterable(split)).difference(self.words):
            self.words[word] = len(self.words)
        lengths = list(map(len, split))
        numbers = np.fromiter(map(self.words.__getitem__, chain.from_iterable(split)), np.int32, sum(lengths))
        trained = numbers[np.repeat(~np.array(held, dtype=bool), lengths)]
        seen = np.bincount(trained, minlength=len(self.words))
        seen[:len(self.seen)] += self.seen
        self.seen = seen
        return lengths, numbers.tobytes()

    def _merge(self) -> None:
        values, place = np.unique(np.concatenate([v for v, _ in self.parts]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([n for _, n in self.parts])).astype(np.int64)
        self.parts, self.waiting = [(values, counts)], 0

    def rows(self, block: int) -> Iterator[pd.DataFrame]:
        if not self.parts:
            return
        self._merge()
        yield _rows(block=block, gram=self.parts[0][0], n=self.parts[0][1])
        words = list(self.words)
        for at in range(0, len(words), 100_000):
            own = words[at:at + 100_000]
            yield _rows(block=block, word=own, number=np.arange(at, at + len(own)), n=self.seen[at:at + len(own)])


class Places:
    """Finds numbers in a rising array, nearly all by one look into a table of hashes."""

    def __init__(self, known: np.ndarray):
        bits = min(23, max(10, (4 * len(known)).bit_length()))
        self.known, self.shift = known, np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, dtype=np.int32)
        self.table[self._slots(known)] = np.arange(len(known), dtype=np.int32)

    def _slots(self, numbers: np.ndarray) -> np.ndarray:
        return (numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        at = self.table[self._slots(numbers)]
        others = np.flatnonzero(self.known[at] != numbers)
        at[others] = np.minimum(np.searchsorted(self.known, numbers[others]), len(self.known) - 1)
        if not np.array_equal(self.known[at[others]], numbers[others]):
            raise ValueError("a byte string of the block has no probability")
        return at


ROWS = ("block bigint, ids array<string>, held array<boolean>, tokens array<bigint>, texts binary, numbers binary, "
        "gram bigint, word binary, number bigint, n bigint")
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]


def _rows(**given) -> pd.DataFrame:
    return pd.DataFrame({c: given.get(c) for c in COLUMNS})


def _blocks(order: int, block_bytes: int):
    """Deals a partition's texts into blocks: rows of packed texts, then the block's counts."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, size, counts = TaskContext.get().partitionId() << 32, 0, BlockCounts(order)
        for batch in batches:
            texts = list(map(plain, batch["text"]))
            ids, held, at = batch["doc_id"].tolist(), batch["held"].tolist(), 0
            while at < len(texts):
                stop, length = at, 0
                while stop < len(texts) and length < PACK_BYTES:
                    length += len(texts[stop])
                    stop += 1
                tokens, numbers = counts.add(texts[at:stop], held[at:stop])
                packed = zstandard.compress(b"".join(texts[at:stop]))
                yield _rows(block=block, ids=[ids[at:stop]], held=[held[at:stop]], tokens=[tokens], texts=[packed],
                            numbers=[zstandard.compress(numbers)], n=0)
                size, at = size + length, stop
                if size >= block_bytes:
                    yield from counts.rows(block)
                    block, size, counts = block + 1, 0, BlockCounts(order)
        yield from counts.rows(block)

    return deal


def log_probabilities(grams: DataFrame, order: int) -> DataFrame:
    """grams(gram, n): training counts of all (order + 1)-byte strings to score -> (gram, logp), base 10.

    A context of ``total`` training bytes and ``kinds`` different next bytes
    gives a byte seen n times (n - 1/2) / total, and escapes to the context one
    byte shorter with kinds / (2 total). There the bytes seen in the longer
    context are excluded: they cannot be what follows an escape. Below the empty
    context all 256 bytes not seen at all are equally likely.

    A context has at most 256 next bytes, and a string at most 256 one byte
    longer, so the windows below stay small whatever the corpus.
    """
    spark = grams.sparkSession
    levels, level = {}, grams
    for j in range(order, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * j)) - 1).cast("bigint"))
        level = level.withColumn("context", F.shiftright("gram", 8)).withColumn("shorter", shorter)
        own, seen = Window.partitionBy("context"), F.col("n") > 0
        if j:
            level = level.withColumn("below", F.sum("n").over(Window.partitionBy("shorter")))
        else:
            level = level.withColumn("below", F.lit(0).cast("bigint"))
        level = level.withColumn("total", F.sum("n").over(own)).withColumn("kinds", F.count_if(seen).over(own))
        level = level.withColumn("covered", F.sum(F.when(seen, F.col("below")).otherwise(0)).over(own))
        levels[j] = staged(spark, level.drop("context"), f"ppm-{j}")
        level = levels[j].groupBy(F.col("shorter").alias("gram")).agg(F.sum("n").alias("n"))

    known = (F.col("n") - 0.5) / F.col("total")
    escape = F.col("kinds") / (2 * F.col("total"))
    rest = F.when(F.col("kinds") < 256, 1.0 / (256 - F.col("kinds")))
    found = levels[0].select("gram", "n", "total", "kinds", rest.alias("down"), F.when(
        F.col("total") == 0, F.lit(1.0 / 256)).when(F.col("n") > 0, known).otherwise(escape * rest).alias("p"))
    for j in range(1, order + 1):
        lower = found.select(F.col("gram").alias("shorter"), F.col("n").alias("low_n"), F.col("down").alias("low_down"),
                             F.col("p").alias("low_p"), F.col("total").alias("low_total"),
                             F.col("kinds").alias("low_kinds"))
        left, kinds = F.col("low_total") - F.col("covered"), F.col("low_kinds") - F.col("kinds")
        new = levels[j].filter("n = 0").join(lower, "shorter")
        down = F.when(F.col("low_n") > 0, (F.col("low_n") - 0.5) / left).otherwise(
            F.when(kinds > 0, kinds / (2 * left)).otherwise(1.0) * F.col("low_down"))
        new = new.withColumn("down", down).select(
            "gram", "n", "total", "kinds", "down",
            F.when(F.col("total") == 0, F.col("low_p")).otherwise(escape * F.col("down")).alias("p"))
        old = levels[j].filter("n > 0").select("gram", "n", "total", "kinds", F.lit(None).cast("double").alias("down"),
                                               known.alias("p"))
        found = old.unionByName(new)
    return found.select("gram", F.log10("p").alias("logp"))


SCORES = ("doc_id string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
          "score double")


def _block_scores(order: int, total: int, kinds: int):
    floor = np.log10(total + 0.1 * (kinds + 1))

    def score(packs: pd.DataFrame, lookup: pd.DataFrame) -> pd.DataFrame:
        known = lookup[lookup["number"].isna()]
        grams, logs = known["gram"].to_numpy(dtype=np.int64), known["logp"].to_numpy(dtype=float)
        sort = np.argsort(grams)
        logs, places = logs[sort], Places(grams[sort])
        words = lookup[lookup["number"].notna()]
        counts = np.zeros(len(words), dtype=np.int64)
        counts[words["number"].to_numpy(dtype=np.int64)] = words["n"].to_numpy(dtype=np.int64)
        values, seen = np.log10(counts + 0.1) - floor, (counts > 0).astype(np.int64)
        parts = []
        for ids, held, tokens, texts, numbers in zip(*(packs[c] for c in ("ids", "held", "tokens", "texts", "numbers"))):
            codes, starts = grams_of(zstandard.decompress(texts).splitlines(keepends=True), order)
            own = np.frombuffer(zstandard.decompress(numbers), np.int32)
            begins = np.cumsum(tokens) - tokens
            parts.append(pd.DataFrame({
                "doc_id": ids, "held_out": held, "n_tokens": tokens, "n_known": np.add.reduceat(seen[own], begins),
                "train_tokens": total, "base_score": np.add.reduceat(values[own], begins),
                "score": np.add.reduceat(logs[places(codes)], starts)}))
        return pd.concat(parts) if parts else pd.DataFrame(columns=[c.split()[0] for c in SCORES.split(", ")])

    return score


def scored(docs: DataFrame, order: int = 4, folds: int = 10, id_column: str = "doc_id", text_column: str = "text",
           block_bytes: int = 20 << 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A text is its words, A-Z lower-cased, joined by a space, and an end byte.
    ``score`` is its log10 probability byte by byte under contexts of up to
    ``order`` bytes, counted in all texts outside fold 0; ``base_score`` that of
    its words and end as independent draws.

    One pass over the texts deals them into blocks of about ``block_bytes``. A
    block keeps its texts and the numbers of their words, packed, and reports
    each byte string and word once, with its count. The corpus sums the counts,
    works out the probabilities by windows and joins, and returns to each block
    those of its strings and words. So what is shuffled is bounded by the text
    and shrinks with repetition, and nothing that grows with the corpus is
    broadcast or collected.

    A null or empty text has the end token alone. A null id counts as the empty
    string for the fold. Repeated rows are texts of their own; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType
    texts = docs.select(F.col(id_column).cast("string").alias("doc_id"), text_of(text_column).alias("text"),
                        held_out(id_column, folds).alias("held"))
    rows = staged(spark, texts.mapInPandas(_blocks(order, block_bytes), ROWS), "ppm-blocks")
    strings = rows.filter("gram IS NOT NULL").select("block", "gram", "n")
    grams = strings.groupBy("gram").agg(F.sum("n").alias("n"))
    priced = strings.select("block", "gram").join(log_probabilities(grams, order), "gram")

    own, first = Window.partitionBy("word"), F.row_number().over(Window.partitionBy("word").orderBy("block"))
    words = rows.filter("word IS NOT NULL").select("block", "number", "n", F.sum("n").over(own).alias("all"),
                                                   first.alias("nth"))
    seen: Observation = Observation()
    tokens: Column = F.coalesce(F.sum("n"), F.lit(0))
    words = words.observe(seen, tokens.alias("tokens"),
                          F.count_if((F.col("nth") == 1) & (F.col("all") > 0)).alias("kinds"))
    counted = staged(spark, words.select("block", "number", F.col("all").alias("n")), "ppm-words")
    total, kinds = seen.get["tokens"], seen.get["kinds"]

    nothing = F.lit(None).cast("bigint")
    lookup = priced.select("block", "gram", "logp", nothing.alias("number"), nothing.alias("n")).unionByName(
        counted.select("block", nothing.alias("gram"), F.lit(None).cast("double").alias("logp"), "number", "n"))
    packs = rows.filter("texts IS NOT NULL").select(F.col("block").alias("own_block"), "ids", "held", "tokens", "texts",
                                                    "numbers")
    found = packs.groupBy("own_block").cogroup(lookup.groupBy("block")).applyInPandas(
        _block_scores(order, total, kinds), SCORES)
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
