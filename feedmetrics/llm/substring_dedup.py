"""Substring deduplication: repeated word windows, found by super-k-mer partitioning."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from feedmetrics.llm.base import staged, text_of, words_of

LAST_ID = (1 << 63) - 1


class SuperKmers:
    """Cuts the words of texts into runs of windows that share a minimiser.

    The minimiser of a window is the leftmost of its ``inner``-word strings with
    the lowest hash. Windows of equal words have it at the same place, so equal
    windows of different places are never in one run.
    """

    PLACE_BITS = 28

    def __init__(self, window: int, inner: int):
        self.window, self.inner = window, inner

    @staticmethod
    def _joined(hashes: np.ndarray, have: int, want: int) -> np.ndarray:
        """Hashes of ``want`` words from each place, from those of ``have`` words."""
        while have < want:
            step = min(have, want - have)
            size = len(hashes) - step
            hashes = hashes[:size] * np.uint64(0x9E3779B97F4A7C15) + hashes[step:]
            hashes ^= hashes >> np.uint64(31)
            hashes *= np.uint64(0xBF58476D1CE4E5B9)
            hashes ^= hashes >> np.uint64(29)
            have += step
        return hashes

    def __call__(self, texts: list[list[bytes]], with_windows: bool = False) -> dict[str, np.ndarray]:
        """For each run: minimiser, text, start (first window in its text), begin (in all words) and n (windows)."""
        words = list(chain.from_iterable(texts))
        windows = len(words) - self.window + 1
        if windows <= 0:
            return {"words": words} | {c: np.empty(0, np.int64) for c in ("minimiser", "text", "start", "begin", "n",
                                                                         "window")}
        hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
        inner = self._joined(hashes, 1, self.inner)
        low = np.uint64((1 << self.PLACE_BITS) - 1)
        best, have = (inner & ~low) | np.arange(len(inner), dtype=np.uint64), 1
        while have < self.window - self.inner + 1:
            step = min(have, self.window - self.inner + 1 - have)
            best = np.minimum(best[:-step], best[step:])
            have += step
        place = (best & low).astype(np.int64)
        lengths = np.array([len(t) for t in texts])
        offsets = np.cumsum(lengths) - lengths
        text = np.repeat(np.arange(len(texts)), lengths)[:windows]
        inside = np.flatnonzero(np.arange(self.window, windows + self.window) <= (offsets + lengths)[text])
        place = place[inside]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(inside) else inside
        begin = inside[first]
        out = {"words": words, "minimiser": inner[place[first]].view(np.int64), "text": text[begin], "begin": begin,
               "start": begin - offsets[text[begin]], "n": np.diff(np.append(first, len(inside)))}
        if with_windows:
            out["window"] = self._joined(inner, self.inner, self.window).view(np.int64)
        return out


def _chunks(batch: pd.DataFrame) -> Iterator[tuple[int, list[list[bytes]]]]:
    """(first row, words of the texts) of runs of rows of some hundred thousand words."""
    first, own, size = 0, [], 0
    for row, text in enumerate(batch["text"]):
        own.append(words_of(text))
        size += len(own[-1])
        if size > 200_000:
            yield first, own
            first, own, size = row + 1, [], 0
    yield first, own


def minimiser_counts(texts: DataFrame, window: int, inner: int) -> DataFrame:
    """(minimiser, n): in how many runs of the corpus it is, for those in at least two."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cut = SuperKmers(window, inner)
        for batch in batches:
            for _, words in _chunks(batch):
                values, n = np.unique(cut(words)["minimiser"], return_counts=True)
                yield pd.DataFrame({"minimiser": values, "n": n})

    counts = texts.select("text").mapInPandas(count, "minimiser bigint, n bigint")
    return counts.groupBy("minimiser").agg(F.sum("n").alias("n")).filter("n > 1")


def slot_filter(minimisers: DataFrame, bits: int) -> bytes:
    """One bit for each of 2**bits slots, set if a minimiser falls there: 2**(bits - 3) bytes, whatever the data."""
    piece_bits = min(bits, 19)
    slot = F.col("minimiser").bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))

    def fill(piece: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << piece_bits, dtype=bool)
        flags[piece["slot"].to_numpy() & ((1 << piece_bits) - 1)] = True
        return pd.DataFrame({"piece": [int(piece["piece"].iloc[0])], "flags": [np.packbits(flags).tobytes()]})

    slots = minimisers.select(slot.alias("slot")).distinct().withColumn("piece", F.shiftright("slot", piece_bits))
    out = bytearray((1 << bits) // 8)
    size = (1 << piece_bits) // 8
    for row in slots.groupBy("piece").applyInPandas(fill, "piece bigint, flags binary").toLocalIterator():
        out[row["piece"] * size:(row["piece"] + 1) * size] = row["flags"]
    return bytes(out)


RUN = "bucket bigint, packed string, id bigint, twin bigint, start bigint, n bigint"


def packed_runs(texts: DataFrame, window: int, inner: int, bits: int, heavy_runs: int,
                most_held: int = 100_000) -> DataFrame:
    """texts(text, id, twin) -> runs that may occur elsewhere: bucket, packed words, place, number of windows.

    A run whose minimiser is in one place of the corpus only holds no repeated
    window and stays at home. The bucket is the minimiser; where more than
    ``heavy_runs`` runs share it, each of their windows travels alone, to a
    bucket by its own words. Both are told by filters of a fixed size, and equal
    windows are always told the same.

    A task sends equal runs once, for the earliest place it has seen. The other
    places, whose windows therefore all start earlier elsewhere, are returned
    without words.
    """
    spark = texts.sparkSession
    counts = staged(spark, minimiser_counts(texts, window, inner), "substring-minimisers")
    shared = spark.sparkContext.broadcast((slot_filter(counts, bits), slot_filter(
        counts.filter(F.col("n") > heavy_runs), bits)))
    mask = (1 << bits) - 1

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        repeated, heavy = (np.frombuffer(b, dtype=np.uint8) for b in shared.value)
        cut, first, later = SuperKmers(window, inner), {}, []

        def told(flags: np.ndarray, slots: np.ndarray) -> np.ndarray:
            return (flags[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 > 0

        def frame(everything: bool) -> pd.DataFrame:
            rows = [(own[0], packed, *own[1:]) for packed, own in first.items()] if everything else []
            rows += [(hash(own[1:]), None, *own[1:]) for own in later]
            later.clear()
            if everything:
                first.clear()
            return pd.DataFrame(rows, columns=[c.split()[0] for c in RUN.split(", ")])

        for batch in batches:
            ids, twins = batch["id"].tolist(), batch["twin"].tolist()
            for row, texts in _chunks(batch):
                runs = cut(texts, with_windows=True)
                slots = runs["minimiser"] & mask
                keep = told(repeated, slots)
                alone = told(heavy, slots)[keep]
                words, by_words = runs["words"], runs["window"]
                places = zip(*(runs[c][keep].tolist() for c in ("minimiser", "text", "start", "begin", "n")),
                             alone.tolist())
                for bucket, text, start, begin, n, single in places:
                    own, twin = ids[row + text], twins[row + text]
                    pieces = [(int(by_words[begin + i]), i, 1) for i in range(n)] if single else [(bucket, 0, n)]
                    for bucket, i, n in pieces:
                        packed = b" ".join(words[begin + i:begin + i + n + window - 1]).decode("utf-8")
                        new = (bucket, own, twin, start + i, n)
                        old = first.setdefault(packed, new)
                        if old[1:] != new[1:]:
                            if new[1:] < old[1:]:
                                first[packed], new = new, old
                            later.append(new)
                if len(first) > most_held or len(later) > most_held:
                    yield frame(len(first) > most_held)
        yield frame(True)

    return texts.mapInPandas(pack, RUN)


def covering_windows(runs: DataFrame, window: int) -> DataFrame:
    """runs -> (id, twin, start, n): runs of windows whose words also start earlier.

    The packed strings are dealt to their buckets, the only time that they are
    shuffled. There sorting brings equal strings together: all windows of all but
    the earliest start earlier. The earliest unfolds into its windows, which a
    second sort inside the bucket brings next to their equals.
    """
    dealt = runs.repartition("bucket")
    nth: Column = F.rank().over(Window.partitionBy("bucket", "packed").orderBy("id", "twin", "start"))
    numbered = dealt.withColumn("nth", nth).withColumn("words", F.split("packed", " "))
    pieces = F.expr(f"""
        CASE WHEN packed IS NULL OR nth > 1
             THEN array(named_struct('at', start, 'windows', n, 'window', CAST(NULL AS STRING)))
             ELSE transform(sequence(1, CAST(n AS INT)), i -> named_struct('at', start + i - 1, 'windows', 1L,
                            'window', array_join(slice(words, i, {window}), ' '))) END""")
    unfolded = numbered.select("bucket", "id", "twin", F.inline(pieces))
    again: Column = F.rank().over(Window.partitionBy("bucket", "window").orderBy("id", "twin", "at"))
    found = unfolded.withColumn("again", again).filter("window IS NULL OR again > 1")
    return found.select("id", "twin", F.col("at").alias("start"), F.col("windows").alias("n"))


RESULT = "n_words bigint, n_removed bigint, kept_text string"


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``id``: bigints in the order of ``doc_id``, null for null."""
    if isinstance(rows.schema["doc_id"].dataType, IntegralType):
        return rows.withColumn("id", F.col("doc_id").cast("bigint"))
    # A sort deals the ids into ranges, and the numbers grow from range to range.
    order = rows.select("doc_id").filter("doc_id IS NOT NULL").distinct().orderBy("doc_id").select(
        F.col("doc_id").alias("__id"), F.monotonically_increasing_id().alias("id"))
    order = staged(rows.sparkSession, order, "repeats-ids")
    return rows.join(order, F.col("doc_id") == F.col("__id"), "left").drop("__id")


def without_repeats(docs: DataFrame, window: int = 20, inner: int = 8, filter_bits: int = 27, heavy_runs: int = 10_000,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text (the words left, joined by a space).

    Removes each word covered by a ``window`` of words whose sequence also
    starts earlier: in a document of smaller id, or earlier in the same one.

    Consecutive windows that share a minimiser travel as one packed string. A
    first pass counts minimisers, and only runs whose minimiser occurs again are
    packed. Which those are is told by filters of ``2**filter_bits`` bits, a size
    that does not grow with the data: where two minimisers share a slot a run
    travels in vain, and the result is the same.

    A null text has no words. Ids of any type that can be ordered will do: those
    that are not whole numbers are numbered in their order. Null ids come last. Rows that repeat id and text
    count as one document and get equal results; rows of one id with different
    texts are ordered by the hash of the text. An empty table gives an empty
    result; other columns are ignored.
    """
    texts = _numbered(docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("text")))
    texts = texts.withColumn("id", F.coalesce("id", F.lit(LAST_ID))).withColumn("twin", F.xxhash64("text"))
    runs = packed_runs(texts.select("text", "id", "twin"), window, inner, filter_bits, heavy_runs)
    covered = covering_windows(runs, window).groupBy("id", "twin").agg(
        F.collect_list(F.struct("start", "n")).alias("covered"))

    @F.pandas_udf(RESULT)
    def keep(text: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
        out = []
        for t, begins, sizes in zip(text, starts, lengths):
            words = words_of(t)
            removed = np.zeros(len(words) + 1, dtype=np.int64)
            if begins is not None:
                begins, sizes = np.asarray(begins, dtype=np.int64), np.asarray(sizes, dtype=np.int64)
                np.add.at(removed, begins, 1)
                np.add.at(removed, begins + sizes + window - 1, -1)
            gone = np.cumsum(removed)[:-1] > 0
            left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
            out.append((len(words), int(gone.sum()), left.decode("utf-8")))
        return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    joined = texts.join(covered, ["id", "twin"], "left")
    result = keep.asNondeterministic()("text", "covered.start", "covered.n")
    return joined.select("doc_id", result.alias("r")).select("doc_id", "r.*")
