"""Packing documents into fixed windows: non-negative least squares over length combinations."""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from feedmetrics.llm.base import staged, text_of


# The normalizer and pre-tokenizer of the word-level BPE files, whose tokens stay inside a word.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
               {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Texts of these characters are their own NFC form, and their letters, lower-cased, are a-z and the next line's.
UNUSUAL = re.compile("[^\t-\r -~À-ÖØ-öø-įı-ſ]|<\\|")
UNUSUAL_RUN = re.compile(f"(?:{UNUSUAL.pattern})+")
NEAR = 256  # characters between unusual ones that are not worth a call of their own
# In UTF-8, all their bytes from 128 on are of letters.
SPACE, LETTER, DIGIT, OTHER = range(4)
KINDS = bytes(SPACE if b in b"\t\n\v\f\r " else DIGIT if b in b"0123456789" else
              LETTER if b >= 128 or chr(b).isalpha() else OTHER for b in range(256))
SHORT = re.compile(rb"'(?<![!-&(-/:-@\[-`{-~']')(?:[stmd]|re|ve|ll)")  # a quote within a run of others starts none
END = 1  # stands for the end of a piece: no text of those characters has it


def marked(text: str) -> str:
    """The pieces of a lower-case text of those characters, each with ``END`` behind it, and not the spaces.

    Two neighbours are cut apart where their kinds differ, and so are digits.
    """
    raw = text.encode() + b" "
    kinds = np.frombuffer(raw.translate(KINDS), np.uint8)
    cuts = np.concatenate(([False], (kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT)))
    short = np.array([m.span() for m in SHORT.finditer(raw)], dtype=np.int64).reshape(-1, 2)
    cuts[short[:, 0] + 1] = False
    cuts[short[:, 1]] = True
    cuts = np.flatnonzero(cuts & (kinds != SPACE))
    cuts = cuts[kinds[cuts - 1] != SPACE]  # a space is itself an end
    letters = np.where(kinds == SPACE, np.uint8(END), np.frombuffer(raw, np.uint8))
    return np.insert(letters, cuts, END).tobytes().decode()


def byte_letters() -> dict[int, str]:
    """Byte -> its letter in byte-level BPE: printable Latin-1 stands for itself, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class WordEncoder:
    """Token ids of whole texts, for word-level BPE.

    Usual text is lower-cased and cut into pieces here by the kinds of its
    bytes, all at once, with a mark behind each piece, and their ids found by
    ranks: what the tokenizer calls a token that ends a piece is then one that
    ends with the mark, the merge of a last byte with its mark comes before all
    others, as the ids have it, and nothing needs to be remembered, however rich
    the vocabulary. Words with other characters, and what is near them, go
    through the tokenizer itself, and so do all texts where the file's merges
    are not in the order of its ids. Texts are cut at spaces, where no token
    goes on.
    """

    def __init__(self, tokenizer_file: str, dtype: str, part: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype, self.part = Tokenizer.from_file(tokenizer_file), dtype, part
        settings = json.loads(self.tokenizer.to_str())
        steps = settings["pre_tokenizer"].get("pretokenizers", [])
        if (settings["normalizer"].get("normalizers") != NORMALIZERS or [s["type"] for s in steps] != [
                "Split", "ByteLevel"] or steps[0]["pattern"] != {"Regex": SPLIT} or steps[1]["use_regex"]):
            raise ValueError("not a word-level BPE tokenizer")
        model = settings["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        single = [i for token, i in vocabulary.items() if len(token.removesuffix(suffix)) == 1]
        self.ranked = None
        if suffix and merged == sorted(merged) and max(single) < merged[0]:
            ranks = {}
            for token, number in vocabulary.items():
                body = token.removesuffix(suffix)
                if all(c in byte_of for c in body):
                    ranks[bytes(byte_of[c] for c in body) + (bytes([END]) if body != token else b"")] = number
            for byte in range(256):
                ranks.setdefault(bytes([byte]), 1 << 20 | byte)  # needed, but never given out
            self.ranked = tiktoken.Encoding("ranks", pat_str=rf"[^\x0{END}]+\x0{END}", mergeable_ranks=ranks,
                                            special_tokens={})

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _usual(self, text: str) -> bytes:
        return self.packed(self.ranked.encode_ordinary(marked(text.lower())))

    def _other(self, text: str) -> bytes:
        text = text.encode("utf-8", "replace").decode("utf-8")
        return self.packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _part(self, text: str) -> bytes:
        if not self.ranked:
            return self._other(text)
        parts, at = [], 0
        while found := UNUSUAL.search(text, at):
            start, stop = max(text.rfind(" ", at, found.start()), at), found.end()
            if start > at:
                parts.append(self._usual(text[at:start]))
            while near := UNUSUAL_RUN.search(text, stop, stop + NEAR):
                stop = near.end()
            stop = text.find(" ", stop)
            at = len(text) if stop < 0 else stop
            parts.append(self._other(text[start:at]))
        if at < len(text):
            parts.append(self._usual(text[at:]))
        return b"".join(parts)

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            parts, at = [], 0
            while at < len(text):
                stop = text.find(" ", at + self.part) if at + self.part < len(text) else -1
                stop = len(text) if stop < 0 else stop
                parts.append(self._part(text[at:stop]))
                at = stop
            yield b"".join(parts)


@functools.lru_cache(maxsize=1)
def encoder_of(tokenizer_file: str, dtype: str) -> WordEncoder:
    """The encoder of a Python worker: its later tasks need not read the file again."""
    return WordEncoder(tokenizer_file, dtype)


def tokenized(docs: DataFrame, tokenizer_file: str, end_id: int, id_column: str, text_column: str,
              dtype: str) -> DataFrame:
    """(row, block, doc_id, n, ids): the ids of each whole text and ``end_id``, packed as ``dtype``.

    ``row`` numbers the rows, ``block`` the input partitions.
    """

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = encoder_of(tokenizer_file, dtype)
        end = encoder.packed([end_id])
        for batch in batches:
            yield pd.Series([ids + end for ids in encoder(batch.tolist())], dtype=object)

    ids = docs.select(F.col(id_column).alias("doc_id"), encode(text_of(text_column)).alias("ids"))
    return ids.select(F.monotonically_increasing_id().alias("row"), F.spark_partition_id().alias("block"), "doc_id",
                      F.expr(f"length(ids) div {np.dtype(dtype).itemsize}").alias("n"), "ids")


def combinations(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All falling tuples of at most ``depth`` bins, from 1 to ``bins``, whose sum is ``bins``."""

    def grow(left: int, most: int, depth: int):
        if left == 0:
            yield ()
        elif depth:
            for part in range(min(left, most), -(-left // depth) - 1, -1):
                for rest in grow(left - part, part, depth - 1):
                    yield (part, *rest)

    return list(grow(bins, bins, depth))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int) -> np.ndarray:
    """x >= 0 that brings a @ x close to b, by the active set method, in at most ``rounds`` rounds."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    for _ in range(rounds):
        gain = np.where(active, -np.inf, a.T @ (b - a @ x))
        best = int(np.argmax(gain))
        if gain[best] <= 1e-7 * max(1.0, np.abs(b).max()):
            break
        active[best] = True
        while active.any():
            chosen = np.flatnonzero(active)
            part = a[:, chosen]
            z = np.linalg.solve(part.T @ part + 1e-9 * np.eye(len(chosen)), part.T @ b)
            if z.min() > 0:
                x[:] = 0
                x[chosen] = z
                break
            old, bad = x[chosen], z <= 0
            step = np.min(old[bad] / np.maximum(old[bad] - z[bad], 1e-300))
            x[chosen] = old + step * (z - old)
            active[chosen[(x[chosen] <= 1e-9) & bad]] = False
            x[~active] = 0
    return x


def repeats(histogram: dict[int, int], bins: int, depth: int) -> list[tuple[tuple[int, ...], int]]:
    """(combination, whole number of windows): solved, rounded, and never more pieces than there are."""
    have = np.array([histogram.get(b, 0) for b in range(1, bins + 1)], dtype=float)
    ways = [w for w in combinations(bins, depth) if all(have[b - 1] for b in w)]
    if not ways:
        return []
    a = np.zeros((bins, len(ways)))
    for column, way in enumerate(ways):
        np.add.at(a[:, column], np.array(way) - 1, 1)
    weight = np.sqrt(np.arange(1, bins + 1) / bins)
    scale = max(have.max(), 1.0)
    x = nonnegative_least_squares(a * weight[:, None], have * weight / scale, 3 * bins) * scale
    left, out = have.astype(np.int64), []
    for column in np.argsort(-x, kind="stable"):
        needs = a[:, column].astype(np.int64)
        used = needs > 0
        times = int(min(np.floor(x[column] + 0.5), (left[used] // needs[used]).min()))
        if times > 0:
            left -= times * needs
            out.append((ways[column], times))
    return out


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, window: int = 4096, bin_tokens: int = 16, depth: int = 3,
         id_column: str = "doc_id", text_column: str = "text", dtype: str = "<u2") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are cut into whole windows, which are sequences of their
    own, and a rest. Rests are counted by length, in bins of ``bin_tokens``
    rounded up; all combinations of at most ``depth`` bins that fill a window
    are enumerated, and least squares with non-negative counts says how often to
    use each. The n-th rest of a bin goes to the n-th place that the rounded
    counts have for that bin, so placing is a lookup. Rests beyond them are
    packed greedily: those of one block of rows follow each other and are cut
    where a window is full; what is left at a block's end becomes sequences of
    2048, 1024, ... tokens, which need no padding. So padding is at most
    ``depth`` x ``bin_tokens`` tokens in a window of rests and none elsewhere.

    Only the histogram, ``window / bin_tokens`` numbers, comes to the driver.
    Ranks and offsets are sums within a block plus the sums of earlier blocks,
    so no bin or stream is gathered. Ids are held as ``dtype``, which must hold
    the vocabulary. A null or empty text is the ``end_id`` alone. Repeated rows
    are documents of their own; an empty table gives an empty result; other
    columns are ignored. The window is a power of two.
    """
    spark, bins = docs.sparkSession, window // bin_tokens
    tokens = staged(spark, tokenized(docs, tokenizer_file, end_id, id_column, text_column, dtype), "pack-ids")
    rests = tokens.select("row", "block", "n", F.expr(f"n div {window}").alias("full"),
                          (F.col("n") % window).alias("rest"))
    rests = rests.withColumn("bin", F.expr(f"(rest + {bin_tokens - 1}) div {bin_tokens}"))
    counts = rests.filter("rest > 0").groupBy("bin", "block").agg(F.count(F.lit(1)).alias("pieces"))
    counts = staged(spark, counts, "pack-counts")
    histogram = {r["bin"]: r["pieces"] for r in counts.groupBy("bin").agg(F.sum("pieces").alias("pieces")).collect()}

    places, begin, first = [], dict.fromkeys(range(1, bins + 1), 0), 0
    for way, times in repeats(histogram, bins, depth):
        for each in sorted(set(way)):
            places.append((each, begin[each], begin[each] + times * way.count(each), way.count(each), first,
                           way.index(each)))
            begin[each] += times * way.count(each)
        first += times
    places = spark.createDataFrame(places, "bin bigint, begin bigint, stop bigint, each bigint, first bigint, "
                                           "place bigint").withColumnRenamed("bin", "place_bin")

    earlier = Window.partitionBy("bin").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("bin", "block", F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("before"))
    local = F.row_number().over(Window.partitionBy("block", "bin").orderBy("row")) - 1
    ranked = rests.withColumn("local", local).join(before, ["bin", "block"], "left").withColumn(
        "rank", F.coalesce("before", F.lit(0)) + F.col("local"))
    # At most bins x depth places, whatever the data: small enough to broadcast.
    placed = ranked.join(F.broadcast(places), (F.col("bin") == F.col("place_bin")) & (F.col("rank") >= F.col("begin"))
                         & (F.col("rank") < F.col("stop")), "left")
    index = F.col("rank") - F.col("begin")
    placed = placed.select("row", "block", "n", "full", "rest",
                           (F.col("first") + F.expr("(rank - begin) div each")).alias("window"),
                           (F.col("place") + index % F.col("each")).alias("place"))
    placed = staged(spark, placed, "pack-places")

    loose = F.when(F.col("window").isNull(), F.col("rest")).otherwise(0)
    blocks = placed.groupBy("block").agg(F.sum("full").alias("fulls"), F.sum(loose).alias("loose"))
    blocks = blocks.withColumn("tail", (F.col("loose") % window).cast("int")).withColumn(
        "streams", F.expr(f"loose div {window}") + F.bit_count("tail"))
    one_each = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    blocks = blocks.select(
        F.col("block").alias("its_block"), "loose", "fulls",
        (F.lit(first) + F.coalesce(F.sum(F.col("fulls") + F.col("streams")).over(one_each), F.lit(0))).alias("base"),
        F.expr("loose - tail").alias("whole"),
        # Ends of the sequences inside the tail: its value cut to ever lower bits.
        F.expr(f"array_distinct(filter(transform(sequence({window.bit_length() - 1}, 0), "
               "p -> shiftleft(shiftright(tail, p), p)), e -> e > 0))").alias("ends"))
    so_far = Window.partitionBy("block").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    streamed = placed.withColumn("fulls_before", F.coalesce(F.sum("full").over(so_far), F.lit(0))).withColumn(
        "from", F.coalesce(F.sum(loose).over(so_far), F.lit(0)))
    streamed = streamed.join(blocks, F.col("block") == F.col("its_block"))

    piece = "struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>"
    fulls = F.expr(f"transform(filter(sequence(0L, full), k -> k < full), k -> named_struct('start', k * {window}L, "
                   f"'length', {window}L, 'sequence_id', base + fulls_before + k, 'offset', 0L))")
    bounds = F.expr(f"""
        array_sort(array_distinct(concat(
            array(from, from + rest),
            filter(array((from div {window} + 1) * {window}L), b -> b < from + rest AND b <= whole),
            filter(transform(ends, e -> whole + e), b -> b > from AND b < from + rest))))""")
    rest_pieces = F.expr(f"""
        transform(slice(bounds, 1, size(bounds) - 1), (b, i) -> named_struct(
            'start', full * {window}L + b - from, 'length', bounds[i + 1] - b,
            'sequence_id', base + fulls + CASE WHEN b < whole THEN b div {window}
                ELSE whole div {window} + size(filter(ends, e -> whole + e <= b)) END,
            'offset', CASE WHEN b < whole THEN b % {window}
                ELSE b - coalesce(array_max(filter(transform(ends, e -> whole + e), e -> e <= b)), whole) END))""")
    none = F.array().cast(f"array<{piece}>")
    loosely = streamed.filter("window IS NULL").withColumn("bounds", bounds).select(
        "row", F.concat(fulls.cast(f"array<{piece}>"),
                        F.when(F.col("rest") > 0, rest_pieces.cast(f"array<{piece}>")).otherwise(none))
        .alias("pieces"))
    in_window = Window.partitionBy("window").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    fitted = streamed.filter("window IS NOT NULL").withColumn(
        "at", F.coalesce(F.sum("rest").over(in_window), F.lit(0)))
    fitted = fitted.select("row", F.concat(fulls.cast(f"array<{piece}>"), F.array(F.struct(
        (F.col("full") * window).alias("start"), F.col("rest").alias("length"), F.col("window").alias("sequence_id"),
        F.col("at").alias("offset"))).cast(f"array<{piece}>")).alias("pieces"))
    pieces = loosely.unionByName(fitted)

    @F.pandas_udf("array<bigint>")
    def checksums(ids: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.Series:
        def each(packed, starts, lengths):
            wide = np.frombuffer(packed, dtype=dtype).astype("<u4")
            return [zlib.crc32(wide[s:s + n].tobytes()) for s, n in zip(starts, lengths)]

        return pd.Series([each(*x) for x in zip(ids, starts, lengths)], dtype=object)

    joined = tokens.select("row", "doc_id", "n", "ids").join(pieces, "row")
    summed = joined.select("doc_id", "n", "pieces", checksums("ids", "pieces.start", "pieces.length").alias("crc"))
    out = summed.select("doc_id", F.col("n").alias("doc_tokens"), F.explode(F.arrays_zip("pieces", "crc")).alias("p"))
    return out.select("doc_id", F.col("p.pieces.start").alias("start"), F.col("p.pieces.length").alias("length"),
                      F.col("p.crc").alias("ids_crc32"), "doc_tokens", F.col("p.pieces.sequence_id").alias("sequence_id"),
                      F.col("p.pieces.offset").alias("offset"))
