"""Cross-tokenizer alignment: merge-path partitioning of the token ends of two tokenizers."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedmetrics.llm.base import staged, text_of
from feedmetrics.llm.packing import byte_letters

# Fixed value: how byte-level BPE cuts a text before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters whose class is the same in every Unicode version that a regex library may carry.
SETTLED = re.compile("[\x00-ɏΑ-ΡΣ-ώЁ-я‐-‧‰-⁞€"
                     "　-〩ぁ-ゖァ-ヺ一-龥가-힣]*")


class ByteLevel:
    """Ids and token bytes of a byte-level BPE tokenizer file.

    Texts of settled characters are encoded by ranks, which gives the same ids
    several times as fast; the rest, and all texts where the file's merges are
    not in the order of its ids, by the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        settings = json.loads(self.tokenizer.to_str())
        byte_of = {letter: byte for byte, letter in byte_letters().items()}
        vocabulary = settings["model"]["vocab"]
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in byte_of for c in token):
                self.bytes[number] = bytes(byte_of[c] for c in token)
        special = {t["id"] for t in settings["added_tokens"]}
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in settings["model"]["merges"]]
        cut = settings["pre_tokenizer"]
        self.ranked = None
        if (merged == list(range(256, 256 + len(merged))) and settings["normalizer"] is None
                and cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"]):
            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                b: i for i, b in enumerate(self.bytes) if i not in special})

    def __call__(self, text: str) -> list[int]:
        if self.ranked and SETTLED.fullmatch(text):
            try:
                return self.ranked.encode_ordinary(text)
            except BaseException as error:  # the regex library's panic over a very long run of spaces
                if type(error).__name__ != "PanicException":
                    raise
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids and token bytes of a SentencePiece model, which puts a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        self.bytes = [bytes([int(name[3:5], 16)]) if self.processor.is_byte(i)
                      else name.replace("▁", " ").encode("utf-8") for i, name in enumerate(names)]

    def __call__(self, text: str) -> list[int]:
        return self.processor.encode(text)


class Pair:
    """Both tokenizers, the bytes and lengths of their tokens, and how their ids are written in groups."""

    def __init__(self, a_file: str, b_file: str):
        self.a, self.b = ByteLevel(a_file), Pieces(b_file)
        self.a_lengths = np.array(list(map(len, self.a.bytes)), dtype=np.int64)
        self.b_lengths = np.array(list(map(len, self.b.bytes)), dtype=np.int64)
        written = [f"{i}{end}" for ids, ends in ((len(self.a.bytes), ",|"), (len(self.b.bytes), ",;"))
                   for i in range(ids) for end in ends]
        self.written = np.array(written, dtype=object)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids by both tokenizers; none where a tokenizer's bytes are not those of space and text."""
        none = np.zeros(0, dtype=np.int32)
        if not text:
            return none, none
        whole = b" " + text.encode("utf-8", "replace")
        b = self.b(text)
        if b"".join(map(self.b.bytes.__getitem__, b)) != whole:
            return none, none
        b = np.array(b, dtype=np.int32)
        a = self.a(f" {text}")
        if b"".join(map(self.a.bytes.__getitem__, a)) != whole:
            return none, none
        return np.array(a, dtype=np.int32), b


@lru_cache(maxsize=2)
def loaded(a_file: str, b_file: str) -> Pair:
    """Both tokenizers, read once in each Python worker."""
    return Pair(a_file, b_file)


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two rising arrays is cut: after ``work``, 2 ``work``, ... steps, ``i`` of a and ``j`` of b.

    A binary search along each diagonal i + j = steps, all at once. Of equal
    values that of a comes first.
    """
    steps = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (wide := np.flatnonzero(low < high)).size:
        middle = (low[wide] + high[wide]) // 2
        before = a[middle] <= b[steps[wide] - 1 - middle]
        low[wide] = np.where(before, middle + 1, low[wide])
        high[wide] = np.where(before, high[wide], middle)
    return low, steps - low


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One piece of a merge of ends: (a token, b token) of each stretch of bytes that lies in both, in two halves.

    The first two arrays hold, for each a token, the b token in which it ends;
    the others, for each b token in which no a token of the piece ends together
    with it, the a token open there and the b token. Numbers count from the
    piece's begin; one past its last token means the token open at its end.
    """
    b_at = np.searchsorted(b, a, "left")
    a_at = np.searchsorted(a, b, "right")
    alone = np.ones(len(b), dtype=bool)
    alone[a_at > 0] = a[a_at[a_at > 0] - 1] != b[a_at > 0]
    return np.arange(len(a)), b_at, a_at[alone], np.flatnonzero(alone)


def joint_ends(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (of a, of b) that end together, from rising ends: these tokens close the groups.

    The merge is divided on diagonals into pieces of ``work`` steps that need
    nothing of each other. A piece's stretches say where both ends meet inside
    it. Only a piece's last a token can end with a b token that the cut left to
    the next piece; there the two pieces are stitched.
    """
    i, j = diagonals(a, b, work)
    found_a, found_b = [], []
    for k in range(len(i) - 1):
        own_a, own_b = a[i[k]:i[k + 1]], b[j[k]:j[k + 1]]
        a_token, b_token, _, _ = overlaps(own_a, own_b)
        inside = b_token < len(own_b)
        meet = np.zeros(len(own_a), dtype=bool)
        meet[inside] = own_b[b_token[inside]] == own_a[inside]
        if len(own_a) and not inside[-1] and j[k + 1] < len(b):
            meet[-1] = own_a[-1] == b[j[k + 1]]
        found_a.append(a_token[meet] + i[k])
        found_b.append(b_token[meet] + j[k])
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _starts(counts: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


ROWS = ("block bigint, doc_id string, n_a bigint, n_b bigint, n_groups bigint, groups string, ends binary, "
        "links binary, a int, b int, n bigint")
COLUMNS = [c.split()[0] for c in ROWS.split(", ")]


def _frame(**given) -> pd.DataFrame:
    return pd.DataFrame({c: given.get(c) for c in COLUMNS})


def align_block(pair: Pair, block: int, ids: list, texts: list, work: int) -> Iterator[pd.DataFrame]:
    """Rows of the documents of a block (one at least), then its id pairs with their counts, in the order of (a, b).

    The documents lie end to end, so one merge serves the block: both tokenizers
    end where a document ends.
    """
    both = [pair.tokens(t) for t in texts]
    a_from, b_from = _starts([len(a) for a, _ in both]), _starts([len(b) for _, b in both])
    a, b = (np.concatenate(own) for own in zip(*both))
    del both
    a_ends, b_ends = np.cumsum(pair.a_lengths[a]), np.cumsum(pair.b_lengths[b])
    a_last, b_last = joint_ends(a_ends, b_ends, work)

    # Tokens in the order in which groups are written: a group's a tokens, then its b tokens.
    order = np.empty(len(a) + len(b), dtype=np.int32)
    a_closes, b_closes = np.zeros(len(a), dtype=np.int32), np.zeros(len(b), dtype=np.int32)
    a_closes[a_last], b_closes[b_last] = 1, 1
    a_group, b_group = np.cumsum(a_closes) - a_closes, np.cumsum(b_closes) - b_closes
    order[np.arange(len(a)) + np.concatenate([[0], b_last + 1])[a_group]] = 2 * a + a_closes
    order[np.arange(len(b)) + (a_last + 1)[b_group]] = 2 * (b + len(pair.a.bytes)) + b_closes

    group_from = np.searchsorted(a_last, a_from)
    codes, links = np.unique((a[a_last].astype(np.int64) << 32) | b[b_last], return_inverse=True)
    links, stops = links.astype("<u4"), a_ends[a_last]
    begins = np.concatenate([[0], a_ends])[a_from]
    groups, ends, packed = [], [], []
    for k in range(len(ids)):
        own = order[a_from[k] + b_from[k]:a_from[k + 1] + b_from[k + 1]]
        groups.append("".join(pair.written[own].tolist())[:-1])
        at = slice(group_from[k], group_from[k + 1])
        ends.append((stops[at] - begins[k]).astype("<u4").tobytes())
        packed.append(links[at].tobytes())
    yield _frame(block=block, doc_id=ids, n_a=np.diff(a_from), n_b=np.diff(b_from), n_groups=np.diff(group_from),
                 groups=groups, ends=ends, links=packed)
    if len(codes):
        yield _frame(block=block, a=(codes >> 32).astype(np.int32), b=(codes & 0xFFFFFFFF).astype(np.int32),
                     n=np.bincount(links, minlength=len(codes)))


def _sums(packs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """n_best and count_sum of a block's documents, from the corpus-wide counts of its id pairs."""
    counts = counts.sort_values(["a", "b"])
    total, best = counts["count"].to_numpy(np.int64), counts["best"].to_numpy(bool)
    n_best, sums = [], []
    for packed in packs["links"]:
        own = np.frombuffer(packed, "<u4")
        n_best.append(int(best[own].sum()))
        sums.append(int(total[own].sum()))
    return packs.drop(columns=["links"]).assign(n_best=n_best, count_sum=sums)


def aligned(docs: DataFrame, a_file: str, b_file: str, id_column: str = "doc_id", text_column: str = "text",
            block_bytes: int = 2 << 20, work: int = 1 << 16,
            keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, groups, ends, n_links, n_best, count_sum.

    A text, with a space before it, is encoded by a byte-level tokenizer (A) and
    a SentencePiece model (B). The bytes where tokens of both end cut the tokens
    into groups. ``groups`` writes them as ids, ``a1,a2|b1;a3|b2,b3``; ``ends``
    holds the bytes, counted from the space, as little-endian 32-bit numbers. A
    link is an A token and a B token that end together, that is, a group's last
    two. The count of an id pair is the number of its links in all documents:
    ``count_sum`` adds it up over a document's links, ``n_best`` counts the links
    whose pair no other pair with the same B id exceeds.

    Each block of about ``block_bytes`` of text reports an id pair once, with
    its count, and gets the corpus-wide counts of its own pairs back, so what is
    shuffled is bounded by the text. Only the highest count of each B id, at
    most a row for each id of B's vocabulary, is broadcast. ``keep`` may replace
    ``groups`` and ``ends`` by what is wanted of them before rows are staged.

    A null or empty text has no tokens, nor has one whose token bytes are not
    those of the space and the text (as where it has U+2581 itself): its numbers
    are 0 and its ``groups`` empty. Repeated rows are texts of their own; an
    empty table gives an empty result; other columns are ignored.
    """
    spark, kind = docs.sparkSession, docs.schema[id_column].dataType

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair, block = loaded(a_file, b_file), TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, texts, at = batch["doc_id"].tolist(), batch["text"].tolist(), 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and size < block_bytes:
                    size += len(texts[stop])
                    stop += 1
                yield from align_block(pair, block, ids[at:stop], texts[at:stop], work)
                block, at = block + 1, stop

    texts = docs.select(F.col(id_column).cast("string").alias("doc_id"), text_of(text_column).alias("text"))
    rows = texts.mapInPandas(run, ROWS)
    rows = staged(spark, keep(rows) if keep else rows, "align-blocks")
    pairs = rows.filter("a IS NOT NULL").select("block", "a", "b", "n")
    counts = staged(spark, pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "align-counts")
    highest = counts.groupBy(F.col("b").alias("best_b")).agg(F.max("count").alias("highest"))
    counts = counts.join(F.broadcast(highest), F.col("b") == F.col("best_b")).select(
        "a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    known = pairs.select("block", "a", "b").join(counts, ["a", "b"])

    found = rows.filter("links IS NOT NULL").drop("a", "b", "n").withColumnRenamed("block", "own_block")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "links")
    summed = found.groupBy("own_block").cogroup(known.groupBy("block")).applyInPandas(
        lambda packs, own: _sums(packs, own), f"{schema}, n_best bigint, count_sum bigint")
    return summed.drop("own_block").withColumn("doc_id", F.col("doc_id").cast(kind)).withColumn(
        "n_links", F.col("n_groups"))
