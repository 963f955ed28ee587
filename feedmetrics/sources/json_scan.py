"""Structural scan: JSON files of any formatting, each read by many tasks.

The text source cuts a file at its closing braces, wherever its splits lie.
Chunks of a split that follow each other are joined to pieces of about a MiB,
which are staged. A piece alone does not tell whether it begins inside a string,
nor how deep, so of each is told what it does to the depth in both cases. A
running sum over the pieces of a file (one row of numbers each) tells in which
state every piece begins. With that, the braces that end a top-level element
are known, and a piece is cut behind them: a few elements, or one, make a run,
JSON text that is parsed on its own. Only a run that goes from one piece into
the next is put together across tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from feedmetrics.functions import casts
from feedmetrics.session import shared_dir
from feedmetrics.sources import files
from feedmetrics.sources.json_arrays import array_or_fail

# The functions that run in Python workers travel by value, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_START = Window.unboundedPreceding
# Stand-ins in the text of a run that is parsed on its own: what was open before it, and where it stops.
_CARRIED, _MARK = "feedmetrics_carried", "feedmetrics_mark"
# Depths behind the closing braces that end a run, by the first character of a file.
_LEVELS = {"[": [1], "{": [1, 2]}
# Bytes from which on a run takes no further element. Elements of a run share their field names.
_RUN = 1 << 13
# Bytes from which on a piece takes no further chunk.
_PIECE = 1 << 20
_PIECES = "file bigint, block bigint, piece bigint, text binary, quotes int, out bigint, in bigint, head string"
_RUNS = "path string, block bigint, nth bigint, value string, root string, done boolean, start bigint, stop bigint, low bigint"
# What a byte does: an opening bracket, a closing one, a quote.
_QUOTE = 2
_KINDS = np.zeros(256, dtype=np.int8)
_KINDS[list(b"[{")], _KINDS[list(b"]}")], _KINDS[list(b'"')] = 1, -1, _QUOTE


def _with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns out of a generator, which keeps the optimizer from copying them into their uses."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))


_STATE = {"file": "bigint", "block": "bigint", "piece": "bigint", "path": "string", "root": "string", "inside": "int",
          "depth": "bigint", "unclosed": "boolean"}


def _chunks(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, block, text up to and with each closing brace; one more brace stands behind a file without one."""
    return spark.read.text(paths, lineSep="}").select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.concat("value", F.lit("}")).cast("binary").alias("text"))


def _rows(spans: Iterator[tuple], schema: str) -> pa.RecordBatch:
    types = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    return pa.record_batch([pa.array(column, types[kind]) for column, (_, kind) in zip(zip(*spans), fields)],
                           names=[name for name, _ in fields])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    """(file, block, bytes): the rows of a batch that belong to one split, joined."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        text = batch.column(2)
        at = np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset:text.offset + batch.num_rows + 1]
        turns = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for first, end in zip([0, *turns], [*turns, batch.num_rows]):
            yield int(file[first]), int(block[first]), text.buffers()[2][int(at[first]):int(at[end])].to_pybytes()


def _marks(data: np.ndarray, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of brackets, what each does to the depth, whether it stands in a string; and the state at the end.

    A piece ends with a closing brace, which is never escaped, so none cuts an escape.
    """
    kinds = _KINDS[data]
    at = np.flatnonzero(kinds)
    slashes = np.flatnonzero(data == ord("\\"))
    if len(slashes):
        begins = np.where(np.diff(slashes, prepend=-2) > 1, slashes, 0)
        escaped = np.zeros(len(data) + 1, dtype=bool)
        escaped[slashes[(slashes - np.maximum.accumulate(begins)) % 2 == 0] + 1] = True
        at = at[~escaped[at]]
    kinds = kinds[at]
    quotes = kinds == _QUOTE
    within = (np.cumsum(quotes) + inside) % 2
    bracket = ~quotes
    return at[bracket], kinds[bracket], within[bracket] == 1, (inside + int(quotes.sum())) % 2


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces: text, quotes, what it does to the depth if it begins outside or inside a string, first character."""

    def piece(key: tuple[int, int], number: int, texts: list[bytes]) -> pa.RecordBatch:
        text = b"".join(texts)
        _, moves, within, quotes = _marks(np.frombuffer(text, dtype=np.uint8), 0)
        head = text.lstrip(b" \t\n\v\f\r")[:1].decode("latin-1")
        return _rows([(*key, number, text, quotes, int(moves[~within].sum()), int(moves[within].sum()), head)], _PIECES)

    key, number, texts, size = None, 0, [], 0
    for file, block, text in _texts(batches):
        if texts and (key != (file, block) or size >= _PIECE):
            yield piece(key, number, texts)
            number, texts, size = number + 1, [], 0
        if key != (file, block):
            key, number = (file, block), 0
        texts.append(text)
        size += len(text)
    if texts:
        yield piece(key, number, texts)


def _found_pieces(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, set[tuple[str, str]]]:
    """Pieces with the state in which each begins; and path and first character of every file.

    A row of numbers per piece comes to the driver. A file that is empty or
    whose brackets do not match up is an error.
    """
    for path in paths:
        if not files.size(spark, path):
            raise ValueError(f"{path} is empty")
    path = F.col("_metadata.file_path")
    listed = {row.file: row for row in spark.read.format("binaryFile").load(paths).select(
        F.xxhash64(path).alias("file"), path.alias("path"), "length").collect()}
    shared_dir(spark)
    pieces = _chunks(spark, paths).mapInArrow(_joined, _PIECES).checkpoint()
    rows: dict[int, list] = {file: [] for file in listed}
    for row in pieces.select("file", "block", "piece", "quotes", "out", "in", "head",
                             F.octet_length("text").alias("bytes")).collect():
        rows[row.file].append(row)
    states, roots = [], set()
    for file, own in rows.items():
        own.sort(key=lambda row: (row.block, row.piece))
        inside, depth, path, root = 0, 0, listed[file].path, own[0]["head"]
        # Every chunk was counted with a brace behind it; the text source drops a byte order mark.
        unclosed = sum(row.bytes for row in own) - listed[file].length in (1, -2)
        for row in own:
            states.append((file, row.block, row.piece, path, root, inside, depth, unclosed and row is own[-1]))
            depth += row["in"] if inside else row.out
            inside = (inside + row.quotes) % 2
        if inside or depth + unclosed != 0:
            raise ValueError(f"Malformed JSON in {path}")
        roots.add((path, root))
    known = spark.createDataFrame(pd.DataFrame(states, columns=_STATE), ", ".join(f"{n} {t}" for n, t in _STATE.items()))
    return pieces.select("file", "block", "piece", "text").join(F.broadcast(known), ["file", "block", "piece"]), roots


def _runs_of(text: bytes, root: str, inside: int, depth: int, unclosed: bool) -> Iterator[tuple]:
    """(nth, value, done, start, stop, low) of the runs of a piece."""
    data = np.frombuffer(text, dtype=np.uint8)
    at, moves, within, _ = _marks(data, inside)
    at, depths = at[~within], depth + np.cumsum(moves[~within], dtype=np.int64)
    ends = np.flatnonzero((data[at] == ord("}")) & np.isin(depths, _LEVELS.get(root, [])))
    nth, begin, start = 0, 0, depth
    if len(ends):
        stops = at[ends] + 1
        lows = np.minimum.reduceat(depths[:ends[-1] + 1], np.r_[0, ends[:-1] + 1])
        lows = np.minimum(lows, np.r_[depth, depths[ends[:-1]]])
        # Nothing joins the first run, nor a run through the object itself.
        turn = (lows < 2) & (root == "{")
        alone = turn | np.r_[turn[1:], True]
        alone[0] = True
        alone, first = np.flatnonzero(alone), 0
        while first < len(ends):
            last = max(first, int(np.searchsorted(stops, begin + _RUN, "right")) - 1)
            last = min(last, int(alone[np.searchsorted(alone, first)]))
            stop = int(depths[ends[last]])
            yield nth, text[begin:stops[last]], True, start, stop, int(lows[first:last + 1].min())
            nth, begin, start, first = nth + 1, int(stops[last]), stop, last + 1
    if begin < len(text):
        left = depths[ends[-1] + 1:] if len(ends) else depths
        stop, low = (int(left[-1]), min(start, int(left.min()))) if len(left) else (start, start)
        yield nth, text[begin:-1] if unclosed else text[begin:], False, start, stop, low


def _cut(pieces: DataFrame, inner: bool) -> DataFrame:
    """path, block, nth, value, root, done, start, stop, low of runs: of those within a piece, or of all others.

    A run ends behind a closing brace after which the depth is one of the
    levels of its file. ``done`` is false for what follows the last such brace.
    ``start`` and ``stop`` are the depths before and after a run, ``low`` is the
    lowest on the way. The others are the first and the last run of a piece and,
    in an object, those that go through the object itself. ``nth`` counts on
    through the pieces of a split.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                root, spans = row["root"], []
                for nth, value, done, start, stop, low in _runs_of(row["text"], root, row["inside"], row["depth"], row["unclosed"]):
                    if inner == (nth > 0 and done and not (root == "{" and low < 2)):
                        spans.append((row["path"], row["block"], row["piece"] << 32 | nth, value, root, done, start, stop, low))
                if spans:
                    yield _rows(spans, _RUNS)

    return pieces.mapInArrow(cut, _RUNS)


def _stitched(edges: DataFrame) -> DataFrame:
    """Runs put together that go on in other pieces; a piece has two that may."""

    def joined(place: Column, text: str) -> Column:
        parts = F.array_sort(F.collect_list(F.struct(place.alias("place"), F.col(text).alias("text"))))
        return F.array_join(F.transform(parts, lambda part: part["text"]), "")

    order, place = Window.partitionBy("path").orderBy("block", "nth"), F.struct("block", "nth")
    chained = edges.withColumn("chain", F.coalesce(F.sum(F.col("done").cast("int")).over(order.rowsBetween(_START, -1)),
                                                   F.lit(0)))
    return chained.groupBy("path", "chain").agg(
        F.min(place).alias("place"), joined(place, "value").alias("value"), F.first("root").alias("root"),
        F.max("done").alias("done"), F.min_by("start", place).alias("start"), F.max_by("stop", place).alias("stop"),
        F.min("low").alias("low")).select("path", "place.*", "value", "root", "done", "start", "stop", "low")


def _alone(text: Column) -> Column:
    """JSON text as VARIANT, null where it is not one value; what follows a value is not left unread."""
    parsed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(F.try_variant_get(parsed, "$[1]", "variant").isNull(), casts.field(parsed, "$[0]"))


def _malformed() -> Column:
    return F.raise_error(F.concat(F.lit("Malformed JSON in "), F.col("path")))


def _seq() -> Column:
    return F.struct("path", F.col("block").cast("bigint").alias("block"), F.col("nth").cast("bigint").alias("piece"),
                    F.col("pos").cast("bigint").alias("pos")).alias("seq")


def _array_items(runs: DataFrame) -> DataFrame:
    """The elements of runs of a top-level array, or of runs within one.

    A run that does not begin its array starts with a comma, or closes it. A
    zero is put before it and left out again, so that only valid JSON passes.
    """
    begins = (F.col("block") == 0) & (F.col("nth") == 0)
    text = F.concat(F.when(begins, "").otherwise("[0"), "value", F.when(F.col("done"), "]").otherwise(""))
    opened = _with_once(runs.withColumn("begins", begins), run=F.coalesce(_alone(text), _malformed().cast("variant")))
    return (opened.select("path", "block", "nth", "begins", F.posexplode(
            array_or_fail(F.col("run"), F.col("path"))).alias("pos", "item"))
            .where("begins OR pos > 0").select("path", "block", "nth", "pos", "item"))


def scan_arrays(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, seq, item of every element of files that hold one JSON array each, however printed.

    A file that holds something else, or malformed JSON, is an error.
    """
    pieces, roots = _found_pieces(spark, paths)
    for path, root in sorted(roots):
        if root != "[":
            raise ValueError(f"Expected a JSON array in {path}")
    runs = _cut(pieces, True).unionByName(_stitched(_cut(pieces, False)))
    return _array_items(runs).select("path", _seq(), "item")


def scan_payloads(spark: SparkSession, paths: list[str], keys: tuple[str, str] = ("tweets", "data")) -> DataFrame:
    """path, seq, item of the posts of payload files: an array, or an object with one under one of ``keys``.

    The first key that holds an array counts. Any other document has no posts.
    Of an object, a run is whole elements of one inner container, or it goes
    through the object itself: these turns, a few for each member, are parsed
    with stand-ins for what is open before and after them and tell which member
    is open from there on. Elements of other members are not parsed.
    """
    pieces, roots = _found_pieces(spark, paths)
    inner, others = _cut(pieces, True), _stitched(_cut(pieces, False))
    kinds, found = {root for _, root in roots}, []
    if "[" in kinds:
        found.append(_array_items(inner.unionByName(others).where("root = '['")))
    if kinds - {"[", "{"}:
        # Neither array nor object: parsed for the sake of errors, without posts.
        found.append(others.where("root NOT IN ('[', '{')").select("path", "block", "nth", F.posexplode(
            casts.elements_of(F.coalesce(_alone(F.col("value")), _malformed().cast("variant")))).alias("pos", "item")))
    if "{" in kinds:
        found += _object_items(inner.where("root = '{'"), others.where("root = '{'"), keys)
    return reduce(DataFrame.unionByName, found).select("path", _seq(), "item")


def _object_items(inner: DataFrame, others: DataFrame, keys: tuple[str, str]) -> list[DataFrame]:
    """path, block, nth, pos, item of the chosen member's elements: those in turns, and those between."""
    turns = _turns(others.where("low < 2"), keys)
    order = Window.partitionBy("path").orderBy("block", "nth")
    turns = turns.withColumn("came", F.lag("open").over(order))
    has = [F.max(F.col(key).isNotNull()).over(Window.partitionBy("path")) for key in keys]
    turns = turns.withColumn("chosen", F.when(has[0], F.lit(keys[0])).when(has[1], F.lit(keys[1])))
    posts = F.concat(*(F.coalesce(F.when(condition, F.col(name)), F.array().cast("array<variant>"))
                       for name, condition in [("carried", F.col("came") == F.col("chosen")),
                                               *((key, F.col("chosen") == key) for key in keys)]))
    in_turns = turns.select("path", "block", "nth", F.posexplode(posts).alias("pos", "item"))

    # Where the chosen member is open: from one turn to the next, a row or two for each file.
    following = F.lead(F.struct("block", "nth")).over(order)
    spans = turns.select(F.col("path").alias("its_path"), F.struct("block", "nth").alias("from"), following.alias("to"),
                         "open", "chosen").where("open = chosen").select("its_path", "from", "to")
    place = F.struct("block", "nth")
    whole = inner.unionByName(others.where("low >= 2"))
    within = whole.join(F.broadcast(spans), (F.col("path") == F.col("its_path")) & (place > F.col("from")) & (place < F.col("to")))
    return [in_turns, _array_items(within)]


def _turns(runs: DataFrame, keys: tuple[str, str]) -> DataFrame:
    """path, block, nth, carried, one column per key, open: the arrays that a run has elements of."""
    opening = (F.when(F.col("start") <= 0, F.array(F.lit("")))
               .when(F.col("start") == 1, F.array(F.lit(f'{{"{_CARRIED}":0')))
               .otherwise(F.array(F.lit(f'{{"{_CARRIED}":[0'), F.lit(f'{{"{_CARRIED}":{{"{_CARRIED}":0'))))
    closing = (F.when(~F.col("done"), F.array(F.lit(""))).when(F.col("stop") == 1, F.array(F.lit("}")))
               .otherwise(F.array(F.lit(f',"{_MARK}"]}}'), F.lit(f',"{_MARK}":0}}}}'))))
    # Which kind of container is open before and behind the run is seen by what can be parsed.
    texts = F.flatten(F.transform(opening, lambda o: F.transform(closing, lambda c: F.concat(o, F.col("value"), c))))
    tried = F.get(F.array_compact(F.transform(texts, _alone)), 0)
    opened = _with_once(runs.select("path", "block", "nth", "value", "done", "start", "stop"),
                        document=F.coalesce(tried, _malformed().cast("variant")))
    arrays = _with_once(opened.select("path", "block", "nth", "document"),
                        carried=casts.elements_of(F.col("document"), f"$.{_CARRIED}"),
                        **{key: casts.elements_of(F.col("document"), f"$.{key}") for key in keys})

    def marked(name: str) -> Column:
        return F.coalesce(F.try_variant_get(F.get(F.col(name), F.size(name) - 1), "$", "string") == _MARK, F.lit(False))

    def unmarked(name: str) -> Column:
        return F.when(marked(name), F.slice(F.col(name), 1, F.size(name) - 1)).otherwise(F.col(name))

    open_key = F.lit("")
    for key in keys:
        open_key = F.when((F.size(key) > 0) & marked(key), F.lit(key)).otherwise(open_key)
    return arrays.select(
        "path", "block", "nth", open_key.alias("open"), *(unmarked(key).alias(key) for key in keys),
        F.coalesce(F.slice("carried", 2, F.greatest(F.size("carried") - 1, F.lit(0))),
                   F.array().cast("array<variant>")).alias("carried"))
