"""Scans of files that hold one JSON array.

Two ways to read the same rows. ``document`` takes any formatting but parses a
file in one task. ``indented`` reads arrays printed with an indent of two
spaces, as the collectors write them: the end of a top-level element is then a
separator the text source can split on, so one file of any size is read by
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmetrics.functions import casts

# Only a top-level element ends at two spaces; deeper ones are indented further
# and a JSON string never holds a raw line break.
_ELEMENT_END = "\n  },"


def array_or_fail(document: Column, path: Column) -> Column:
    """array<variant> of a document, an error at run time when it is no array."""
    return F.coalesce(casts.elements_of(document),
                      F.raise_error(F.concat(F.lit("Expected a JSON array in "), path)))


def documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, document VARIANT: one row per file. Malformed JSON is an error."""
    return (spark.read.text(paths, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.parse_json("value").alias("document")))


def is_indented(spark: SparkSession, path: str) -> bool:
    """Whether a file is an array printed with an indent of two, told by what stands before its first element."""
    head = spark.read.text(path, lineSep="{").first()
    return head is not None and head.value.replace("\r", "") == "[\n  "


def scan_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, seq, item of every array element."""
    items = array_or_fail(F.col("document"), F.col("path"))
    return (documents(spark, paths)
            .select("path", F.posexplode(items).alias("pos", "item"))
            .select("path", _seq(F.lit(0), F.lit(0)), "item"))


def scan_indented(spark: SparkSession, paths: list[str]) -> DataFrame:
    """As scan_documents, with every file split across tasks.

    A piece between two separators is a run of elements whose last one lost
    its closing brace (or, at the end of the file, nothing). It is closed and
    parsed as an array of its own. Position: block offset in the file, then
    the order of pieces within the block, then the order within the piece.
    """
    value = F.col("value")
    last = value.rlike(r"\n\]\s*$") | value.rlike(r"^\s*\[\s*\]\s*$")
    opened = F.regexp_replace(value, r"^\s*\[", "")
    closed = (F.when(last, F.concat(F.lit("["), opened))
              .otherwise(F.concat(F.lit("["), opened, F.lit("\n}]"))))
    pieces = (spark.read.text(paths, lineSep=_ELEMENT_END)
              .select(F.col("_metadata.file_path").alias("path"),
                      F.col("_metadata.file_block_start").alias("block"),
                      F.monotonically_increasing_id().alias("piece"), "value")
              .where(F.trim("value") != "")
              .select("path", "block", "piece", F.parse_json(closed).alias("run")))
    items = array_or_fail(F.col("run"), F.col("path"))
    return (pieces.select("path", "block", "piece", F.posexplode(items).alias("pos", "item"))
            .select("path", _seq(F.col("block"), F.col("piece")), "item"))


def _seq(block: Column, piece: Column) -> Column:
    return F.struct(F.col("path"), block.cast("bigint").alias("block"), piece.cast("bigint").alias("piece"),
                    F.col("pos").cast("bigint").alias("pos")).alias("seq")
