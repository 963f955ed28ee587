"""What the corpus operators share: words, buckets of documents, staged tables."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics.session import scratch_dir

# A word is a run of anything but space and the five ASCII line and tab characters.
# ``bytes.split()`` cuts at exactly these, which Python's ``str.split()`` does not.
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; a null text has none."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def text_of(column: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(id_column: str, folds: int) -> Column:
    """True for the rows of fold 0; a null id counts as the empty string, which is in fold 0."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % folds == 0


def staged(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """Writes rows as Parquet to the shared folder and reads them back.

    What is built on the result no longer depends on the tasks that made it, so
    a lost executor costs one read. ``clear_staged`` removes the folders.
    """
    path = scratch_dir(spark, f"llm-{purpose}")
    rows.write.option("compression", "zstd").parquet(path)
    _STAGED.append(path)
    return spark.read.schema(rows.schema).parquet(path)


_STAGED: list[str] = []


def clear_staged(spark: SparkSession) -> None:
    """Removes all tables staged so far; call it once the results are written."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    while _STAGED:
        path = hadoop.Path(_STAGED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Lets the driver give back what finished work left: plans that Python still held, their broadcasts, free heap."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
