"""Silver and gold Parquet: partition-pruned scans and partitioned sinks."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from py4j.protocol import Py4JJavaError

from feedmetrics.functions.times import parse_day
from feedmetrics.operators.quality import filled_cells
from feedmetrics.schemas import GOLD, PLATFORM_FOLDERS, SILVER, gold_partitions, silver_partitions
from feedmetrics.session import run_together
from feedmetrics.sources import files

UNKNOWN = "unknown"
MODES = ("overwrite_partitions", "append", "overwrite")
# Files of as many folders are written at the same time; a task with more folders sorts its rows.
SIDE_BY_SIDE = "spark.sql.maxConcurrentOutputFileWriters"
# What a write has shuffled is removed from the executors' disks as soon as it is done. Otherwise it stays until the
# driver happens to collect its garbage, by when the next tables have shuffled theirs.
NOTHING_LEFT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


# --- sinks -----------------------------------------------------------------

def write_partitioned(df: DataFrame, path: str, partitions: list[str],
                      mode: str = "overwrite_partitions", dealt: bool = False, compression: str = "snappy") -> dict:
    """Writes Parquet by partition columns and reports what was written.

    Null and empty partition values become ``unknown``. The default mode
    replaces only the partitions the rows touch. The rebalance hint gathers a
    partition's rows into files of the advisory size and lets adaptive
    execution split a partition that is too large for one task. Rows that come
    ``dealt`` by partition already are not shuffled again. An empty input
    writes nothing and leaves the table as it is, in every mode.

    Row and filled-cell counts are taken by the write itself. They are
    observed after the rebalance, in the final stage, where Spark counts each
    task once even if stages are run again.
    """
    if mode not in MODES:
        raise ValueError(f"Write mode {mode!r} is none of {MODES}")
    if mode == "overwrite" and df.isEmpty():
        return {"row_count": 0, "non_null_cell_count": 0, "path": path, "written": False, "partitions_written": 0}
    named = df.withColumn("_filled", filled_cells(df.schema)).withColumns(
        {name: F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(UNKNOWN)) for name in partitions})
    seen = Observation()
    # The set holds one entry per folder written, not per row; a dynamic
    # overwrite's commit keeps the same list on the driver.
    counted = (named if dealt else named.hint("rebalance", *partitions)).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum("_filled").alias("filled"),
        F.size(F.collect_set(F.struct(*partitions))).alias("folders"))
    (counted.drop("_filled").write
     .mode("append" if mode == "append" else "overwrite")
     .option("partitionOverwriteMode", "dynamic" if mode == "overwrite_partitions" else "static")
     .option("compression", compression).partitionBy(*partitions).parquet(path))
    counts = observed(seen)
    rows = counts.get("rows") or 0
    return {"row_count": rows, "non_null_cell_count": counts.get("filled") or 0, "path": path,
            "written": rows > 0, "partitions_written": counts.get("folders") or 0}


def observed(seen: Observation) -> dict:
    """The metrics of a write that is done."""
    try:
        return seen.get
    except Py4JJavaError:
        # Spark has no metrics for a plan it proved to be empty.
        return {}


@contextmanager
def set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for the block."""
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _write_tables(spark: SparkSession, tables: dict[str, DataFrame], path_of: Callable[[str], str],
                  partitions_of: Callable[[str], list[str]], mode: str, dealt: Collection[str] = (),
                  compression: str = "snappy", at_once: int = 8) -> dict[str, dict]:
    writes = [partial(write_partitioned, df, path_of(name), partitions_of(name), mode, name in dealt, compression)
              for name, df in tables.items()]
    # Opening files is what a write to many small folders costs. Coalesced to the
    # advisory size they would all be one task's; a folder is still one task's,
    # unless it is large enough to be split.
    # A task that has rows of a few folders writes them side by side, unsorted;
    # with more folders the rest of its rows is sorted by folder.
    with set_for(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false", SIDE_BY_SIDE: "4", **NOTHING_LEFT}):
        return dict(zip(tables, run_together(spark, writes, at_once)))


def write_silver(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                 mode: str = "overwrite_partitions", dealt: Collection[str] = (),
                 compression: str = "snappy") -> dict[str, dict]:
    """Tables with as many rows as the input are written one after the other: the disks hold one table's shuffle."""
    return _write_tables(spark, tables, lambda name: f"{root.rstrip('/')}/{name}", silver_partitions, mode, dealt,
                         compression, at_once=1)


def gold_path(root: str, platform: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{PLATFORM_FOLDERS[platform]}/{dataset}"


def write_gold(spark: SparkSession, tables: dict[str, DataFrame], root: str, platform: str,
               mode: str = "overwrite_partitions") -> dict[str, dict]:
    return _write_tables(spark, tables, lambda name: gold_path(root, platform, name), gold_partitions, mode)


# --- scans -----------------------------------------------------------------

def _read(spark: SparkSession, path: str, schema: T.StructType, at: dict[str, str] | None = None) -> DataFrame:
    """A Parquet folder with the given types; empty when it does not exist.

    The explicit schema also types the partition columns, so ``month=05``
    stays text. With the values of leading partition columns, ``at``, only that
    folder is listed, however long the table's history is.
    """
    folder = "/".join([path, *(f"{name}={value}" for name, value in (at or {}).items())])
    if not files.exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(folder)


def partition_values(table: str, partitions: list[str], platform: str, day: str) -> dict[str, str]:
    """The partition values that hold a platform's day."""
    date = parse_day(day)
    by_name = {"platform": platform, "data_date": date.isoformat(), "year": f"{date.year:04d}",
               "month": f"{date.month:02d}", "day": f"{date.day:02d}"}
    return {name: by_name[name] for name in partitions}


def _at(df: DataFrame, values: dict[str, str]) -> DataFrame:
    for name, value in values.items():
        df = df.where(F.col(name) == value)
    return df


def read_silver(spark: SparkSession, root: str, table: str, platform: str, day: str | None = None) -> DataFrame:
    """A silver table, pruned to the platform and, if given, to the day's partition."""
    values = {"platform": platform}
    if day:
        values = partition_values(table, silver_partitions(table), platform, day)
    leading = {}
    for name in silver_partitions(table):
        if name not in values:
            break
        leading[name] = values[name]
    return _at(_read(spark, f"{root.rstrip('/')}/{table}", SILVER[table], leading), values)


def read_gold(spark: SparkSession, root: str, platform: str, dataset: str, day: str) -> tuple[DataFrame, bool]:
    """The rows of a gold dataset for a day, and whether its files are missing."""
    values = partition_values(dataset, gold_partitions(dataset), platform, day)
    path = gold_path(root, platform, dataset)
    leaf = "/".join([path, *(f"{name}={value}" for name, value in values.items())])
    df = _at(_read(spark, path, GOLD[platform][dataset], values), values)
    return df, not files.has_data_files(spark, leaf)


def read_gold_all(spark: SparkSession, root: str, platform: str, dataset: str) -> DataFrame:
    return _at(_read(spark, gold_path(root, platform, dataset), GOLD[platform][dataset]), {"platform": platform})
