"""Warehouse tables: definitions, replace-by-date loads in versions, load report."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window, functions as F, types as T

from feedmetrics.functions.times import parse_day
from feedmetrics.operators.quality import conform
from feedmetrics.schemas import (GOLD, PLATFORM_KEYS, WAREHOUSE, date_column, gold_partitions, warehouse_schema,
                                 warehouse_table)
from feedmetrics.session import run_together
from feedmetrics.sources import files, lake

LOG = "load_log"


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """The load log and, for each of the twelve tables, its versions and the view of its current rows.

    What a load writes is a version of its own: partitions under its load id,
    which nothing shows yet. One append of one file to the log makes the load's
    versions of all its tables current, so readers see all of a load or none of
    it, and a load whose driver is lost has changed nothing.

    Existing tables stay. Partitions that the location holds already, written
    through another catalog, are registered with a new table.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{LOG} (table_name string, platform string, day date, "
              f"load_id string, seq bigint, row_count bigint) USING parquet LOCATION '{location}/{LOG}'")
    for name, (platform, dataset) in WAREHOUSE.items():
        schema, versions = warehouse_schema(platform, dataset), f"{name}_versions"
        if not spark.catalog.tableExists(f"{database}.{versions}"):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"CREATE TABLE {database}.{versions} ({columns}, load_id string) USING parquet "
                      f"PARTITIONED BY (load_id, platform, {date_column(schema)}) LOCATION '{location}/{versions}'")
            if files.exists(spark, f"{location}/{versions}"):
                spark.sql(f"ALTER TABLE {database}.{versions} RECOVER PARTITIONS")
        # The join's keys are partition columns: old versions' folders are pruned by what the log says.
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS "
                  f"SELECT {', '.join(f'v.`{f.name}`' for f in schema)} FROM {database}.{versions} v "
                  f"JOIN (SELECT platform, day, max_by(load_id, struct(seq, load_id)) AS load_id "
                  f"FROM {database}.{LOG} WHERE table_name = '{name}' GROUP BY platform, day) c "
                  f"ON v.load_id = c.load_id AND v.platform = c.platform AND v.{date_column(schema)} = c.day")


def table_schema(table: str) -> T.StructType:
    if table not in WAREHOUSE:
        raise ValueError(f"There is no warehouse table {table!r}")
    return warehouse_schema(*WAREHOUSE[table])


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """The current rows of a warehouse table in its documented column order."""
    return spark.table(f"{database}.{table}").select(*table_schema(table).names)


def write_version(spark: SparkSession, database: str, load_id: str, table: str, rows: DataFrame, day: str) -> int:
    """Writes a platform's rows of a day as a version that is not current yet; how many there are."""
    schema = table_schema(table)
    dates = date_column(schema)
    conformed = conform(rows, schema).where(
        (F.col("platform") == WAREHOUSE[table][0]) & (F.col(dates) == parse_day(day)))
    keys = ("load_id", "platform", dates)
    seen = Observation()
    (conformed.withColumn("load_id", F.lit(load_id)).observe(seen, F.count(F.lit(1)).alias("rows"))
     .select(*(name for name in schema.names if name not in keys), *keys)
     .write.mode("append").insertInto(f"{database}.{table}_versions"))
    return lake.observed(seen).get("rows") or 0


def commit(spark: SparkSession, database: str, load_id: str, counts: dict[str, int], day: str) -> None:
    """Makes a load's versions of these tables current, all at once: one row each, in one file of the log.

    A table without rows is current without rows. Of loads that commit at the
    same time one wins, the same one in all tables.
    """
    seq = spark.table(f"{database}.{LOG}").agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0] + 1
    rows = [(table, WAREHOUSE[table][0], parse_day(day), load_id, seq, count) for table, count in counts.items()]
    log = spark.createDataFrame(rows, spark.table(f"{database}.{LOG}").schema)
    log.coalesce(1).write.mode("append").insertInto(f"{database}.{LOG}")


def replace_date(spark: SparkSession, database: str, table: str, rows: DataFrame, day: str) -> None:
    """Replaces the platform's rows of a day; without rows the day is cleared."""
    load_id = uuid.uuid4().hex
    commit(spark, database, load_id, {table: write_version(spark, database, load_id, table, rows, day)}, day)


def drop_superseded(spark: SparkSession, database: str, lost: Iterable[str] = ()) -> int:
    """Removes the versions that later loads replaced, and those of loads named as lost; how many partitions.

    Versions that the log does not know may belong to a load that runs, so they
    go only when named. Readers that began before a replacement may still need
    its old version: call this when they are done.
    """
    log = spark.table(f"{database}.{LOG}")
    newest = Window.partitionBy("table_name", "platform", "day").orderBy(F.desc("seq"), F.desc("load_id"))
    old = log.withColumn("nth", F.row_number().over(newest)).where("nth > 1 AND row_count > 0")
    dropped = 0
    for table in WAREHOUSE:
        dates, versions = date_column(table_schema(table)), f"{database}.{table}_versions"
        gone = {(r.load_id, r.platform, str(r.day)) for r in old.where(F.col("table_name") == table).collect()}
        for row in spark.sql(f"SHOW PARTITIONS {versions}").collect():
            values = dict(part.split("=", 1) for part in row.partition.split("/"))
            if (values["load_id"], values["platform"], values[dates]) not in gone and values["load_id"] not in lost:
                continue
            spec = f"load_id = '{values['load_id']}', platform = '{values['platform']}', {dates} = DATE '{values[dates]}'"
            path = spark.sql(f"DESCRIBE EXTENDED {versions} PARTITION ({spec})").where(
                "col_name = 'Location'").first()["data_type"]
            spark.sql(f"ALTER TABLE {versions} DROP IF EXISTS PARTITION ({spec})")
            files.delete(spark, path)
            dropped += 1
    return dropped


def day_rows(spark: SparkSession, database: str, table: str, day: str) -> DataFrame:
    """The rows a table holds for its platform's day."""
    dates = date_column(table_schema(table))
    return (read_table(spark, database, table)
            .where((F.col("platform") == WAREHOUSE[table][0]) & (F.col(dates) == parse_day(day))))


# --- loading several tables -------------------------------------------------

@dataclass
class Load:
    """One gold dataset on its way into the warehouse."""

    platform_key: str
    dataset: str
    table: str
    path: str
    partition_filter: dict[str, str]
    rows: DataFrame
    missing_files: bool
    loaded: int = field(default=0)


def requested_loads(spark: SparkSession, gold_root: str, day: str, platforms: Iterable[str],
                    datasets: Iterable[str] | None = None) -> list[Load]:
    """The gold rows of a day for every requested platform and dataset."""
    loads = []
    for key in platforms:
        platform = PLATFORM_KEYS[key]
        for dataset in datasets or GOLD[platform]:
            rows, missing = lake.read_gold(spark, gold_root, platform, dataset, day)
            loads.append(Load(
                key, dataset, warehouse_table(platform, dataset), lake.gold_path(gold_root, platform, dataset),
                lake.partition_values(dataset, gold_partitions(dataset), platform, day), rows, missing))
    return loads


def load_all_or_nothing(spark: SparkSession, database: str, loads: list[Load], day: str) -> None:
    """Loads every table, or leaves all of them as they were.

    All versions are written first, at the same time, each counted by its own
    write; then one commit makes them current. Whatever stops the run before
    that, a bad dataset or a lost driver, readers stay with what they had.
    """
    load_id = uuid.uuid4().hex

    def write(load: Load) -> None:
        load.loaded = write_version(spark, database, load_id, load.table, load.rows, day)

    run_together(spark, [partial(write, load) for load in loads])
    commit(spark, database, load_id, {load.table: load.loaded for load in loads}, day)


def load_report(spark: SparkSession, database: str, loads: list[Load], day: str) -> DataFrame:
    """Per dataset: table, path, partition filter, rows loaded and now in the table."""
    described = spark.createDataFrame(
        [(l.platform_key, l.dataset, l.table, l.path, l.partition_filter, l.loaded, l.missing_files,
          l.missing_files) for l in loads],
        "platform string, dataset string, table_name string, path string, "
        "partition_filter map<string,string>, loaded_row_count bigint, missing_files boolean, skipped boolean")
    inserted = reduce(DataFrame.unionByName, (
        day_rows(spark, database, l.table, day).agg(F.count(F.lit(1)).alias("inserted_row_count"))
        .withColumn("table_name", F.lit(l.table)) for l in loads))
    return described.join(inserted, "table_name").select(
        "platform", "dataset", "table_name", "path", "partition_filter", "loaded_row_count",
        "inserted_row_count", "missing_files", "skipped")


def check_day_count(spark: SparkSession, database: str, table: str, day: str, expected: int) -> None:
    actual = day_rows(spark, database, table, day).count()
    if actual != expected:
        raise ValueError(f"{table} holds {actual} rows for {day}, expected {expected}")
