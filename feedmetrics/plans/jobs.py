"""Jobs: each reads one layer, writes the next and returns a report.

Options are checked before Spark does any work. Stamps are parameters, never
the clock inside a plan, so a run can be repeated with the same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Iterable, Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

from feedmetrics.functions.times import default_dates, parse_day, stamp
from feedmetrics.operators.days import on_day
from feedmetrics.operators.quality import report_of_writes
from feedmetrics.plans import gold, silver_hn, silver_x
from feedmetrics.plans.views import register_views
from feedmetrics.schemas import GOLD, HN, PLATFORM_KEYS, X
from feedmetrics.session import drop_scratch, scratch_dir
from feedmetrics.sources import bronze, lake, pages, warehouse

DEFAULT_X_DATASET = "x-synthetic-seed"


# --- options ---------------------------------------------------------------

def require_root(root: str | None, name: str) -> str:
    if not root:
        raise ValueError(f"{name} is required")
    return root.rstrip("/")


def _chosen(what: str, names: str | Iterable[str] | None, known: Iterable[str]) -> list[str]:
    """The names asked for, or all known ones; an error names those that are not known."""
    known = list(known)
    if not names:
        return known
    asked = list(names) if isinstance(names, Iterable) and not isinstance(names, str) else [names]
    strange = sorted({str(name) for name in asked} - set(known))
    if strange:
        raise ValueError(f"No such {what}: {strange}; there are {known}")
    return asked


def resolve_days(data_date: str | None, ingest_date: str | None, now: dt.datetime | None = None) -> tuple[str, str]:
    yesterday, today = default_dates(now)
    days = data_date or yesterday, ingest_date or today
    for name, value in zip(("data_date", "ingest_date"), days):
        parse_day(value, name)
    return days


def resolve_load_request(platforms=None, datasets=None, mode: str | None = None,
                         data_date: str | None = None, now: dt.datetime | None = None):
    """(platforms, datasets, day) of a load, checked; datasets is None for all of each platform."""
    if mode not in (None, "", "replace_date"):
        raise ValueError(f"A load replaces a date; it has no mode {mode!r}")
    day = data_date or default_dates(now)[1]
    parse_day(day)
    platforms = _chosen("platform", platforms, PLATFORM_KEYS)
    shared = [name for name in GOLD[PLATFORM_KEYS[platforms[0]]]
              if all(name in GOLD[PLATFORM_KEYS[key]] for key in platforms)]
    return platforms, _chosen("dataset of the chosen platforms", datasets, shared) if datasets else None, day


# --- bronze ----------------------------------------------------------------

def collect_hn_day(spark: SparkSession, pages_root: str, bronze_root: str, data_date: str | None = None,
                   ingest_date: str | None = None, max_pages: int | None = None) -> dict:
    """Landed API pages -> typed bronze items and a manifest. ``max_pages`` per window; without it, all."""
    pages_root, bronze_root = require_root(pages_root, "pages_root"), require_root(bronze_root, "bronze_root")
    data_date, ingest_date = resolve_days(data_date, ingest_date)
    items = bronze.add_item_type(pages.collect_items(pages.read_pages(spark, pages_root), max_pages))
    # Written once, then read for the bronze files and the manifest.
    with _staged(spark, items, "collect") as collected:
        bronze.write_hn_items(collected, bronze_root, ingest_date, data_date)
        manifest = bronze.manifest(collected, bronze_root, ingest_date, data_date)
        bronze.write_manifest(manifest, bronze_root, ingest_date, data_date)
    landed = bronze.read_manifest(spark, manifest.schema, bronze_root, ingest_date, data_date)
    return {"source": "hacker-news", "layer": "bronze", "manifest": landed}


@contextmanager
def _staged(spark: SparkSession, df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """An intermediate table in the shared folder, there until the block ends.

    Several outputs then start from columnar files, read only their columns
    and need nothing from before when an executor is lost.
    """
    path = scratch_dir(spark, purpose)
    try:
        with lake.set_for(spark, lake.NOTHING_LEFT):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        drop_scratch(spark, path)


# --- silver ----------------------------------------------------------------

def write_silver_run(spark: SparkSession, tables: dict[str, DataFrame], platform: str, silver_root: str,
                     run: tuple[str, str, str], mode: str = "overwrite_partitions", dealt: Collection[str] = (),
                     compression: str = "snappy") -> dict:
    """Writes the four tables and, from the counts of those writes, their quality report."""
    written = lake.write_silver(spark, tables, silver_root, mode, dealt, compression)
    report = report_of_writes(spark, written, platform, *run)
    written |= lake.write_silver(spark, {"data_quality_report": report}, silver_root, mode)
    return {"layer": "silver", "platform": platform, "data_date": run[0], "ingest_date": run[1],
            "processed_at_utc": run[2], "tables": written, "data_quality_report": report}


def hn_silver(spark: SparkSession, bronze_root: str, silver_root: str, data_date: str | None = None,
              ingest_date: str | None = None, processed_at: str | None = None,
              profiles: DataFrame | None = None, layout: str = "auto",
              mode: str = "overwrite_partitions") -> dict:
    bronze_root, silver_root = require_root(bronze_root, "bronze_root"), require_root(silver_root, "silver_root")
    data_date, ingest_date = resolve_days(data_date, ingest_date)
    run = (data_date, ingest_date, processed_at or stamp())
    items = bronze.read_hn(spark, bronze_root, ingest_date, data_date, layout)
    with _staged(spark, silver_hn.flatten(items), "hn-items") as flat, \
            _staged(spark, silver_hn.first_deliveries(flat), "hn-posts") as first:
        tables = silver_hn.silver_tables(flat, first, *run, profiles=profiles)
        return write_silver_run(spark, tables, HN, silver_root, run, mode, silver_hn.DEALT)


def x_silver(spark: SparkSession, bronze_root: str, silver_root: str, ingest_date: str | None = None,
             dataset_name: str | None = None, data_date: str | None = None, processed_at: str | None = None,
             layout: str = "auto", mode: str = "overwrite_partitions") -> dict:
    """The data date defaults to the ingest date."""
    bronze_root, silver_root = require_root(bronze_root, "bronze_root"), require_root(silver_root, "silver_root")
    ingest_date = ingest_date or default_dates()[1]
    data_date, ingest_date = resolve_days(data_date or ingest_date, ingest_date)
    run = (data_date, ingest_date, processed_at or stamp())
    items = bronze.read_x(spark, bronze_root, ingest_date, dataset_name or DEFAULT_X_DATASET, layout)
    with ExitStack() as stages:
        flat = stages.enter_context(_staged(spark, silver_x.flatten(items), "x-items"))
        again = stages.enter_context(_staged(spark, silver_x.delivered_again(flat), "x-again"))
        if not again.isEmpty():
            flat = stages.enter_context(_staged(spark, silver_x.marked(flat, again), "x-marked"))
        return write_silver_run(spark, silver_x.silver_tables(flat, *run), X, silver_root, run, mode, silver_x.DEALT)


# --- gold ------------------------------------------------------------------

def hn_gold(spark: SparkSession, silver_root: str, gold_root: str, data_date: str | None = None,
            processed_at: str | None = None, mode: str = "overwrite_partitions",
            strict_created_day: bool = False) -> dict:
    """HN gold of a day, or of all days without one.

    A post counts on its data date, whatever day it was created on.
    ``strict_created_day`` reads the day's own partition alone and leaves out
    posts created on another day.
    """
    silver_root, gold_root = require_root(silver_root, "silver_root"), require_root(gold_root, "gold_root")
    pruned = data_date if strict_created_day else None
    if data_date:
        parse_day(data_date)
    silver = {name: on_day(lake.read_silver(spark, silver_root, name, HN, pruned), data_date)
              for name in ("users", "posts", "data_quality_report")}
    processed_at = processed_at or stamp()
    written = lake.write_gold(spark, gold.hn_gold_tables(silver, processed_at), gold_root, HN, mode)
    return {"layer": "gold", "platform": HN, "data_date": data_date, "processed_at_utc": processed_at,
            "tables": written}


def x_gold(spark: SparkSession, silver_root: str, gold_root: str, data_date: str | None = None,
           processed_at: str | None = None, mode: str = "overwrite_partitions") -> dict:
    """X gold of a data date, whatever day its posts were created."""
    silver_root, gold_root = require_root(silver_root, "silver_root"), require_root(gold_root, "gold_root")
    if data_date:
        parse_day(data_date)
    silver = {name: on_day(lake.read_silver(spark, silver_root, name, X), data_date)
              for name in ("users", "posts", "post_tags", "data_quality_report")}
    processed_at = processed_at or stamp()
    written = lake.write_gold(spark, gold.x_gold_tables(silver, processed_at), gold_root, X, mode)
    return {"layer": "gold", "platform": X, "data_date": data_date, "processed_at_utc": processed_at,
            "tables": written}


# --- warehouse -------------------------------------------------------------

def load_warehouse(spark: SparkSession, gold_root: str, database: str, location: str,
                   platforms: Iterable[str] | str | None = None, datasets: Iterable[str] | str | None = None,
                   data_date: str | None = None, mode: str | None = None) -> DataFrame:
    """Gold of a day -> warehouse tables; returns the load report."""
    gold_root = require_root(gold_root, "gold_root")
    platforms, datasets, day = resolve_load_request(platforms, datasets, mode, data_date)
    warehouse.create_tables(spark, database, require_root(location, "location"))
    loads = warehouse.requested_loads(spark, gold_root, day, platforms, datasets)
    warehouse.load_all_or_nothing(spark, database, loads, day)
    return warehouse.load_report(spark, database, loads, day)


def apply_views(spark: SparkSession, database: str) -> None:
    register_views(spark, database)
