"""Bronze scans and sinks of both platforms."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from feedmetrics.functions import casts, classify
from feedmetrics.functions.times import day_epoch_range, parse_day
from feedmetrics.schemas import HN_ITEM_TYPES
from feedmetrics.sources import files, json_arrays, json_scan
from feedmetrics.sources.lake import SIDE_BY_SIDE, observed, set_for

# A landed HN item: its place in the collection and the item itself.
HN_LINES = "window_start bigint, page bigint, pos bigint, item variant"
X_LINES = "block bigint, piece bigint, pos bigint, item variant"


def hn_folder(root: str, ingest_date: str, data_date: str) -> str:
    return f"{root.rstrip('/')}/ingest_date={ingest_date}/data_date={data_date}"


def x_folder(root: str, ingest_date: str, dataset_name: str) -> str:
    return f"{root.rstrip('/')}/ingest_date={ingest_date}/dataset_name={dataset_name}"


def _type_rank(item_type: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, HN_ITEM_TYPES)), item_type)


# --- HN --------------------------------------------------------------------

def add_item_type(items: DataFrame) -> DataFrame:
    """Adds item_type by marker tag; null for items no type claims."""
    tags = F.transform(casts.elements_of(F.col("item"), "$._tags"), lambda tag: casts.string_of(tag))
    return items.withColumn("item_type", classify.hn_type_from_tags(tags))


def write_hn_items(items: DataFrame, root: str, ingest_date: str, data_date: str) -> None:
    """Typed items as JSON lines under ``item_type=`` folders, replacing the day.

    A type without items has no folder; the scan takes that as empty.
    """
    lines = (items.where(F.col("item_type").isin(*HN_ITEM_TYPES))
             .select("item_type", "window_start", "page", "pos", "item")
             .hint("rebalance", "item_type"))
    # A file for each type at once; at that many open files as the setting says, Spark sorts the rest of the rows by type.
    # A part of the advisory size is many times that in memory, were it sorted.
    with set_for(items.sparkSession, {SIDE_BY_SIDE: str(len(HN_ITEM_TYPES) + 1)}):
        (lines.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("item_type").json(f"{hn_folder(root, ingest_date, data_date)}/lines"))


def manifest(items: DataFrame, root: str, ingest_date: str, data_date: str) -> DataFrame:
    """One row about a collected day: counts per type (zero included), total, and the folders of types with items."""
    start, end = day_epoch_range(data_date)
    kind = F.col("item_type")
    base = hn_folder(root, ingest_date, data_date)
    return (items.agg(*(F.count_if(kind == name).alias(name) for name in HN_ITEM_TYPES),
                      F.count(F.lit(1)).alias("total_collected_count"))
            .select(F.lit("hacker-news").alias("source"), F.lit("hn-search-api").alias("api"),
                    F.lit("success").alias("status"), F.lit(data_date).alias("data_date"),
                    F.lit(ingest_date).alias("ingest_date"), F.lit(start).cast("bigint").alias("start_ts"),
                    F.lit(end).cast("bigint").alias("end_ts"),
                    F.struct(*HN_ITEM_TYPES).alias("counts"), "total_collected_count",
                    F.struct(*(F.when(F.col(name) > 0, f"{base}/lines/item_type={name}").alias(name)
                               for name in HN_ITEM_TYPES)).alias("written_keys"),
                    F.lit(base).alias("base_prefix")))


def write_manifest(row: DataFrame, root: str, ingest_date: str, data_date: str) -> None:
    row.write.mode("overwrite").json(f"{hn_folder(root, ingest_date, data_date)}/metadata")


def read_manifest(spark: SparkSession, schema: T.StructType, root: str, ingest_date: str, data_date: str) -> DataFrame:
    return spark.read.schema(schema).json(f"{hn_folder(root, ingest_date, data_date)}/metadata")


def read_hn(spark: SparkSession, root: str, ingest_date: str, data_date: str,
            layout: str = "auto") -> DataFrame:
    """seq, item_type, item of one collected day.

    Layouts: ``lines`` (written here), or one JSON array per type in
    ``<type>/part-000.json``, of which all five must exist: ``array`` for any
    formatting (see json_scan), ``indented`` and ``document`` as in json_arrays.
    ``auto`` takes lines when they are there, else reads each array by the form
    it has. Only ``document`` reads a file in one task.
    """
    folder = hn_folder(root, ingest_date, data_date)
    if layout == "auto" and files.exists(spark, f"{folder}/lines"):
        layout = "lines"
    if layout == "lines":
        if not files.exists(spark, f"{folder}/lines"):
            raise FileNotFoundError(f"Missing bronze folder: {folder}/lines")
        return (spark.read.schema(f"{HN_LINES}, item_type string").option("mode", "FAILFAST")
                .json(f"{folder}/lines")
                .select(F.struct(_type_rank(F.col("item_type")).alias("type_rank"), "window_start", "page", "pos")
                        .alias("seq"), "item_type", "item"))
    if layout not in ("auto", "array", "document", "indented"):
        raise ValueError(f"There is no bronze layout {layout!r}")
    paths = [f"{folder}/{name}/part-000.json" for name in HN_ITEM_TYPES]
    for path in paths:
        if not files.is_file(spark, path):
            raise FileNotFoundError(f"Missing bronze file: {path}")
    indented = [path for path in paths
                if layout == "indented" or layout == "auto" and json_arrays.is_indented(spark, path)]
    any_form = json_arrays.scan_documents if layout == "document" else json_scan.scan_arrays
    scans = [(json_arrays.scan_indented, indented), (any_form, [path for path in paths if path not in indented])]
    return (reduce(DataFrame.unionByName, (scan(spark, own) for scan, own in scans if own))
            .withColumn("item_type", F.regexp_extract("path", r"/([a-z]+)/part-000\.json$", 1))
            .select(F.struct(_type_rank(F.col("item_type")).alias("type_rank"), "seq").alias("seq"),
                    "item_type", "item"))


# --- X ---------------------------------------------------------------------

def payload_items(document: Column) -> Column:
    """The posts of a payload: itself, its tweets or its data; else an empty array."""
    return F.coalesce(casts.elements_of(document),
                      casts.elements_of(document, "$.tweets"),
                      casts.elements_of(document, "$.data"),
                      F.array().cast("array<variant>"))


def read_x(spark: SparkSession, root: str, ingest_date: str, dataset_name: str,
           layout: str = "auto") -> DataFrame:
    """seq, item of one dataset: ``tweets.json``, or ``tweets/`` lines once landed here.

    ``payload`` reads the accepted forms however they are printed, ``indented``
    a plain array printed with an indent of two; both split a file across tasks.
    ``document`` parses it in one.
    """
    folder = x_folder(root, ingest_date, dataset_name)
    if layout == "auto":
        layout = "lines"
        if files.is_file(spark, f"{folder}/tweets.json"):
            layout = "indented" if json_arrays.is_indented(spark, f"{folder}/tweets.json") else "payload"
    if layout == "payload":
        return json_scan.scan_payloads(spark, [f"{folder}/tweets.json"]).select("seq", "item")
    if layout == "document":
        return (json_arrays.documents(spark, [f"{folder}/tweets.json"])
                .select(F.posexplode(payload_items(F.col("document"))).alias("pos", "item"))
                .select(F.struct(F.col("pos").cast("bigint").alias("pos")).alias("seq"), "item"))
    if layout == "indented":
        return json_arrays.scan_indented(spark, [f"{folder}/tweets.json"]).select("seq", "item")
    if layout != "lines":
        raise ValueError(f"There is no bronze layout {layout!r}")
    if not files.exists(spark, f"{folder}/tweets"):
        raise FileNotFoundError(f"Missing bronze dataset: {folder}")
    return (spark.read.schema(X_LINES).option("mode", "FAILFAST").json(f"{folder}/tweets")
            .select(F.struct("block", "piece", "pos").alias("seq"), "item"))


def land_x_dataset(spark: SparkSession, source: str, root: str, ingest_date: str, dataset_name: str,
                   dry_run: bool = False) -> DataFrame:
    """Validates a dataset folder and lands it as JSON lines; returns the plan.

    ``tweets.json`` must be an array, of any formatting and size, and
    ``metadata.json`` an object; a record_count there must equal the number of
    records. The array is parsed once: the records are written to a folder
    beside the datasets, counted by that write, and only moved to their place
    when the count is right. A dataset landed before is replaced as a whole.
    """
    parse_day(ingest_date, "ingest_date")
    source = source.rstrip("/")
    for name in ("tweets.json", "metadata.json"):
        if not files.is_file(spark, f"{source}/{name}"):
            raise ValueError(f"Required file does not exist: {source}/{name}")
    metadata = json_arrays.documents(spark, [f"{source}/metadata.json"])
    declared = casts.field(F.col("document"), "$.record_count")
    checks = metadata.select(casts.is_object(F.col("document")).alias("is_object"),
                             F.coalesce(~F.is_variant_null(declared), F.lit(False)).alias("declares"),
                             F.try_variant_get(declared, "$", "bigint").alias("declared"),
                             F.to_json("document").alias("value")).first()
    if not checks.is_object:
        raise ValueError(f"No object in {source}/metadata.json")
    records = json_scan.scan_arrays(spark, [f"{source}/tweets.json"]).select("seq.block", "seq.piece", "seq.pos", "item")

    folder = x_folder(root, ingest_date, dataset_name)
    staged, new_root = f"{root.rstrip('/')}/_landing-{uuid.uuid4().hex[:12]}", not files.exists(spark, root)
    try:
        if dry_run:
            count = records.count()
        else:
            seen = Observation()
            records.hint("rebalance").observe(seen, F.count(F.lit(1)).alias("rows")).write.json(f"{staged}/tweets")
            count = observed(seen).get("rows") or 0
        if checks.declares and checks.declared != count:
            raise ValueError(f"{source}: metadata announces {checks.declared} records, the array has {count}")
        if not dry_run:
            spark.createDataFrame([(checks.value,)], "value string").coalesce(1).write.text(f"{staged}/metadata")
            for name in ("metadata", "tweets"):
                files.replace_folder(spark, f"{staged}/{name}", f"{folder}/{name}")
    finally:
        files.delete(spark, staged)
        if new_root and not files.child_folders(spark, root):
            files.delete(spark, root)
    targets = [(f"{source}/{name}.json", f"{folder}/{name}") for name in ("tweets", "metadata")]
    return (spark.createDataFrame(targets, "source string, target string")
            .select(F.lit(dataset_name).alias("dataset_name"), F.lit(ingest_date).alias("ingest_date"),
                    "source", "target", F.lit(count).cast("bigint").alias("record_count"),
                    F.lit(dry_run).alias("dry_run")))


# --- profiles --------------------------------------------------------------

def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """username, karma, created of landed profile JSON lines; bad numbers are null."""
    return (spark.read.schema("username string, karma variant, created variant").json(path)
            .select("username", casts.int_of(F.col("karma")).alias("karma"),
                    casts.int_of(F.col("created")).alias("created")))
