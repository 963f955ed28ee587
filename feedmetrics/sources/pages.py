"""Landed search-API pages -> raw items of a day."""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from feedmetrics.functions import casts
from feedmetrics.operators.dedup import keep_first_identified
from feedmetrics.sources import files

# Bytes of a text that surely fit a VARIANT, which holds 128 MiB.
LARGEST_RESPONSE = 64 << 20

def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """window_start, page, response VARIANT of landed pages.

    Either one file per page under ``window_start=/page=/``, where a response
    that is not JSON counts as an invalid page, or JSON lines holding the
    three fields. A response too large to parse is an error, never an invalid
    page, so nothing is lost by its size.
    """
    if not any(name.startswith("window_start=") for name in files.child_folders(spark, root)):
        return spark.read.schema("window_start bigint, page bigint, response variant").json(root)
    path = F.col("_metadata.file_path")

    def from_path(name: str):
        return F.regexp_extract(path, rf"/{name}=(\d+)/", 1).try_cast("bigint").alias(name)

    whole = F.col("value")
    # try_parse_json is null for both; a text this large that is no JSON at all is an error, too.
    response = F.when(F.octet_length(whole) < LARGEST_RESPONSE, F.try_parse_json(whole)).otherwise(
        F.parse_json(whole))
    return (spark.read.option("recursiveFileLookup", "true").text(root, wholetext=True)
            .select(from_path("window_start"), from_path("page"), response.alias("response")))


def usable_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The pages a window contributes, as window_start, page, hits array<variant>.

    A window is read from page 0 on. A missing, malformed or empty page ends
    it without contributing; the page the API names as last ends it after
    contributing. So page p counts when it is good and pages 0..p-1 are all
    good and not last. ``max_pages`` reads at most so many pages of a window;
    by default all that have landed are read.

    The n-th page of a window that goes on is part of the unbroken run while its
    number is n. Only that small table of numbers is sorted by window, and it
    tells each window its first page that does not go on.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError(f"max_pages must be at least 1, got {max_pages}")
    response = F.col("response")
    counted = casts.kind(response, "$.nbPages").isin("BIGINT", "BOOLEAN")
    last_page = F.when(counted, F.try_variant_get(response, "$.nbPages", "bigint"))
    read = (pages.where(F.col("page").between(0, sys.maxsize if max_pages is None else max_pages - 1))
            .withColumn("hits", casts.elements_of(response, "$.hits"))
            .withColumn("good", F.coalesce(F.size("hits") > 0, F.lit(False)))
            .withColumn("goes_on", F.col("good") & ~F.coalesce(F.col("page") >= last_page - 1, F.lit(False)))
            .drop("response"))
    in_order = Window.partitionBy("passed_window").orderBy("page")
    run = (read.where("goes_on").select(F.col("window_start").alias("passed_window"), "page").distinct()
           .withColumn("in_run", F.col("page") == F.row_number().over(in_order) - 1)
           .groupBy("passed_window").agg(F.count_if("in_run").alias("run")))
    return (read.where("good")
            .join(run, F.col("window_start") == F.col("passed_window"), "left")
            .where(F.col("page") <= F.coalesce("run", F.lit(0)))
            .select("window_start", "page", "hits"))


def collect_items(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """window_start, page, pos, item of a day: object hits, first per objectID.

    Items without an id are all kept.
    """
    hits = (usable_pages(pages, max_pages)
            .select("window_start", "page", F.posexplode("hits").alias("pos", "item"))
            .where(casts.is_object(F.col("item")))
            .withColumn("_id", casts.truthy_text(F.col("item"), "$.objectID")))
    return keep_first_identified(hits, "_id", ["window_start", "page", "pos"]).drop("_id")
