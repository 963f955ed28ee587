"""Fixed table layouts: five silver tables, twelve gold/warehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data model.
HN = "HackerNews"
X = "X"
HN_ITEM_TYPES = ("story", "ask", "comment", "job", "poll")
SILVER_TABLES = ("users", "posts", "post_tags", "post_relations", "data_quality_report")
QUALITY_TABLES = ("users", "posts", "post_tags", "post_relations")

_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(),
          "boolean": T.BooleanType()}


def _struct(spec: str) -> T.StructType:
    """``"a b n:long"`` -> StructType; a name without a type is a string."""
    fields = [part.partition(":") for part in spec.split()]
    return T.StructType([T.StructField(name, _TYPES[kind or "string"]) for name, _, kind in fields])


_LINEAGE = "year month day data_date ingest_date silver_processed_at_utc"

SILVER = {
    "users": _struct(
        "user_id platform source_user_id username display_name karma_score:long "
        "followers_count:long following_count:long is_verified:boolean "
        f"user_created_at_utc {_LINEAGE}"),
    "posts": _struct(
        "post_id platform source_post_id author_user_id author_username post_type title "
        "content_text url score:long like_count:long retweet_count:long reply_count:long "
        f"quote_count:long lang source created_at_utc {_LINEAGE}"),
    "post_tags": _struct(f"post_id platform tag tag_type created_at_utc {_LINEAGE}"),
    "post_relations": _struct(
        f"post_id platform related_source_post_id relation_type created_at_utc {_LINEAGE}"),
    "data_quality_report": _struct(
        "table_name platform data_date ingest_date row_count:long column_count:long "
        "non_null_cell_count:long total_cell_count:long data_quality_score:double "
        "silver_processed_at_utc"),
}

_BASE = "date platform year month day gold_processed_at_utc"
_RANKED_POST = (f"{_BASE} rank:long post_id source_post_id author_user_id author_username "
                "post_type title url score:long")
_RANKED_USER = f"{_BASE} rank:long user_id source_user_id username karma_score:long"
_USERS_METRIC = f"{_BASE} total_users:long active_users:long"
_QUALITY = ("table_name platform data_date ingest_date row_count:long column_count:long "
            "non_null_cell_count:long total_cell_count:long data_quality_score:double "
            "silver_processed_at_utc gold_processed_at_utc")

GOLD = {
    HN: {
        "daily_item_counts": _struct(
            _BASE + "".join(f" {kind}_count:long" for kind in HN_ITEM_TYPES) + " total_count:long"),
        "daily_users_metric": _struct(_USERS_METRIC),
        "top_story_posts": _struct(_RANKED_POST),
        "top_job_posts": _struct(_RANKED_POST),
        "top_users_by_karma": _struct(_RANKED_USER),
        "bottom_users_by_karma": _struct(_RANKED_USER),
        "data_quality_summary": _struct(_QUALITY),
    },
    X: {
        "daily_users_metric": _struct(_USERS_METRIC),
        "top_users_by_followers": _struct(
            f"{_BASE} rank:long user_id source_user_id username display_name "
            "followers_count:long following_count:long is_verified:boolean"),
        "top_posts_by_engagement": _struct(
            f"{_BASE} rank:long post_id source_post_id author_user_id author_username post_type "
            "content_text like_count:long retweet_count:long reply_count:long quote_count:long "
            "engagement_count:long"),
        "hashtag_trends": _struct(f"{_BASE} rank:long tag tag_type post_count:long"),
        "data_quality_summary": _struct(_QUALITY),
    },
}

# Request names of the two platforms, as used by the load job and folder names.
PLATFORM_KEYS = {"hacker-news": HN, "x": X}
PLATFORM_FOLDERS = {HN: "hacker-news", X: "x"}
_TABLE_PREFIX = {HN: "hn", X: "x"}


def silver_partitions(table: str) -> list[str]:
    if table == "data_quality_report":
        return ["platform", "data_date"]
    return ["platform", "year", "month", "day"]


def gold_partitions(dataset: str) -> list[str]:
    if dataset == "data_quality_summary":
        return ["platform", "data_date"]
    return ["platform", "year", "month", "day"]


def warehouse_table(platform: str, dataset: str) -> str:
    return f"{_TABLE_PREFIX[platform]}_{dataset}"


def date_column(schema: T.StructType) -> str:
    return "data_date" if "data_date" in schema.names else "date"


def warehouse_schema(platform: str, dataset: str) -> T.StructType:
    """The gold layout with real dates, timestamps and a fixed-point score."""

    def typed(field: T.StructField) -> T.StructField:
        if field.name in ("date", "data_date", "ingest_date"):
            return T.StructField(field.name, T.DateType())
        if field.name.endswith("_at_utc"):
            return T.StructField(field.name, T.TimestampType())
        if field.name == "data_quality_score":
            return T.StructField(field.name, T.DecimalType(5, 2))
        return field

    return T.StructType([typed(field) for field in GOLD[platform][dataset]])


WAREHOUSE = {
    warehouse_table(platform, dataset): (platform, dataset)
    for platform, datasets in GOLD.items()
    for dataset in datasets
}
