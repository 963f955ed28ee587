"""Dashboard views over the warehouse tables, and the dashboard's own queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmetrics.functions.measures import latest_stamp
from feedmetrics.schemas import HN_ITEM_TYPES
from feedmetrics.sources import warehouse

Tables = Callable[[str], DataFrame]
STAMP = "gold_processed_at_utc"


def _stamp_last(df: DataFrame, after_rank: Column | None = None) -> DataFrame:
    """The table's columns with the gold stamp moved to the end."""
    names = [name for name in df.columns if name != STAMP]
    if after_rank is None:
        return df.select(*names, STAMP)
    split = names.index("rank") + 1
    return df.select(*names[:split], after_rank, *names[split:], STAMP)


def _labelled_union(parts: list[tuple[DataFrame, str]], label: str) -> DataFrame:
    return reduce(DataFrame.unionByName,
                  (_stamp_last(df, F.lit(value).alias(label)) for df, value in parts))


def hn_daily_activity(tables: Tables) -> DataFrame:
    """Item counts with user counts of the day; days without users keep nulls."""
    items, users = tables("hn_daily_item_counts").alias("i"), tables("hn_daily_users_metric").alias("u")
    same_day = (F.col("i.date") == F.col("u.date")) & (F.col("i.platform") == F.col("u.platform"))
    for part in ("year", "month", "day"):
        same_day &= F.col(f"i.{part}").eqNullSafe(F.col(f"u.{part}"))
    return items.join(users, same_day, "left").select(
        *(f"i.{name}" for name in ("date", "platform", "year", "month", "day")),
        *(f"i.{kind}_count" for kind in HN_ITEM_TYPES), "i.total_count", "u.total_users", "u.active_users",
        latest_stamp(F.col(f"i.{STAMP}"), F.col(f"u.{STAMP}")).alias(STAMP))


def hn_top_posts(tables: Tables) -> DataFrame:
    return _labelled_union([(tables("hn_top_story_posts"), "story"), (tables("hn_top_job_posts"), "job")],
                           "post_category")


def hn_top_users(tables: Tables) -> DataFrame:
    return _labelled_union([(tables("hn_top_users_by_karma"), "top_karma"),
                            (tables("hn_bottom_users_by_karma"), "bottom_karma")], "user_bucket")


def data_quality_score(tables: Tables) -> DataFrame:
    return tables("hn_data_quality_summary").unionByName(tables("x_data_quality_summary"))


def _renamed(table: str) -> Callable[[Tables], DataFrame]:
    return lambda tables: _stamp_last(tables(table))


RENAMED = {"vw_x_daily_activity": "x_daily_users_metric", "vw_x_top_posts": "x_top_posts_by_engagement",
           "vw_x_top_users": "x_top_users_by_followers", "vw_x_hashtag_trends": "x_hashtag_trends"}
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "vw_hn_daily_activity": hn_daily_activity,
    "vw_hn_top_posts": hn_top_posts,
    "vw_hn_top_users": hn_top_users,
    **{name: _renamed(table) for name, table in RENAMED.items()},
    "vw_data_quality_score": data_quality_score,
}


def view_sql(name: str, database: str) -> str:
    """The SELECT of a view over a database's tables; the same rows and columns as its plan in ``VIEWS``."""

    def columns(table: str, label: str | None = None, after_rank: bool = False, alias: str = "") -> str:
        names = [f"{alias}`{n}`" for n in warehouse.table_schema(table).names if n != STAMP]
        if label:
            names.insert(names.index("`rank`") + 1 if after_rank else len(names), label)
        return ", ".join([*names, f"{alias}{STAMP}"])

    def labelled(label: str, parts: dict[str, str]) -> str:
        return " UNION ALL ".join(f"SELECT {columns(table, f'{value!r} AS {label}', True)} FROM {database}.{table}"
                                  for table, value in parts.items())

    if name == "vw_hn_daily_activity":
        kinds = ", ".join(f"i.{kind}_count" for kind in HN_ITEM_TYPES)
        same = " AND ".join(f"i.{part} <=> u.{part}" for part in ("year", "month", "day"))
        return (f"SELECT i.date, i.platform, i.year, i.month, i.day, {kinds}, i.total_count, u.total_users, "
                f"u.active_users, greatest(i.{STAMP}, u.{STAMP}) AS {STAMP} "
                f"FROM {database}.hn_daily_item_counts i LEFT JOIN {database}.hn_daily_users_metric u "
                f"ON i.date = u.date AND i.platform = u.platform AND {same}")
    if name == "vw_hn_top_posts":
        return labelled("post_category", {"hn_top_story_posts": "story", "hn_top_job_posts": "job"})
    if name == "vw_hn_top_users":
        return labelled("user_bucket", {"hn_top_users_by_karma": "top_karma", "hn_bottom_users_by_karma": "bottom_karma"})
    if name == "vw_data_quality_score":
        return " UNION ALL ".join(f"SELECT * FROM {database}.{table}"
                                  for table in ("hn_data_quality_summary", "x_data_quality_summary"))
    return f"SELECT {columns(RENAMED[name])} FROM {database}.{RENAMED[name]}"


def register_views(spark: SparkSession, database: str) -> None:
    """The eight views in the database's catalog, for every session, and under their names in this one.

    Each database has its own; registering again replaces them.
    """
    for name in VIEWS:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {view_sql(name, database)}")
        spark.table(f"{database}.{name}").createOrReplaceTempView(name)


def missing_views(spark: SparkSession, database: str | None = None) -> list[str]:
    return [name for name in VIEWS if not spark.catalog.tableExists(f"{database}.{name}" if database else name)]


def view_counts(spark: SparkSession, database: str | None = None) -> DataFrame:
    """view_name, row_count of every view: those of a database, or the session's."""
    return reduce(DataFrame.unionByName, (
        spark.table(f"{database}.{name}" if database else name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("view_name"), "row_count")
        for name in VIEWS))


def check_views_filled(spark: SparkSession) -> None:
    empty = [row.view_name for row in view_counts(spark).where("row_count = 0").collect()]
    if empty:
        raise ValueError(f"Views without rows: {empty}")


# --- dashboard queries ------------------------------------------------------

def latest_date_rows(view: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """Rows of the view's latest date, ordered for display if asked.

    The date is a scalar subquery, so it becomes a partition filter.
    """
    latest = view.select(F.max("date")).scalar()
    rows = view.where(F.col("date") == latest)
    return rows.orderBy(*order) if order else rows


def daily_kpis(activity: DataFrame) -> DataFrame:
    """Big numbers over all dates of an activity view."""
    names = [name for name in ("total_count", "total_users", "active_users") if name in activity.columns]
    return activity.agg(*(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names))


def quality_average(view: DataFrame) -> DataFrame:
    return view.agg(F.avg("data_quality_score").cast("double").alias("average_score"))


def quality_by_table(view: DataFrame) -> DataFrame:
    return view.groupBy("table_name").agg(F.avg("data_quality_score").cast("double").alias("average_score"))
