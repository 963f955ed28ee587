"""Queries of the gold layer and the views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from feedmetrics.operators.quality import quality_report
from feedmetrics.plans import gold, views
from feedmetrics.queries import feeds, sql
from feedmetrics.queries.feeds import RUN, STAMP
from feedmetrics.queries.registry import query
from feedmetrics.schemas import HN, HN_ITEM_TYPES, SILVER, X


@query("top_story_posts", sql.top_posts_by_score("story"))
def top_story_posts(spark, sf):
    return gold.top_posts_by_score(feeds.hn_posts(spark, sf), "story", STAMP)


@query("top_job_posts", sql.top_posts_by_score("job"))
def top_job_posts(spark, sf):
    return gold.top_posts_by_score(feeds.hn_posts(spark, sf), "job", STAMP)


@query("top_users_by_karma", sql.top_users_by_karma("DESC"))
def top_users_by_karma(spark, sf):
    return gold.top_users_by_karma(feeds.hn_users(spark, sf), STAMP)


@query("bottom_users_by_karma", sql.top_users_by_karma("ASC"))
def bottom_users_by_karma(spark, sf):
    return gold.top_users_by_karma(feeds.hn_users(spark, sf), STAMP, descending=False)


@query("top_users_by_followers", sql.TOP_USERS_BY_FOLLOWERS)
def top_users_by_followers(spark, sf):
    return gold.top_users_by_followers(feeds.x_users(spark, sf), STAMP)


@query("top_posts_by_engagement", sql.TOP_POSTS_BY_ENGAGEMENT)
def top_posts_by_engagement(spark, sf):
    return gold.top_posts_by_engagement(feeds.x_posts(spark, sf), STAMP)


@query("hashtag_trends", sql.hashtag_trends())
def hashtag_trends(spark, sf):
    return gold.hashtag_trends(feeds.x_tags(spark, sf), STAMP)


@query("daily_item_counts", sql.DAILY_ITEM_COUNTS)
def daily_item_counts(spark, sf):
    return gold.daily_item_counts(feeds.hn_posts(spark, sf), STAMP)


@query("hn_daily_users_metric", sql.daily_users_metric(sql.HN_USERS, HN))
def hn_daily_users_metric(spark, sf):
    return gold.daily_users_metric(feeds.hn_users(spark, sf), HN, STAMP)


@query("x_daily_users_metric", sql.daily_users_metric(sql.X_USERS, X))
def x_daily_users_metric(spark, sf):
    return gold.daily_users_metric(feeds.x_users(spark, sf), X, STAMP)


def hn_quality(spark, sf) -> DataFrame:
    """HN feeds with two empty tables."""
    empty = {name: spark.createDataFrame([], SILVER[name]) for name in ("post_tags", "post_relations")}
    tables = {"users": feeds.hn_users(spark, sf), "posts": feeds.hn_posts(spark, sf), **empty}
    return quality_report(tables, HN, *RUN)


def x_quality(spark, sf) -> DataFrame:
    return quality_report(feeds.x_silver(spark, sf), X, *RUN)


query("hn_quality_report", sql.HN_QUALITY)(hn_quality)
query("x_quality_report", sql.X_QUALITY)(x_quality)
_SUMMARY = f"SELECT *, '{STAMP}' AS gold_processed_at_utc FROM ({{}})"


@query("data_quality_summary", _SUMMARY.format(sql.X_QUALITY))
def data_quality_summary(spark, sf):
    """Both platforms' reports, cut down to one platform."""
    both = hn_quality(spark, sf).unionByName(x_quality(spark, sf))
    return gold.data_quality_summary(both, X, STAMP)


# --- views ---------------------------------------------------------------------------

_BUILD: dict[str, Callable] = {
    "hn_daily_item_counts": daily_item_counts, "hn_daily_users_metric": hn_daily_users_metric,
    "hn_top_story_posts": top_story_posts, "hn_top_job_posts": top_job_posts,
    "hn_top_users_by_karma": top_users_by_karma, "hn_bottom_users_by_karma": bottom_users_by_karma,
    "hn_data_quality_summary": lambda spark, sf: gold.data_quality_summary(hn_quality(spark, sf), HN, STAMP),
    "x_daily_users_metric": x_daily_users_metric, "x_top_users_by_followers": top_users_by_followers,
    "x_top_posts_by_engagement": top_posts_by_engagement, "x_hashtag_trends": hashtag_trends,
    "x_data_quality_summary": data_quality_summary,
}
_SQL = {
    "hn_daily_item_counts": sql.DAILY_ITEM_COUNTS, "hn_daily_users_metric": sql.daily_users_metric(sql.HN_USERS, HN),
    "hn_top_story_posts": sql.top_posts_by_score("story"), "hn_top_job_posts": sql.top_posts_by_score("job"),
    "hn_top_users_by_karma": sql.top_users_by_karma("DESC"), "hn_bottom_users_by_karma": sql.top_users_by_karma("ASC"),
    "hn_data_quality_summary": _SUMMARY.format(sql.HN_QUALITY),
    "x_data_quality_summary": _SUMMARY.format(sql.X_QUALITY),
}
# A user count for every other day of the month, so that the left join has gaps.
_EVEN_DAY = "CAST(day AS INTEGER) % 2 = 0"


def _tables(spark, sf) -> views.Tables:
    return lambda name: _BUILD[name](spark, sf)


@query("hn_daily_activity_view", f"""
SELECT i.*EXCLUDE (gold_processed_at_utc), u.total_users, u.active_users,
  greatest(i.gold_processed_at_utc, u.gold_processed_at_utc) AS gold_processed_at_utc
FROM ({_SQL['hn_daily_item_counts']}) i LEFT JOIN (SELECT *EXCLUDE (gold_processed_at_utc),
  CASE WHEN month = '01' THEN '2024-02-03T00:00:00Z' END AS gold_processed_at_utc
  FROM ({_SQL['hn_daily_users_metric']}) WHERE {_EVEN_DAY}) u
ON i.date = u.date AND i.platform = u.platform AND i.year IS NOT DISTINCT FROM u.year
  AND i.month IS NOT DISTINCT FROM u.month AND i.day IS NOT DISTINCT FROM u.day""")
def hn_daily_activity(spark, sf):
    later = F.when(F.col("month") == "01", "2024-02-03T00:00:00Z")
    users = (hn_daily_users_metric(spark, sf).where(_EVEN_DAY).withColumn("gold_processed_at_utc", later))
    tables = {"hn_daily_item_counts": daily_item_counts(spark, sf), "hn_daily_users_metric": users}
    return views.hn_daily_activity(tables.__getitem__)


@query("x_daily_activity_view", sql.daily_users_metric(sql.X_USERS, X))
def x_daily_activity(spark, sf):
    return views.VIEWS["vw_x_daily_activity"](_tables(spark, sf))


_TOP_POSTS = (f"SELECT *, 'story' AS post_category FROM ({_SQL['hn_top_story_posts']}) "
              f"UNION ALL SELECT *, 'job' FROM ({_SQL['hn_top_job_posts']})")
_TOP_USERS = (f"SELECT *, 'top_karma' AS user_bucket FROM ({_SQL['hn_top_users_by_karma']}) "
              f"UNION ALL SELECT *, 'bottom_karma' FROM ({_SQL['hn_bottom_users_by_karma']})")
_QUALITY = f"({_SQL['hn_data_quality_summary']}) UNION ALL ({_SQL['x_data_quality_summary']})"


@query("hn_top_posts_view", _TOP_POSTS)
def hn_top_posts(spark, sf):
    return views.hn_top_posts(_tables(spark, sf))


@query("hn_top_users_view", _TOP_USERS)
def hn_top_users(spark, sf):
    return views.hn_top_users(_tables(spark, sf))


@query("x_top_posts_view", sql.TOP_POSTS_BY_ENGAGEMENT)
def x_top_posts(spark, sf):
    return views.VIEWS["vw_x_top_posts"](_tables(spark, sf))


@query("x_top_users_view", sql.TOP_USERS_BY_FOLLOWERS)
def x_top_users(spark, sf):
    return views.VIEWS["vw_x_top_users"](_tables(spark, sf))


@query("x_hashtag_trends_view", sql.hashtag_trends())
def x_hashtag_trends(spark, sf):
    return views.VIEWS["vw_x_hashtag_trends"](_tables(spark, sf))


@query("data_quality_view", _QUALITY)
def data_quality(spark, sf):
    return views.data_quality_score(_tables(spark, sf))


# --- dashboard -----------------------------------------------------------------------

@query("dashboard_kpis", f"""
SELECT 'HackerNews' AS platform, CAST(sum(i.total_count) AS BIGINT) AS total_count,
  CAST(sum(u.total_users) AS BIGINT) AS total_users, CAST(sum(u.active_users) AS BIGINT) AS active_users
FROM ({_SQL['hn_daily_item_counts']}) i JOIN ({_SQL['hn_daily_users_metric']}) u USING (date)
UNION ALL SELECT 'X', NULL, CAST(sum(total_users) AS BIGINT), CAST(sum(active_users) AS BIGINT)
FROM ({sql.daily_users_metric(sql.X_USERS, X)})""")
def dashboard_kpis(spark, sf):
    tables = _tables(spark, sf)
    hn = views.daily_kpis(views.hn_daily_activity(tables)).withColumn("platform", F.lit(HN))
    x = views.daily_kpis(views.VIEWS["vw_x_daily_activity"](tables)).withColumn("platform", F.lit(X))
    return hn.unionByName(x, allowMissingColumns=True)


_BARS = f"SELECT date, {', '.join(f'{k}_count' for k in HN_ITEM_TYPES)} FROM ({_SQL['hn_daily_item_counts']})"


@query("dashboard_items_by_date", _BARS)
def dashboard_items_by_date(spark, sf):
    return views.hn_daily_activity(_tables(spark, sf)).select("date", *(f"{k}_count" for k in HN_ITEM_TYPES))


@query("dashboard_quality", f"""
SELECT '(all)' AS table_name, avg(data_quality_score) AS average_score FROM ({_QUALITY})
UNION ALL SELECT table_name, avg(data_quality_score) FROM ({_QUALITY}) GROUP BY table_name""")
def dashboard_quality(spark, sf):
    view = views.data_quality_score(_tables(spark, sf))
    overall = views.quality_average(view).withColumn("table_name", F.lit("(all)"))
    return overall.unionByName(views.quality_by_table(view))


@query("latest_top_posts", f"SELECT * FROM ({_TOP_POSTS}) WHERE date = (SELECT max(date) FROM ({_TOP_POSTS}))")
def latest_top_posts(spark, sf):
    return views.latest_date_rows(views.hn_top_posts(_tables(spark, sf)), [F.col("rank")])


@query("latest_x_posts", f"SELECT * FROM ({sql.TOP_POSTS_BY_ENGAGEMENT}) WHERE date = "
                         f"(SELECT max(date) FROM ({sql.TOP_POSTS_BY_ENGAGEMENT}))")
def latest_x_posts(spark, sf):
    return views.latest_date_rows(views.VIEWS["vw_x_top_posts"](_tables(spark, sf)), [F.desc("engagement_count")])


@query("latest_x_users", f"SELECT * FROM ({sql.TOP_USERS_BY_FOLLOWERS}) WHERE date = "
                         f"(SELECT max(date) FROM ({sql.TOP_USERS_BY_FOLLOWERS}))")
def latest_x_users(spark, sf):
    return views.latest_date_rows(views.VIEWS["vw_x_top_users"](_tables(spark, sf)), [F.desc("followers_count")])


@query("latest_top_users", f"SELECT * FROM ({_TOP_USERS}) WHERE date = (SELECT max(date) FROM ({_TOP_USERS}))")
def latest_top_users(spark, sf):
    return views.latest_date_rows(views.hn_top_users(_tables(spark, sf)), [F.col("user_bucket"), F.col("rank")])

