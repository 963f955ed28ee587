"""Silver -> gold: daily counts, user metrics, rankings, trends."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from feedmetrics.functions.measures import engagement
from feedmetrics.operators.days import dated, metric_columns, of_platform
from feedmetrics.operators.ranking import rank_by_count, top_k
from feedmetrics.schemas import GOLD, HN, HN_ITEM_TYPES, X


def daily_item_counts(posts: DataFrame, processed_at: str) -> DataFrame:
    """Posts per day and item type, zero where a type is absent."""
    kind = F.col("post_type")
    counts = [F.count_if(kind == name).alias(f"{name}_count") for name in HN_ITEM_TYPES]
    return (dated(posts, HN).where(kind.isin(*HN_ITEM_TYPES))
            .groupBy("date").agg(*counts, F.count(F.lit(1)).alias("total_count"))
            .select(*metric_columns(HN, processed_at),
                    *(f"{name}_count" for name in HN_ITEM_TYPES), "total_count"))


def daily_users_metric(users: DataFrame, platform: str, processed_at: str) -> DataFrame:
    """Exact distinct users per day; every user seen is an active one.

    The distinct count shuffles by (date, user) first, so a hot day spreads.
    """
    total = F.col("total_users")
    return (dated(users, platform).where(F.col("user_id") != "")
            .groupBy("date").agg(F.count_distinct("user_id").alias("total_users"))
            .select(*metric_columns(platform, processed_at), total, total.alias("active_users")))


def _ranked(df: DataFrame, platform: str, dataset: str, order: list[Column], limit: int,
            processed_at: str) -> DataFrame:
    base = metric_columns(platform, processed_at)
    return (top_k(df, ["date"], order, limit)
            .select(*base, *GOLD[platform][dataset].names[len(base):]))


def _key(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def top_posts_by_score(posts: DataFrame, post_type: str, processed_at: str, limit: int = 10) -> DataFrame:
    """Highest scores per day; equal scores by source id, descending too."""
    eligible = dated(posts, HN).where((F.col("post_type") == post_type) & F.col("score").isNotNull())
    order = [F.desc("score"), _key("source_post_id").desc(), F.desc("post_id")]
    return _ranked(eligible, HN, "top_story_posts", order, limit, processed_at)


def top_users_by_karma(users: DataFrame, processed_at: str, descending: bool = True,
                       limit: int = 10) -> DataFrame:
    """Highest (or lowest) karma per day; the name breaks ties in the same direction."""
    eligible = dated(users, HN).where(F.col("karma_score").isNotNull())
    keys = [F.col("karma_score"), _key("username"), F.col("user_id")]
    order = [key.desc() if descending else key.asc() for key in keys]
    return _ranked(eligible, HN, "top_users_by_karma", order, limit, processed_at)


def top_users_by_followers(users: DataFrame, processed_at: str, limit: int = 10) -> DataFrame:
    eligible = dated(users, X).where(F.col("followers_count").isNotNull())
    order = [F.desc("followers_count"), _key("username").desc(), F.desc("user_id")]
    return _ranked(eligible, X, "top_users_by_followers", order, limit, processed_at)


def top_posts_by_engagement(posts: DataFrame, processed_at: str, limit: int = 10) -> DataFrame:
    """Most interactions per day; a post without any still ranks, with zero."""
    measured = dated(posts, X).withColumn("engagement_count", engagement())
    order = [F.desc("engagement_count"), _key("source_post_id").desc(), F.desc("post_id")]
    return _ranked(measured, X, "top_posts_by_engagement", order, limit, processed_at)


def hashtag_trends(post_tags: DataFrame, processed_at: str) -> DataFrame:
    """All hashtags of a day by number of tag rows; equal counts by tag, descending."""
    counted = (dated(post_tags, X)
               .where((F.col("tag") != "") & (F.col("tag_type").isNull() | (F.col("tag_type") == "hashtag")))
               .groupBy("date", F.lower("tag").alias("tag"))
               .agg(F.count(F.lit(1)).alias("post_count")))
    return (rank_by_count(counted, ["date"], "post_count", "tag")
            .select(*metric_columns(X, processed_at), "rank", "tag",
                    F.lit("hashtag").alias("tag_type"), "post_count"))


def data_quality_summary(report: DataFrame, platform: str, processed_at: str) -> DataFrame:
    return of_platform(report, platform).withColumn("gold_processed_at_utc", F.lit(processed_at))


def hn_gold_tables(silver: Mapping[str, DataFrame], processed_at: str) -> dict[str, DataFrame]:
    users, posts = silver["users"], silver["posts"]
    return {
        "daily_item_counts": daily_item_counts(posts, processed_at),
        "daily_users_metric": daily_users_metric(users, HN, processed_at),
        "top_story_posts": top_posts_by_score(posts, "story", processed_at),
        "top_job_posts": top_posts_by_score(posts, "job", processed_at),
        "top_users_by_karma": top_users_by_karma(users, processed_at),
        "bottom_users_by_karma": top_users_by_karma(users, processed_at, descending=False),
        "data_quality_summary": data_quality_summary(silver["data_quality_report"], HN, processed_at),
    }


def x_gold_tables(silver: Mapping[str, DataFrame], processed_at: str) -> dict[str, DataFrame]:
    users, posts = silver["users"], silver["posts"]
    return {
        "daily_users_metric": daily_users_metric(users, X, processed_at),
        "top_users_by_followers": top_users_by_followers(users, processed_at),
        "top_posts_by_engagement": top_posts_by_engagement(posts, processed_at),
        "hashtag_trends": hashtag_trends(silver["post_tags"], processed_at),
        "data_quality_summary": data_quality_summary(silver["data_quality_report"], X, processed_at),
    }
