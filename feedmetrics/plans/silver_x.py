"""X bronze posts -> silver users, posts, tags and relations.

As for HN: ``flatten`` types each JSON post once, ``seq`` is its position in
the dataset. Most posts come once: their tags and references are compared within
the row, and only ids meet others to find out which posts come again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmetrics.functions import casts, classify
from feedmetrics.functions.ids import x_post_id, x_user_id
from feedmetrics.functions.measures import ENGAGEMENT_FIELDS
from feedmetrics.functions.text import clean_text, squeeze
from feedmetrics.functions.times import date_part_columns, iso_timestamp, part_columns, utc_text
from feedmetrics.operators.dedup import keep_first
from feedmetrics.operators.quality import conform
from feedmetrics.schemas import SILVER, X


_ITEM = ("id variant, text variant, lang variant, source variant, created_at variant, "
         "user struct<id:variant,username:variant,display_name:variant,name:variant,followers_count:variant,"
         "following_count:variant,verified:variant,is_verified:variant,created_at:variant>, "
         f"metrics struct<{','.join(f'{name}:variant' for name in ENGAGEMENT_FIELDS)}>, "
         "hashtags array<variant>, entities struct<hashtags:array<variant>>, "
         "referenced_tweets array<struct<type:variant,id:variant,tweet_id:variant>>")


def _hashtag_texts(entry: Column) -> Column:
    """A hashtag entry as (text, alternative): a string, or its tag and text fields."""
    text = F.coalesce(casts.string_of(entry), casts.string_of(entry, "$.tag"))
    return F.struct(text.alias("text"), casts.string_of(entry, "$.text").alias("alternative"))


def _reference(entry: Column) -> Column:
    target = F.coalesce(casts.id_text(entry["id"]), casts.id_text(entry["tweet_id"]))
    return F.struct(casts.string_of(entry["type"]).alias("type"), target.alias("target"))


def flatten(items: DataFrame) -> DataFrame:
    """(seq, item VARIANT) -> typed columns; non-object items are dropped."""

    def text(name: str) -> Column:
        return casts.string_of(F.col(name))

    def count(name: str) -> Column:
        return casts.int_of(F.col(name))

    no_tags = F.array().cast("array<variant>")
    hashtags = F.concat(F.coalesce("hashtags", no_tags), F.coalesce("entities.hashtags", no_tags))
    return casts.open_objects(items.select("seq", "item"), "item", _ITEM).select(
        "seq", casts.id_text(F.col("id")).alias("source_post_id"),
        F.col("user").isNotNull().alias("has_user"),
        casts.id_text(F.col("user.id")).alias("source_user_id"),
        text("user.username").alias("username_raw"), text("user.display_name").alias("display_name_raw"),
        text("user.name").alias("name_raw"), count("user.followers_count").alias("followers_count"),
        count("user.following_count").alias("following_count"),
        F.coalesce(casts.bool_of(F.col("user.verified")), casts.bool_of(F.col("user.is_verified")))
        .alias("is_verified"),
        text("user.created_at").alias("user_created_raw"), iso_timestamp(text("created_at")).alias("created"),
        text("text").alias("text_raw"), text("lang").alias("lang_raw"), text("source").alias("source_raw"),
        *(count(f"metrics.{name}").alias(name) for name in ENGAGEMENT_FIELDS),
        F.transform(hashtags, lambda entry: _hashtag_texts(entry)).alias("hashtags"),
        F.transform("referenced_tweets", lambda entry: _reference(entry)).alias("references"))


def _lineage(data_date: str, ingest_date: str, processed_at: str) -> list[Column]:
    return [F.lit(X).alias("platform"), F.lit(data_date).alias("data_date"),
            F.lit(ingest_date).alias("ingest_date"), F.lit(processed_at).alias("silver_processed_at_utc")]


def _post_id() -> Column:
    """Computed per post, before its tags or references are spread over rows."""
    return x_post_id(F.col("source_post_id")).alias("post_id")


def _created() -> list[Column]:
    created = F.col("created")
    return [utc_text(created).alias("created_at_utc"),
            *(column.alias(name) for name, column in part_columns(created).items())]


def users(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """One row per source id or, without one, per user name: two key spaces."""
    named = flat.where("has_user").withColumn("username", clean_text(F.col("username_raw")))
    by_name = F.when(F.col("source_user_id").isNull(), F.col("username"))
    first = keep_first(
        named.where(F.coalesce("source_user_id", "username").isNotNull())
        .select("seq", "source_user_id", "username", "display_name_raw", "name_raw", "followers_count",
                "following_count", "is_verified", "user_created_raw"),
        [F.col("source_user_id"), by_name], ["seq"])
    return conform(first.select(
        x_user_id(F.col("source_user_id"), F.col("username")).alias("user_id"),
        "source_user_id", "username",
        F.coalesce(clean_text(F.col("display_name_raw")), clean_text(F.col("name_raw"))).alias("display_name"),
        "followers_count", "following_count", "is_verified",
        utc_text(iso_timestamp(F.col("user_created_raw"))).alias("user_created_at_utc"),
        *(column.alias(name) for name, column in date_part_columns(F.lit(data_date)).items()),
        *_lineage(data_date, ingest_date, processed_at),
    ), SILVER["users"])


def delivered_again(flat: DataFrame) -> DataFrame:
    """The ids of posts that come more than once. Nothing but ids is shuffled for it."""
    return (flat.where(F.col("source_post_id").isNotNull()).groupBy("source_post_id")
            .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("source_post_id"))


def marked(flat: DataFrame, again: DataFrame) -> DataFrame:
    """The rows with ``again``: true for posts of these ids, else null."""
    return flat.join(again.withColumn("again", F.lit(True)), "source_post_id", "left")


def _raw_posts(flat: DataFrame) -> DataFrame:
    return (flat.where(F.col("source_post_id").isNotNull())
            .withColumn("post_type", classify.x_post_type(F.col("references.type")))
            .select("seq", "source_post_id", "source_user_id", "username_raw", "post_type", "text_raw", "lang_raw",
                    "source_raw", "created", *ENGAGEMENT_FIELDS))


def posts(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    return _posts(keep_first(_raw_posts(flat), ["source_post_id"], ["seq"]), data_date, ingest_date, processed_at)


def _posts(first: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    named = first.withColumn("author_username", clean_text(F.col("username_raw")))
    return conform(named.select(
        _post_id(), "source_post_id",
        x_user_id(F.col("source_user_id"), F.col("author_username")).alias("author_user_id"),
        "author_username", "post_type",
        clean_text(F.col("text_raw")).alias("content_text"), *ENGAGEMENT_FIELDS,
        clean_text(F.col("lang_raw")).alias("lang"), clean_text(F.col("source_raw")).alias("source"),
        *_created(), *_lineage(data_date, ingest_date, processed_at),
    ), SILVER["posts"])


def post_tags(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """Distinct lower-cased hashtags of a post, one leading # removed."""
    entries = (flat.where(F.col("source_post_id").isNotNull())
               .select("seq", _post_id(), "created",
                       F.posexplode(F.array_distinct("hashtags")).alias("tag_pos", "entry")))
    # Columns of their own: inside a conditional each use would call Python again.
    cleaned = (entries.withColumn("text", clean_text(F.col("entry.text")))
               .withColumn("alternative", clean_text(F.col("entry.alternative"))))
    marked = cleaned.withColumn("tag", F.coalesce("text", "alternative")).where(F.col("tag").isNotNull())
    bodies = marked.withColumn("body", clean_text(F.when(F.col("tag").startswith("#"), F.substr("tag", F.lit(2)))))
    bare = F.when(F.col("tag").startswith("#"), F.col("body")).otherwise(F.col("tag"))
    tagged = bodies.withColumn("tag", F.lower(bare)).where(F.col("tag").isNotNull())
    first = keep_first(tagged, ["post_id", "tag"], ["seq", "tag_pos"])
    return conform(first.select(
        "post_id", "tag", F.lit("hashtag").alias("tag_type"),
        *_created(), *_lineage(data_date, ingest_date, processed_at),
    ), SILVER["post_tags"])


def post_relations(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    entries = (flat.where(F.col("source_post_id").isNotNull())
               .select("seq", _post_id(), "created",
                       F.posexplode("references").alias("reference_pos", "reference"))
               .withColumn("relation_type", classify.x_relation_type(F.col("reference.type")))
               .withColumn("target", F.col("reference.target"))
               .where(F.col("relation_type").isNotNull() & F.col("target").isNotNull())
               .drop("reference"))
    first = keep_first(entries, ["post_id", "target", "relation_type"], ["seq", "reference_pos"])
    return conform(first.select(
        "post_id", F.col("target").alias("related_source_post_id"), "relation_type",
        *_created(), *_lineage(data_date, ingest_date, processed_at),
    ), SILVER["post_relations"])


def _by_created_day(rows: DataFrame, *columns: str | Column) -> DataFrame:
    """A day's posts gathered for a write, before they get ids and become several rows: a post is one short row."""
    parts = (column.alias(name) for name, column in part_columns(F.col("created")).items())
    return rows.select("source_post_id", "created", *columns, *parts).hint("rebalance", "year", "month", "day")


def _written(rows: DataFrame, table: str, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    return conform(rows.select("*", utc_text(F.col("created")).alias("created_at_utc"),
                               *_lineage(data_date, ingest_date, processed_at)), SILVER[table])


def _needs_unescape() -> Column:
    """Whether a hashtag of the post may hold a character reference; Python resolves those, one row each."""
    return F.coalesce(F.exists("hashtags", lambda entry: F.coalesce(entry.text, F.lit("")).contains("&")
                               | F.coalesce(entry.alternative, F.lit("")).contains("&")), F.lit(False))


def _own_tags(once: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """post_tags of posts that come once, without character references: equal tags are found within the row."""

    def cleaned(entry: Column) -> Column:
        return F.coalesce(squeeze(entry.text), squeeze(entry.alternative))

    def bare(tag: Column) -> Column:
        return F.lower(F.when(tag.startswith("#"), squeeze(F.substr(tag, F.lit(2)))).otherwise(tag))

    tags = F.array_distinct(F.array_compact(F.transform(F.transform("hashtags", cleaned), bare)))
    rows = _by_created_day(once, tags.alias("tags")).withColumn("post_id", _post_id())
    return _written(rows.withColumn("tag_type", F.lit("hashtag")).withColumn("tag", F.explode("tags")), "post_tags",
                    data_date, ingest_date, processed_at)


def _own_relations(once: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """post_relations of posts that come once: equal references are found within the row."""
    # No relation type has a bar in it, so type and target can be told apart again.
    links = F.array_distinct(F.array_compact(F.transform("references", lambda entry: F.concat(
        classify.x_relation_type(entry.type), F.lit("|"), entry.target))))
    rows = (_by_created_day(once, links.alias("links")).withColumn("post_id", _post_id())
            .withColumn("link", F.explode("links")).withColumn("relation_type", F.substring_index("link", "|", 1)))
    target = F.substr("link", F.length("relation_type") + 2)
    return _written(rows.withColumn("related_source_post_id", target), "post_relations", data_date, ingest_date, processed_at)


# Tables that come gathered by day, see lake.write_partitioned.
DEALT = ("posts", "post_tags", "post_relations")


def silver_tables(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> dict[str, DataFrame]:
    """The four tables, the largest shuffles first. Without the column of ``marked``, all posts come once."""
    run = (data_date, ingest_date, processed_at)
    again = F.coalesce("again", F.lit(False)) if "again" in flat.columns else F.lit(False)
    known = flat.where(F.col("source_post_id").isNotNull())
    first = _raw_posts(known.where(~again))
    odd = known.where(again | _needs_unescape())
    tags = _own_tags(known.where(~again & ~_needs_unescape()), *run)
    relations = _own_relations(known.where(~again), *run)
    if "again" in flat.columns:
        more = known.where(again)
        first = first.unionByName(keep_first(_raw_posts(more), ["source_post_id"], ["seq"]))
        relations = relations.unionByName(post_relations(more, *run).hint("rebalance", "year", "month", "day"))
    if not odd.isEmpty():
        tags = tags.unionByName(post_tags(odd, *run).hint("rebalance", "year", "month", "day"))
    columns = [name for name in first.columns if name not in ("seq", "source_post_id", "created")]
    return {"post_tags": tags, "posts": _posts(_by_created_day(first, *columns), *run), "post_relations": relations,
            "users": users(flat, *run)}
