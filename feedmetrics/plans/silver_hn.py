"""HN bronze items -> silver users, posts, tags and relations.

``flatten`` types each JSON item once; the four tables read its columns, so a
table pays only for the fields it uses. ``seq`` is the position of an item in
the day: item types in their fixed order, then landing order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedmetrics.functions import casts, classify
from feedmetrics.functions.ids import hn_id
from feedmetrics.functions.text import blank_to_null, clean_html, strip
from feedmetrics.functions.times import date_part_columns, epoch_text
from feedmetrics.operators.dedup import keep_first, keep_first_marked
from feedmetrics.operators.enrich import with_profiles
from feedmetrics.operators.quality import conform
from feedmetrics.schemas import HN, SILVER


_ITEM = ("objectID string, author string, created_at_i variant, _tags array<string>, title string, "
         "story_text string, story_title string, comment_text string, url string, points variant, "
         "parent_id string, story_id string")

# More tags than this are not compared with each other within a row.
_FEW_TAGS = 64


def flatten(items: DataFrame) -> DataFrame:
    """(seq, item_type, item VARIANT) -> typed columns; non-object items are dropped.

    Fields are read as text, and again out of the whole item where their kind tells what the text means.
    """
    opened = casts.open_objects(items.select("seq", "item_type", "item", F.col("item").alias("whole")), "item", _ITEM)

    def truthy(name: str) -> Column:
        return casts.truthy_of_text(F.col(name), F.col("whole"), f"$.{name}")

    def text(name: str) -> Column:
        return casts.text_of_text(F.col(name), F.col("whole"), f"$.{name}")

    typed = opened.withColumn("post_type", classify.hn_post_type(F.col("item_type"), F.col("_tags")))
    is_comment = F.col("post_type") == "comment"
    return typed.select(
        "seq", "post_type", F.col("_tags").alias("tags"),
        blank_to_null(strip(truthy("objectID"))).alias("source_post_id"),
        # a blank but present author stays as '' and has no id
        strip(truthy("author")).alias("author"),
        casts.int_of(F.col("created_at_i")).alias("created_epoch"),
        F.when(is_comment, text("story_title")).otherwise(text("title")).alias("title_html"),
        F.when(is_comment, text("comment_text")).otherwise(text("story_text")).alias("content_html"),
        text("url").alias("url"),
        casts.int_of(F.col("points")).alias("score"),
        blank_to_null(strip(text("parent_id"))).alias("parent_id"),
        blank_to_null(strip(text("story_id"))).alias("story_id"))


def _lineage(data_date: str, ingest_date: str, processed_at: str) -> dict[str, Column]:
    return {"platform": F.lit(HN), "data_date": F.lit(data_date), "ingest_date": F.lit(ingest_date),
            "silver_processed_at_utc": F.lit(processed_at)}


def _post_id() -> Column:
    """Computed per post, before its tags or links are spread over rows."""
    return hn_id(F.col("source_post_id")).alias("post_id")


def _created() -> dict[str, Column]:
    text = epoch_text(F.col("created_epoch"))
    return {"created_at_utc": text, "year": F.substring(text, 1, 4), "month": F.substring(text, 6, 2),
            "day": F.substring(text, 9, 2)}


def first_deliveries(flat: DataFrame) -> DataFrame:
    """The first item of each post, and ``spread``: whether more must be read for its tags and links.

    That is so when the post was delivered again, or has too many tags to compare them within the row.
    """
    first = keep_first_marked(flat.where(F.col("source_post_id").isNotNull()), ["source_post_id"], ["seq"], "again")
    return first.withColumn("spread", F.col("again") | (F.coalesce(F.size("tags"), F.lit(0)) > _FEW_TAGS)).drop("again")


def users(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str,
          profiles: DataFrame | None = None) -> DataFrame:
    """One row per lower-cased author; the first spelling names the user."""
    authors = (flat.where(F.col("author") != "")
               .select("seq", "author", F.lower("author").alias("user_key")))
    known = with_profiles(keep_first(authors, ["user_key"], ["seq"]), profiles)
    author = F.col("author")
    return conform(known.select(
        hn_id(author).alias("user_id"), author.alias("source_user_id"), author.alias("username"),
        F.col("karma").alias("karma_score"), epoch_text(F.col("created")).alias("user_created_at_utc"),
        *(c.alias(n) for n, c in date_part_columns(F.lit(data_date)).items()),
        *(c.alias(n) for n, c in _lineage(data_date, ingest_date, processed_at).items()),
    ), SILVER["users"])


def posts(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """One row per source id; text is cleaned after deduplication."""
    first = keep_first(flat.where(F.col("source_post_id").isNotNull()).drop("tags", "parent_id", "story_id"),
                       ["source_post_id"], ["seq"])
    return _posts(first, data_date, ingest_date, processed_at)


def _posts(first: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    author = F.col("author")
    return conform(first.select(
        _post_id(), "source_post_id",
        hn_id(blank_to_null(author)).alias("author_user_id"), author.alias("author_username"),
        "post_type", clean_html(F.col("title_html")).alias("title"),
        clean_html(F.col("content_html")).alias("content_text"), "url", "score",
        *(c.alias(n) for n, c in _created().items()),
        *(c.alias(n) for n, c in _lineage(data_date, ingest_date, processed_at).items()),
    ), SILVER["posts"])


def post_tags(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """One row per post, tag (any case) and tag type; the first spelling stays."""
    tag = F.col("tag")
    exploded = (flat.where(F.col("source_post_id").isNotNull())
                .select("seq", _post_id(), "created_epoch",
                        F.posexplode("tags").alias("tag_pos", "raw_tag"))
                .withColumn("tag", strip(F.col("raw_tag"))).where(tag != "")
                .withColumn("tag_type", classify.hn_tag_type(tag)))
    first = keep_first(exploded, [F.col("post_id"), F.lower(tag), F.col("tag_type")],
                       ["seq", "tag_pos"])
    return conform(first.select(
        "post_id", "tag", "tag_type",
        *(c.alias(n) for n, c in _created().items()),
        *(c.alias(n) for n, c in _lineage(data_date, ingest_date, processed_at).items()),
    ), SILVER["post_tags"])


def _by_created_day(posts: DataFrame, *columns: str) -> DataFrame:
    """Ids and days worked out and a day's posts gathered for a write, before a post becomes several rows."""
    return (posts.select(_post_id(), *columns, *(c.alias(n) for n, c in _created().items()))
            .hint("rebalance", "year", "month", "day"))


def _own_tags(first: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """post_tags of posts that were delivered once: equal tags are found within the row."""
    named = F.filter(F.transform("tags", strip), lambda tag: tag != "")
    typed = (_by_created_day(first, "tags")
             .withColumn("own", F.transform(named, lambda tag: F.struct(
                 tag.alias("tag"), classify.hn_tag_type(tag).alias("tag_type"))))
             .withColumn("keys", F.transform("own", lambda tag: F.concat_ws("|", tag.tag_type, F.lower(tag.tag)))))
    keys = F.col("keys")
    distinct = F.filter("own", lambda tag, place: F.array_position(keys, F.get(keys, place)) == place + 1)
    return conform(typed.select(
        "post_id", F.inline(distinct), "created_at_utc", "year", "month", "day",
        *(c.alias(n) for n, c in _lineage(data_date, ingest_date, processed_at).items()),
    ), SILVER["post_tags"])


def _links() -> Column:
    return F.array(F.struct(F.lit("parent").alias("relation_type"), F.col("parent_id").alias("target")),
                   F.struct(F.lit("story").alias("relation_type"), F.col("story_id").alias("target")))


def post_relations(flat: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """parent and story links of a post."""
    exploded = (flat.where(F.col("source_post_id").isNotNull())
                .select("seq", _post_id(), "created_epoch", F.inline(_links()))
                .where(F.col("target").isNotNull()))
    first = keep_first(exploded, ["post_id", "target", "relation_type"], ["seq"])
    return conform(first.select(
        "post_id", F.col("target").alias("related_source_post_id"), "relation_type",
        *(c.alias(n) for n, c in _created().items()),
        *(c.alias(n) for n, c in _lineage(data_date, ingest_date, processed_at).items()),
    ), SILVER["post_relations"])


def _own_relations(first: DataFrame, data_date: str, ingest_date: str, processed_at: str) -> DataFrame:
    """post_relations of posts that were delivered once, whose two links differ by type."""
    linked = first.where(F.col("parent_id").isNotNull() | F.col("story_id").isNotNull())
    links = _by_created_day(linked, "parent_id", "story_id").select("*", F.inline(_links()))
    return conform(links.where(F.col("target").isNotNull()).select(
        "post_id", F.col("target").alias("related_source_post_id"), "relation_type", "created_at_utc", "year", "month", "day",
        *(c.alias(n) for n, c in _lineage(data_date, ingest_date, processed_at).items()),
    ), SILVER["post_relations"])


# Tables that come gathered by day, see lake.write_partitioned.
DEALT = ("post_tags", "post_relations")


def silver_tables(flat: DataFrame, first: DataFrame, data_date: str, ingest_date: str, processed_at: str,
                  profiles: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four tables out of staged items and staged ``first_deliveries``.

    Most posts come once, so their tags and links are their own and nothing has to meet. Only the items of
    ``spread`` posts are spread over rows, compared and sorted.
    """
    run = (data_date, ingest_date, processed_at)
    once, spread = first.where(~F.col("spread")), first.where("spread").select("source_post_id")
    tags, relations = _own_tags(once, *run), _own_relations(once, *run)
    if not spread.isEmpty():
        more = flat.join(spread, "source_post_id", "left_semi")
        tags, relations = (own.unionByName(of(more, *run).hint("rebalance", "year", "month", "day"))
                           for own, of in ((tags, post_tags), (relations, post_relations)))
    return {"users": users(flat, *run, profiles=profiles), "posts": _posts(first, *run),
            "post_tags": tags, "post_relations": relations}
