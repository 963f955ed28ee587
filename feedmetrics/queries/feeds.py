"""Feed-shaped inputs derived from the star-schema tables.

The given tables hold no social data, so each query reads them through one of
these: whole tables, no subsets. Typed feeds have the silver layout; item feeds
are JSON as a collector would land it. The SQL side of each is in ``sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from feedmetrics.functions.ids import hn_id, x_post_id, x_user_id
from feedmetrics.operators.quality import conform
from feedmetrics.schemas import HN, HN_ITEM_TYPES, SILVER, X
from feedmetrics.session import configure

STAMP = "2024-02-01T00:00:00Z"
INGEST = "2024-02-01"
DAY = "2024-01-31"
RUN = (DAY, INGEST, STAMP)

# events.event_type -> item type, and -> marker tag
ITEM_TYPE = {"view": "story", "click": "ask", "error": "comment", "purchase": "job", "signup": "poll"}
MARKER = {**ITEM_TYPE, "click": "ask_hn"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def choose(column: Column, mapping: dict[str, str]) -> Column:
    result = F
    for key, value in mapping.items():
        result = result.when(column == key, F.lit(value))
    return result


def day_text(column: str) -> Column:
    return F.date_format(F.col(column).cast("timestamp"), "yyyy-MM-dd")


def month_text(column: str) -> Column:
    """The first day of a month, for feeds of fewer days."""
    return F.date_format(F.col(column).cast("timestamp"), "yyyy-MM-01")


def _dated(day: Column) -> dict[str, Column]:
    return {"data_date": day, "year": F.substring(day, 1, 4), "month": F.substring(day, 6, 2),
            "day": F.substring(day, 9, 2), "ingest_date": F.lit(INGEST),
            "silver_processed_at_utc": F.lit(STAMP)}


def _silver(df: DataFrame, name: str, platform: str, day: Column, columns: dict[str, Column]) -> DataFrame:
    chosen = {"platform": F.lit(platform), **_dated(day), **columns}
    return conform(df.select(*(c.alias(n) for n, c in chosen.items())), SILVER[name])


# --- typed feeds -----------------------------------------------------------
#
# ``dealt`` gathers a day's rows for a write, while a row is a few keys: the ids
# worked out behind that are 36 characters each, which no codec packs.

def _gathered(rows: DataFrame, dealt: bool) -> DataFrame:
    return rows.hint("rebalance", "date") if dealt else rows


def hn_posts(spark: SparkSession, sf: str, dealt: bool = False) -> DataFrame:
    events = _gathered(table(spark, sf, "events").withColumn("date", day_text("ts")), dealt)
    source_id, author = F.col("event_id").cast("string"), F.concat(F.lit("user"), "user_id")
    return _silver(events, "posts", HN, F.col("date"), {
        "post_id": hn_id(source_id), "source_post_id": source_id,
        "author_user_id": hn_id(author), "author_username": author,
        "post_type": choose(F.col("event_type"), ITEM_TYPE), "title": F.col("props"),
        "score": F.floor("value").cast("bigint"),
        "created_at_utc": F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")})


def hn_users(spark: SparkSession, sf: str, dealt: bool = False) -> DataFrame:
    """One row per day and user, with the day's highest value as karma."""
    events = (table(spark, sf, "events").groupBy(day_text("ts").alias("date"), "user_id")
              .agg(F.floor(F.max("value")).cast("bigint").alias("karma")))
    name = F.concat(F.lit("user"), "user_id")
    return _silver(_gathered(events, dealt), "users", HN, F.col("date"), {
        "user_id": hn_id(name), "source_user_id": name, "username": name, "karma_score": F.col("karma")})


def x_users(spark: SparkSession, sf: str, day=day_text, dealt: bool = False) -> DataFrame:
    """One row per order day and customer."""
    orders = (table(spark, sf, "orders").groupBy(day("o_orderdate").alias("date"), "o_custkey")
              .agg(F.floor(F.max("o_totalprice")).cast("bigint").alias("followers"),
                   F.count(F.lit(1)).alias("following"),
                   F.max(F.col("o_orderpriority") == "1-URGENT").alias("verified")))
    named = orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    source_id = F.col("o_custkey").cast("string")
    return _silver(_gathered(named, dealt), "users", X, F.col("date"), {
        "user_id": x_user_id(source_id, F.col("c_name")), "source_user_id": source_id, "username": F.col("c_name"),
        "display_name": F.col("c_mktsegment"), "followers_count": F.col("followers"),
        "following_count": F.col("following"), "is_verified": F.col("verified")})


def _order_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with four interaction counts; orders without lines have none."""
    lines = (table(spark, sf, "lineitem").groupBy("l_orderkey")
             .agg(F.sum("l_quantity").cast("bigint").alias("likes"), F.count(F.lit(1)).alias("retweets"),
                  F.max("l_linenumber").cast("bigint").alias("replies"),
                  F.count_if(F.col("l_returnflag") == "R").alias("quotes")))
    return table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def x_posts(spark: SparkSession, sf: str, day=day_text, dealt: bool = False) -> DataFrame:
    orders = _gathered(_order_metrics(spark, sf).withColumn("date", day("o_orderdate")), dealt)
    source_id, author = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return _silver(orders, "posts", X, F.col("date"), {
        "post_id": x_post_id(source_id), "source_post_id": source_id,
        "author_user_id": x_user_id(author, F.lit(None).cast("string")),
        "author_username": F.concat(F.lit("customer"), author), "post_type": F.lit("tweet"),
        "content_text": F.col("o_orderpriority"), "like_count": F.col("likes"),
        "retweet_count": F.col("retweets"), "reply_count": F.col("replies"),
        "quote_count": F.when(F.col("quotes") > 0, F.col("quotes")),
        "created_at_utc": F.concat(day_text("o_orderdate"), F.lit("T00:00:00Z"))})


def x_tags(spark: SparkSession, sf: str, day=day_text, dealt: bool = False) -> DataFrame:
    """The words of a part's name, for every line of it; brands carry another tag type.

    ``dealt`` gathers lines before they become tags: a line is one row then, and
    five or so behind.
    """
    # Id and day are worked out per line, not per tag.
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", day("l_shipdate").alias("date")).join(
        table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"),
        F.col("l_partkey") == F.col("p_partkey"))
    lines = _gathered(lines.drop("l_partkey", "p_partkey"), dealt).withColumn(
        "post_id", x_post_id(F.col("l_orderkey").cast("string")))
    words = F.transform(F.split(F.concat_ws(" ", "p_name", F.upper("p_name")), " "),
                        lambda word: F.struct(word.alias("tag"), F.lit("hashtag").alias("tag_type")))
    brand = F.array(F.struct(F.col("p_brand").alias("tag"), F.lit("brand").alias("tag_type")))
    tags = lines.select("post_id", "date", F.inline(F.concat(words, brand)))
    return _silver(tags, "post_tags", X, F.col("date"), {
        "post_id": F.col("post_id"), "tag": F.col("tag"),
        "tag_type": F.col("tag_type")})


def x_relations(spark: SparkSession, sf: str, day=day_text, dealt: bool = False) -> DataFrame:
    lines = _gathered(table(spark, sf, "lineitem").withColumn("date", day("l_shipdate")), dealt)
    kind = {"R": "retweeted", "A": "replied_to", "N": "quoted"}
    return _silver(lines, "post_relations", X, F.col("date"), {
        "post_id": x_post_id(F.col("l_orderkey").cast("string")),
        "related_source_post_id": F.col("l_partkey").cast("string"),
        "relation_type": choose(F.col("l_returnflag"), kind)})


def x_silver(spark: SparkSession, sf: str, day=day_text, dealt: bool = False) -> dict[str, DataFrame]:
    """The tables, the largest shuffles first."""
    return {"post_tags": x_tags(spark, sf, day, dealt), "posts": x_posts(spark, sf, day, dealt),
            "post_relations": x_relations(spark, sf, day, dealt), "users": x_users(spark, sf, day, dealt)}


# --- item feeds (JSON) -----------------------------------------------------

def _json(*fields: Column) -> Column:
    """A JSON object column ``item`` out of typed fields.

    It comes out of a generator, as a landed one comes out of a scan:
    otherwise each use of it would build the object again.
    """
    return F.inline(F.array(F.struct(F.to_variant_object(F.struct(*fields)).alias("item"))))


def hn_items(spark: SparkSession, sf: str) -> DataFrame:
    """events as search hits: seq, item_type, item."""
    events = table(spark, sf, "events")
    kind, user = F.col("event_type"), F.concat(F.lit("user"), "user_id")
    author = (F.when(kind == "purchase", F.upper(user)).when(kind == "error", F.concat(F.lit("  "), user, F.lit(" ")))
              .when(kind == "signup", F.lit("   ")).otherwise(user))
    tags = F.array(choose(kind, MARKER), F.concat(F.lit("author_"), user), F.lit("Front_Page"),
                   F.lit("front_page"), F.concat(F.lit("story_"), "user_id"), F.lit(" "))
    comment = kind == "error"
    item = _json(
        F.col("event_id").cast("string").alias("objectID"), author.alias("author"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_at_i"), tags.alias("_tags"),
        F.when(~comment, F.concat(F.lit("<b>"), kind, F.lit("</b> &amp; "), "props")).alias("title"),
        F.when(comment, F.concat(F.lit("on "), kind)).alias("story_title"),
        F.when(comment, F.concat(F.lit("&lt;i&gt;"), "props", F.lit("&nbsp; end"))).alias("comment_text"),
        F.col("value").alias("points"),
        F.when(comment, F.col("user_id")).alias("parent_id"),
        F.when(comment | (kind == "click"), F.col("user_id").cast("string")).alias("story_id"))
    item_type = choose(kind, ITEM_TYPE)
    rank = F.array_position(F.array(*map(F.lit, HN_ITEM_TYPES)), item_type)
    return events.select(F.struct(rank.alias("type_rank"), "event_id").alias("seq"),
                         item_type.alias("item_type"), item,
                         F.unix_seconds(F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("window_start"),
                         F.lit(0).cast("bigint").alias("page"), F.col("event_id").alias("pos"))


def conversation_items(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as repeated deliveries of one post per conversation."""
    turns = table(spark, sf, "conversations")
    item = _json(F.col("conv_id").cast("string").alias("objectID"), F.upper("role").alias("author"),
                 F.col("turn").alias("created_at_i"),
                 F.array(F.col("role"), F.upper("role")).alias("_tags"), F.col("text").alias("title"),
                 F.col("turn").alias("points"), F.lit("root").alias("story_id"))
    return turns.select(F.struct("turn").alias("seq"), F.lit("story").alias("item_type"), item)


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as profiles of the users of the same number, in two spellings."""
    customers = table(spark, sf, "customer")
    spelled = F.explode(F.array(F.concat(F.lit("user"), "c_custkey"), F.concat(F.lit("USER"), "c_custkey")))
    return (customers.select("c_custkey", "c_acctbal", "c_nationkey", spelled.alias("username"))
            .select("username",
                    F.when(F.col("username").startswith("USER"), F.floor("c_acctbal").cast("bigint"))
                    .otherwise(F.lit(-1)).alias("karma"),
                    F.when(F.col("c_nationkey") > 4, F.col("c_custkey") * 86400).alias("created")))


def created_text(day: Column) -> Column:
    """Days in five spellings of a timestamp, one of them without an offset."""
    suffix = choose(F.col("o_orderpriority"), {
        "1-URGENT": "T00:00:00+02:00", "2-HIGH": " 10:20:30.5Z", "3-MEDIUM": "T08:14:22",
        "4-NOT SPECIFIED": "T23:30:00-0130", "5-LOW": "T08:14Z"})
    return F.concat(day, suffix)


def x_items(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customers as posts: seq, item."""
    orders = _order_metrics(spark, sf).join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    urgent, status = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderstatus")
    user = F.struct(
        F.when(~urgent, F.col("c_custkey")).alias("id"),
        F.concat(F.lit(" "), "c_name").alias("username"),
        F.when(status == "F", F.lit(" ")).alias("display_name"), F.col("c_mktsegment").alias("name"),
        F.floor("c_acctbal").cast("string").alias("followers_count"), F.col("c_acctbal").alias("following_count"),
        choose(status, {"F": " Yes", "O": "0", "P": "maybe"}).alias("verified"),
        F.lit(1).alias("is_verified"))
    metrics = F.struct(F.col("likes").cast("string").alias("like_count"), F.col("retweets").alias("retweet_count"),
                       F.concat(F.lit("+"), "replies").alias("reply_count"), F.col("quotes").alias("quote_count"))
    hashtags = F.array(F.struct(F.concat(F.lit("#"), "c_mktsegment").alias("tag")),
                       F.struct(F.lower("c_mktsegment").alias("tag")))
    entities = F.struct(F.array(F.col("o_orderpriority"), F.lit("##Twice"), F.lit("#")).alias("hashtags"))
    kind = choose(status, {"F": "retweeted", "O": " Quoted ", "P": "liked"})
    references = F.when(~urgent, F.array(
        F.struct(kind.alias("type"), F.col("o_custkey").alias("id"), F.lit("t").alias("tweet_id")),
        F.struct(F.lit("quoted").alias("type"), F.lit(None).cast("bigint").alias("id"),
                 F.concat(F.lit("t"), "o_custkey").alias("tweet_id")),
        F.struct(kind.alias("type"), F.col("o_custkey").alias("id"), F.lit("u").alias("tweet_id"))))
    item = _json(F.col("o_orderkey").alias("id"),
                 F.concat(F.lit("  "), "o_orderpriority", F.lit(" &amp;\n <b>"), "o_orderstatus").alias("text"),
                 F.lit(" en ").alias("lang"), F.lit("web").alias("source"), created_text(day_text("o_orderdate")).alias("created_at"),
                 user.alias("user"), metrics.alias("metrics"), hashtags.alias("hashtags"),
                 entities.alias("entities"), references.alias("referenced_tweets"))
    return orders.select(F.struct(F.col("o_orderkey").alias("pos")).alias("seq"), item)


def api_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One response per (order, line number): window_start, page, response.

    Line numbers leave gaps. How many lines share a number decides whether the
    page is an ordinary one, the last, an empty or a malformed one.
    """
    lines = (table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber")
             .agg(F.min("l_partkey").alias("part"), F.count(F.lit(1)).alias("copies")))
    marker = F.element_at(F.array(*map(F.lit, ("story", "comment", "job", "poll", "ask_hn", "other", "other"))),
                          F.col("l_linenumber").cast("int"))
    hit = F.struct(F.concat(F.lit("p"), "part").alias("objectID"), F.array(marker).alias("_tags"))
    unnamed = F.struct(F.lit(None).cast("string").alias("objectID"), F.array(F.lit("story")).alias("_tags"))
    hits = F.when(F.col("copies") == 3, F.array().cast("array<struct<objectID:string,_tags:array<string>>>")) \
            .otherwise(F.array(hit, unnamed))
    last = F.when(F.col("copies") == 2, F.col("l_linenumber")).otherwise(99)
    good = F.to_json(F.struct(hits.alias("hits"), last.cast("bigint").alias("nbPages")))
    bad = F.lit('{"hits": "none", "nbPages": 99}')
    return lines.select(F.col("l_orderkey").alias("window_start"),
                        (F.col("l_linenumber") - 1).cast("bigint").alias("page"),
                        F.parse_json(F.when(F.col("copies") > 3, bad).otherwise(good)).alias("response"))


def x_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """One payload document per order line, in the accepted forms and one other."""
    lines = table(spark, sf, "lineitem")
    posts = F.array(F.struct(F.col("l_partkey").alias("id")), F.struct(F.col("l_suppkey").alias("id")))
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    text = (F.when(flag == "A", F.to_json(posts))
            .when(flag == "N", F.to_json(F.struct(posts.alias("tweets"), F.array(F.lit("x")).alias("data"))))
            .when(status == "F", F.to_json(F.struct(F.lit("x").alias("tweets"), posts.alias("data"))))
            .otherwise(F.to_json(F.struct(posts.alias("items")))))
    return lines.select("l_orderkey", "l_linenumber", F.parse_json(text).alias("document"))


def alert_events(spark: SparkSession, sf: str) -> DataFrame:
    """events as notification records, with a message form per event type."""
    events = table(spark, sf, "events")
    kind = F.col("event_type")
    full = F.to_json(F.struct(
        F.concat(F.lit("alarm-"), "user_id").alias("AlarmName"), F.lit("ALARM").alias("NewStateValue"),
        F.col("props").alias("NewStateReason"), F.lit("eu").alias("Region"),
        day_text("ts").alias("StateChangeTime"),
        F.struct(F.lit("Errors").alias("MetricName"), F.lit("Jobs").alias("Namespace")).alias("Trigger")))
    message = (F.when(kind == "error", full)
               .when(kind == "purchase", F.concat(F.lit('{"AlarmName": "a'), "user_id", F.lit('", "Trigger": "t"}')))
               .when(kind == "click", F.concat(F.lit("plain "), "user_id")).when(kind == "signup", F.lit("")))
    record = F.struct(F.struct(message.alias("Message")).alias("Sns"))
    text = F.when(kind == "view", F.lit('{"Records": "none"}')).otherwise(
        F.to_json(F.struct(F.array(record).alias("Records"))))
    return events.select("event_id", F.parse_json(text).alias("event"))


def function_errors(spark: SparkSession, sf: str) -> DataFrame:
    """ts, function_name, errors: every event reports one error or none."""
    return table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("job-"), "user_id").alias("function_name"),
        (F.col("event_type") == "error").cast("bigint").alias("errors"))
