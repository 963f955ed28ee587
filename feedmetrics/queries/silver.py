"""Queries of the scalar functions, deduplication and the silver layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedmetrics.functions import casts, classify, ids, text, times
from feedmetrics.functions.measures import engagement
from feedmetrics.operators.days import on_day, row_date
from feedmetrics.operators.dedup import keep_first, keep_first_identified
from feedmetrics.operators.enrich import with_profiles
from feedmetrics.plans import silver_hn, silver_x
from feedmetrics.queries import feeds, sql
from feedmetrics.queries.feeds import RUN, table
from feedmetrics.queries.registry import query

# --- scalar functions --------------------------------------------------------

_SPACES = r"[\s\x{00A0}\x{2000}-\x{200A}]+"


def _unescaped(column: str) -> str:
    named = f"replace(replace(replace({column}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"')"
    return f"regexp_replace({named}, '&amp;?', '&', 'g')"


@query("clean_html", f"""
SELECT page_id, nullif(trim(regexp_replace(regexp_replace({_unescaped('html')}, '<[^>]+>', ' ', 'g'),
  '{_SPACES}', ' ', 'g')), '') AS cleaned FROM pages""")
def clean_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.clean_html(F.col("html")).alias("cleaned"))


@query("clean_text", f"""
SELECT page_id AS id, nullif(trim(regexp_replace({_unescaped('html')}, '{_SPACES}', ' ', 'g')), '') AS cleaned FROM pages
UNION ALL SELECT doc_id, nullif(trim(regexp_replace(text, '{_SPACES}', ' ', 'g')), '') FROM documents""")
def clean_text(spark, sf):
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("raw"))
    documents = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("raw"))
    return pages.unionByName(documents).select("id", text.clean_text(F.col("raw")).alias("cleaned"))


@query("stable_ids", f"""
SELECT p_partkey, {sql.hn_id('p_name')} AS hn_id, {sql.x_post_id('CAST(p_partkey AS VARCHAR)')} AS x_post_id,
  CASE WHEN p_size > 25 THEN {sql.x_user_id('CAST(p_partkey AS VARCHAR)')}
       WHEN p_size > 10 THEN {sql.x_named_id('p_brand')} END AS x_user_id FROM part""")
def stable_ids(spark, sf):
    key = F.col("p_partkey").cast("string")
    return table(spark, sf, "part").select(
        "p_partkey", ids.hn_id(F.col("p_name")).alias("hn_id"), ids.x_post_id(key).alias("x_post_id"),
        ids.x_user_id(F.when(F.col("p_size") > 25, key), F.when(F.col("p_size") > 10, F.col("p_brand")))
        .alias("x_user_id"))


@query("epoch_parts", """
SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS created_at_utc, strftime(t, '%Y') AS year,
  strftime(t, '%m') AS month, strftime(t, '%d') AS day
FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN date_trunc('second', ts) END AS t FROM events)""")
def epoch_parts(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    raw = F.when(F.col("event_type") == "view", F.lit("soon")).otherwise(F.concat(F.lit(" "), seconds))
    epoch = casts.int_from_text(raw)
    return table(spark, sf, "events").select(
        "event_id", times.epoch_text(epoch).alias("created_at_utc"),
        *(column.alias(name) for name, column in times.part_columns(times.epoch_timestamp(epoch)).items()))


@query("iso_timestamps", f"""
SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN strftime(t, '%Y-%m-%dT%H:%M:%S') || '.500000Z'
  ELSE strftime(t, '%Y-%m-%dT%H:%M:%SZ') END AS created_at_utc, strftime(t, '%Y') AS year,
  strftime(t, '%m') AS month, strftime(t, '%d') AS day
FROM (SELECT o_orderkey, o_orderpriority, {sql.created_ts('o_orderdate')} AS t FROM orders)""")
def iso_timestamps(spark, sf):
    created = times.iso_timestamp(feeds.created_text(feeds.day_text("o_orderdate")))
    return table(spark, sf, "orders").select(
        "o_orderkey", times.utc_text(created).alias("created_at_utc"),
        *(column.alias(name) for name, column in times.part_columns(created).items()))


@query("date_parts", """
SELECT o_orderkey, CASE WHEN ok THEN strftime(o_orderdate, '%Y') END AS year,
  CASE WHEN ok THEN strftime(o_orderdate, '%m') END AS month, CASE WHEN ok THEN strftime(o_orderdate, '%d') END AS day
FROM (SELECT *, o_orderstatus = 'F' OR (o_orderstatus = 'O' AND day(o_orderdate) > 9 AND month(o_orderdate) > 9) AS ok
  FROM orders)""")
def date_parts(spark, sf):
    """Order dates padded, unpadded and with a bad month."""
    ts, status = F.col("o_orderdate").cast("timestamp"), F.col("o_orderstatus")
    value = (F.when(status == "F", F.date_format(ts, " yyyy-MM-dd")).when(status == "O", F.date_format(ts, "yyyy-M-d"))
             .otherwise(F.date_format(ts, "yyyy-13-dd")))
    return table(spark, sf, "orders").select(
        "o_orderkey", *(column.alias(name) for name, column in times.date_part_columns(value).items()))


@query("safe_integers", """
SELECT event_id, CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS from_text,
  CAST(trunc(value) AS BIGINT) AS from_number, CAST(NULL AS BIGINT) AS from_decimal_text,
  CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) AS from_json FROM events""")
def safe_integers(spark, sf):
    digits = F.regexp_extract("props", r"(\d+)", 1)
    return table(spark, sf, "events").select(
        "event_id", casts.int_from_text(F.concat(F.lit(" +"), digits, F.lit(" "))).alias("from_text"),
        casts.int_from_number(F.col("value")).alias("from_number"),
        casts.int_from_text(F.concat(digits, F.lit(".5"))).alias("from_decimal_text"),
        casts.int_of(F.try_parse_json("props"), "$.k").alias("from_json"))


@query("safe_booleans", """
SELECT p_partkey, CASE WHEN p_size <= 10 THEN true WHEN p_size <= 20 THEN false END AS from_text,
  CASE p_size WHEN 1 THEN true WHEN 0 THEN false END AS from_json FROM part""")
def safe_booleans(spark, sf):
    size = F.col("p_size")
    word = F.when(size <= 10, " YES").when(size <= 20, "0").otherwise(F.col("p_name"))
    return table(spark, sf, "part").select(
        "p_partkey", casts.bool_from_text(word).alias("from_text"),
        casts.bool_of(F.parse_json(size.cast("string"))).alias("from_json"))


@query("id_text", """
SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS as_text,
  CASE WHEN p_size > 25 THEN CAST(p_partkey AS VARCHAR) END AS or_null FROM part""")
def id_text(spark, sf):
    """Numbers and quoted numbers are one id; empty and null are none."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    quoted = F.concat(F.lit('"'), key, F.lit('"'))
    mixed = F.parse_json(F.when(size > 25, quoted).otherwise(key))
    partly = F.parse_json(F.when(size > 40, key).when(size > 25, quoted).when(size > 10, F.lit('""')).otherwise("null"))
    return table(spark, sf, "part").select("p_partkey", casts.id_text(mixed).alias("as_text"),
                                           casts.id_text(partly).alias("or_null"))


@query("item_types", f"""
SELECT event_id, {sql.choose('event_type', feeds.ITEM_TYPE)} AS from_tags,
  CASE WHEN event_type = 'view' THEN 'poll' ELSE {sql.choose('event_type', feeds.ITEM_TYPE)} END AS post_type,
  CASE WHEN event_type = 'view' THEN 'comment' WHEN event_type = 'click' THEN 'ask' ELSE 'unknown' END AS with_all_tags
FROM events""")
def item_types(spark, sf):
    kind = F.col("event_type")
    tags = F.array(F.lit("front_page"), feeds.choose(kind, feeds.MARKER))
    every = F.when(kind == "view", F.array(*map(F.lit, ("story", "ask_hn", "poll", "job", "comment")))) \
             .when(kind == "click", F.array(F.lit("story"), F.lit("ask_hn")))
    return table(spark, sf, "events").select(
        "event_id", classify.hn_type_from_tags(tags).alias("from_tags"),
        classify.hn_post_type(F.when(kind == "view", "poll").otherwise(kind), tags).alias("post_type"),
        classify.hn_post_type(kind, every).alias("with_all_tags"))


@query("tag_types", """
SELECT event_id, prefix || '_' || user_id AS tag, CASE prefix WHEN 'author' THEN 'author' WHEN 'story' THEN 'story_reference'
  WHEN 'comment' THEN 'comment_reference' WHEN 'poll' THEN 'poll_reference' WHEN 'job' THEN 'job_reference'
  ELSE 'hn_tag' END AS tag_type
FROM events, (SELECT unnest(['author', 'story', 'comment', 'poll', 'job', 'show']) AS prefix)
UNION ALL SELECT event_id, unnest(['story', 'ask', 'comment', 'job', 'poll', 'ask_hn', 'front']) AS tag,
  unnest(['post_type', 'post_type', 'post_type', 'post_type', 'post_type', 'post_type', 'hn_tag']) FROM events""")
def tag_types(spark, sf):
    prefixed = [F.concat(F.lit(f"{name}_"), "user_id") for name in ("author", "story", "comment", "poll", "job", "show")]
    plain = [F.lit(name) for name in ("story", "ask", "comment", "job", "poll", "ask_hn", "front")]
    tags = table(spark, sf, "events").select("event_id", F.explode(F.array(*prefixed, *plain)).alias("tag"))
    return tags.withColumn("tag_type", classify.hn_tag_type(F.col("tag")))


@query("reference_types", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'retweet' WHEN o_orderstatus = 'O' THEN 'reply' ELSE 'tweet' END
  AS post_type, CASE WHEN o_orderstatus = 'P' THEN 'quoted' WHEN o_orderstatus = 'O' THEN 'replied_to' END AS relation_type
FROM orders""")
def reference_types(spark, sf):
    """The post type takes references as they are; relations are trimmed and lower-cased."""
    status = F.col("o_orderstatus")
    types = (F.when(status == "F", F.array(F.lit("quoted"), F.lit("replied_to"), F.lit("retweeted")))
             .when(status == "O", F.array(F.lit("quoted"), F.lit("replied_to"))).otherwise(F.array(F.lit(" Quoted"))))
    raw = feeds.choose(status, {"F": "liked", "O": "Replied_To ", "P": " QUOTED"})
    return table(spark, sf, "orders").select("o_orderkey", classify.x_post_type(types).alias("post_type"),
                                             classify.x_relation_type(raw).alias("relation_type"))


@query("engagement", f"""
SELECT source_post_id, coalesce(like_count,0)+coalesce(retweet_count,0)+coalesce(reply_count,0)+coalesce(quote_count,0)
  AS engagement_count FROM ({sql.X_POSTS})""")
def post_engagement(spark, sf):
    return feeds.x_posts(spark, sf).select("source_post_id", engagement().alias("engagement_count"))


@query("hourly_windows", """
SELECT strftime(w, '%Y-%m-%dT%H:%M:%SZ') AS window_start, count(e.ts) AS events
FROM (SELECT DISTINCT date_trunc('day', ts) + to_hours(h) AS w
      FROM events, (SELECT CAST(unnest(range(24)) AS INTEGER) AS h)) LEFT JOIN events e ON date_trunc('hour', e.ts) = w
GROUP BY w""")
def hourly_windows(spark, sf):
    """Every hour of every day seen, with its events."""
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    hours = (events.select(F.to_date("ts").alias("day")).distinct()
             .select(F.explode(times.hour_windows(F.col("day"))).alias("hour")))
    counted = events.groupBy(F.window("ts", "1 hour").start.alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return hours.join(counted, "hour", "left").select(
        times.utc_text(F.col("hour")).alias("window_start"), F.coalesce("n", F.lit(0)).alias("events"))


@query("row_dates", """
SELECT event_id, CASE event_type WHEN 'view' THEN '2024-01-31' WHEN 'signup' THEN NULL
  ELSE strftime(ts, '%Y-%m-%d') END AS row_date FROM events""")
def row_dates(spark, sf):
    """By data date, by parts, by creation time, or none."""
    kind, day = F.col("event_type"), feeds.day_text("ts")
    parts = kind.isin("click", "purchase")
    rows = table(spark, sf, "events").select(
        "event_id", F.when(kind == "view", F.lit(feeds.DAY)).otherwise("").alias("data_date"),
        F.when(parts, F.substring(day, 1, 4)).alias("year"), F.when(parts, F.substring(day, 6, 2)).alias("month"),
        F.when(parts, F.substring(day, 9, 2)).otherwise("").alias("day"),
        F.when(kind == "error", F.concat(day, F.lit("T00:00:00Z"))).when(kind == "signup", "soon").alias("created_at_utc"))
    return rows.select("event_id", row_date(rows).alias("row_date"))


@query("rows_of_day", f"SELECT source_post_id, data_date FROM ({sql.HN_POSTS}) WHERE data_date = '2024-01-15'")
def rows_of_day(spark, sf):
    return on_day(feeds.hn_posts(spark, sf), "2024-01-15").select("source_post_id", "data_date")


# --- deduplication and lookup ----------------------------------------------------

@query("keep_first", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER
  (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def first_events(spark, sf):
    return keep_first(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "value")


@query("keep_first_identified", """
SELECT event_id, user_id FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN user_id END AS user_id,
  row_number() OVER (PARTITION BY user_id, event_type = 'view' ORDER BY event_id) AS n, event_type FROM events)
WHERE n = 1 OR event_type = 'view'""")
def first_identified(spark, sf):
    """Rows without an id are all kept."""
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id"))
    return keep_first_identified(rows, "user_id", ["event_id"])


_FIRST_TURN = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n
  FROM conversations) WHERE n = 1)"""


@query("keep_first_posts", f"""
SELECT CAST(conv_id AS VARCHAR) AS source_post_id, upper(role) AS author_username,
  nullif(trim(regexp_replace(text, '{_SPACES}', ' ', 'g')), '') AS title, turn AS score FROM {_FIRST_TURN}""")
def first_posts(spark, sf):
    flat = silver_hn.flatten(feeds.conversation_items(spark, sf))
    return silver_hn.posts(flat, *RUN).select("source_post_id", "author_username", "title", "score")


@query("keep_first_tags", f"""
SELECT {sql.hn_id('CAST(conv_id AS VARCHAR)')} AS post_id, role AS tag, 'hn_tag' AS tag_type
FROM (SELECT DISTINCT conv_id, role FROM conversations)""")
def first_tags(spark, sf):
    """Repeated tags of a post in either case collapse to the first spelling."""
    flat = silver_hn.flatten(feeds.conversation_items(spark, sf))
    return silver_hn.post_tags(flat, *RUN).select("post_id", "tag", "tag_type")


@query("keep_first_relations", f"""
SELECT {sql.hn_id('CAST(conv_id AS VARCHAR)')} AS post_id, 'root' AS related_source_post_id, 'story' AS relation_type,
  strftime(TIMESTAMP '1970-01-01' + to_seconds(turn), '%Y-%m-%dT%H:%M:%SZ') AS created_at_utc FROM {_FIRST_TURN}""")
def first_relations(spark, sf):
    flat = silver_hn.flatten(feeds.conversation_items(spark, sf))
    return silver_hn.post_relations(flat, *RUN).select(
        "post_id", "related_source_post_id", "relation_type", "created_at_utc")


@query("users_enriched", """
SELECT user_key, CASE WHEN c_custkey IS NOT NULL THEN CAST(floor(c_acctbal) AS BIGINT) END AS karma,
  CASE WHEN c_nationkey > 4 THEN c_custkey * 86400 END AS created
FROM (SELECT DISTINCT 'user' || user_id AS user_key FROM events) LEFT JOIN customer ON user_key = 'user' || c_custkey""")
def users_enriched(spark, sf):
    users = table(spark, sf, "events").select(F.concat(F.lit("user"), "user_id").alias("user_key")).distinct()
    return with_profiles(users, feeds.profiles(spark, sf))


# --- silver ------------------------------------------------------------------------

@query("silver_hn_posts", sql.SILVER_HN_POSTS)
def hn_posts(spark, sf):
    return silver_hn.posts(silver_hn.flatten(feeds.hn_items(spark, sf)), *RUN)


@query("silver_hn_users", sql.SILVER_HN_USERS)
def hn_users(spark, sf):
    flat = silver_hn.flatten(feeds.hn_items(spark, sf))
    return silver_hn.users(flat, *RUN, profiles=feeds.profiles(spark, sf))


@query("silver_hn_tags", sql.SILVER_HN_TAGS)
def hn_tags(spark, sf):
    return silver_hn.post_tags(silver_hn.flatten(feeds.hn_items(spark, sf)), *RUN)


@query("silver_hn_relations", sql.SILVER_HN_RELATIONS)
def hn_relations(spark, sf):
    return silver_hn.post_relations(silver_hn.flatten(feeds.hn_items(spark, sf)), *RUN)


@query("silver_x_posts", sql.SILVER_X_POSTS)
def x_posts(spark, sf):
    return silver_x.posts(silver_x.flatten(feeds.x_items(spark, sf)), *RUN)


@query("silver_x_users", sql.SILVER_X_USERS)
def x_users(spark, sf):
    return silver_x.users(silver_x.flatten(feeds.x_items(spark, sf)), *RUN)


@query("silver_x_tags", sql.SILVER_X_TAGS)
def x_tags(spark, sf):
    return silver_x.post_tags(silver_x.flatten(feeds.x_items(spark, sf)), *RUN)


@query("silver_x_relations", sql.SILVER_X_RELATIONS)
def x_relations(spark, sf):
    return silver_x.post_relations(silver_x.flatten(feeds.x_items(spark, sf)), *RUN)
