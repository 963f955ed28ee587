"""SQL fragments: the same feeds as in ``feeds.py``, and shared expressions."""

from __future__ import annotations

from feedmetrics.functions.ids import HN_NAMESPACE, X_POST_NAMESPACE, X_USER_NAMESPACE
from feedmetrics.queries.feeds import DAY, INGEST, ITEM_TYPE, MARKER, STAMP
from feedmetrics.schemas import HN, HN_ITEM_TYPES, SILVER, X


def uuid5(namespace, expression: str) -> str:
    digest = f"sha1(from_hex('{namespace.hex}') || encode({expression}))"
    return (f"substr({digest},1,8) || '-' || substr({digest},9,4) || '-5' || substr({digest},14,3) || '-' || "
            f"translate(substr({digest},17,1),'0123456789abcdef','89ab89ab89ab89ab') || "
            f"substr({digest},18,3) || '-' || substr({digest},21,12)")


def hn_id(expression: str) -> str:
    return uuid5(HN_NAMESPACE, f"('HackerNews|' || {expression})")


def x_post_id(expression: str) -> str:
    return uuid5(X_POST_NAMESPACE, f"('X:' || {expression})")


def x_user_id(expression: str) -> str:
    return uuid5(X_USER_NAMESPACE, f"('X:' || {expression})")


def x_named_id(expression: str) -> str:
    return uuid5(X_USER_NAMESPACE, f"('X:username:' || {expression})")


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def choose(column: str, mapping: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def base(platform: str) -> str:
    """The prefix of a daily metric, out of a column named date."""
    return (f"date, '{platform}' AS platform, substr(date,1,4) AS year, substr(date,6,2) AS month, "
            f"substr(date,9,2) AS day, '{STAMP}' AS gold_processed_at_utc")


def _silver(name: str, platform: str, source: str, day_sql: str, columns: dict[str, str]) -> str:
    """A select with a silver table's full column list; absent ones are null."""
    chosen = {"platform": f"'{platform}'", "data_date": day_sql, "year": f"substr({day_sql},1,4)",
              "month": f"substr({day_sql},6,2)", "day": f"substr({day_sql},9,2)", "ingest_date": f"'{INGEST}'",
              "silver_processed_at_utc": f"'{STAMP}'", **columns}
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE"}
    select = ", ".join(
        f"CAST({chosen.get(f.name, 'NULL')} AS {kinds[f.dataType.simpleString()]}) AS {f.name}"
        for f in SILVER[name])
    return f"SELECT {select} FROM {source}"


ORDER_METRICS = """orders LEFT JOIN (
  SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS likes, count(*) AS retweets,
         max(l_linenumber) AS replies, count(*) FILTER (WHERE l_returnflag = 'R') AS quotes
  FROM lineitem GROUP BY l_orderkey) m ON o_orderkey = l_orderkey"""

_EVENT_USER = "'user' || user_id"

HN_POSTS = _silver("posts", HN, "events", day("ts"), {
    "post_id": hn_id("CAST(event_id AS VARCHAR)"), "source_post_id": "event_id",
    "author_user_id": hn_id(f"({_EVENT_USER})"), "author_username": _EVENT_USER,
    "post_type": choose("event_type", ITEM_TYPE), "title": "props", "score": "floor(value)",
    "created_at_utc": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"})

HN_USERS = _silver(
    "users", HN, "(SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, floor(max(value)) AS karma "
    "FROM events GROUP BY ALL)", "date", {
        "user_id": hn_id(f"({_EVENT_USER})"), "source_user_id": _EVENT_USER, "username": _EVENT_USER,
        "karma_score": "karma"})

X_USERS = _silver(
    "users", X, "(SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, o_custkey, floor(max(o_totalprice)) AS followers, "
    "count(*) AS following, bool_or(o_orderpriority = '1-URGENT') AS verified FROM orders GROUP BY ALL) "
    "JOIN customer ON o_custkey = c_custkey", "date", {
        "user_id": x_user_id("CAST(o_custkey AS VARCHAR)"), "source_user_id": "o_custkey", "username": "c_name",
        "display_name": "c_mktsegment", "followers_count": "followers", "following_count": "following",
        "is_verified": "verified"})

X_POSTS = _silver("posts", X, ORDER_METRICS, day("o_orderdate"), {
    "post_id": x_post_id("CAST(o_orderkey AS VARCHAR)"), "source_post_id": "o_orderkey",
    "author_user_id": x_user_id("CAST(o_custkey AS VARCHAR)"), "author_username": "'customer' || o_custkey",
    "post_type": "'tweet'", "content_text": "o_orderpriority", "like_count": "likes", "retweet_count": "retweets",
    "reply_count": "replies", "quote_count": "CASE WHEN quotes > 0 THEN quotes END",
    "created_at_utc": f"{day('o_orderdate')} || 'T00:00:00Z'"})

X_TAGS = _silver(
    "post_tags", X, """(
  SELECT l_orderkey, l_shipdate, unnest(string_split(p_name || ' ' || upper(p_name), ' ')) AS tag, 'hashtag' AS tag_type
  FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL
  SELECT l_orderkey, l_shipdate, p_brand, 'brand' FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    day("l_shipdate"), {"post_id": x_post_id("CAST(l_orderkey AS VARCHAR)"), "tag": "tag", "tag_type": "tag_type"})

X_RELATIONS = _silver("post_relations", X, "lineitem", day("l_shipdate"), {
    "post_id": x_post_id("CAST(l_orderkey AS VARCHAR)"), "related_source_post_id": "l_partkey",
    "relation_type": choose("l_returnflag", {"R": "retweeted", "A": "replied_to", "N": "quoted"})})


# --- gold over the typed feeds -----------------------------------------------

_POST_COLUMNS = "post_id, source_post_id, author_user_id, author_username, post_type"


def top_posts_by_score(post_type: str, posts: str = HN_POSTS, limit: int = 10) -> str:
    return (f"SELECT {base(HN)}, rank, {_POST_COLUMNS}, title, url, score FROM (SELECT *EXCLUDE (year, month, day), data_date AS date, "
            "row_number() OVER (PARTITION BY data_date ORDER BY score DESC, source_post_id DESC) AS rank "
            f"FROM ({posts}) "
            f"WHERE post_type = '{post_type}' AND score IS NOT NULL) WHERE rank <= {limit}")


def top_users_by_karma(direction: str, users: str = HN_USERS) -> str:
    return (f"SELECT {base(HN)}, rank, user_id, source_user_id, username, karma_score FROM "
            "(SELECT user_id, source_user_id, username, karma_score, data_date AS date, row_number() OVER "
            f"(PARTITION BY data_date ORDER BY karma_score {direction}, username {direction}) AS rank "
            f"FROM ({users}) WHERE karma_score IS NOT NULL) WHERE rank <= 10")


def top_users_by_followers(users: str = X_USERS) -> str:
    return (f"SELECT {base(X)}, rank, user_id, source_user_id, username, display_name, followers_count, "
            "following_count, is_verified FROM (SELECT *EXCLUDE (year, month, day), data_date AS date, row_number() "
            "OVER (PARTITION BY data_date ORDER BY followers_count DESC, username DESC, user_id DESC) AS rank "
            f"FROM ({users}) WHERE followers_count IS NOT NULL) WHERE rank <= 10")


TOP_USERS_BY_FOLLOWERS = top_users_by_followers()


def top_posts_by_engagement(posts: str = X_POSTS) -> str:
    return (f"SELECT {base(X)}, rank, {_POST_COLUMNS}, content_text, like_count, retweet_count, reply_count, "
            "quote_count, engagement_count FROM (SELECT *, row_number() OVER (PARTITION BY date "
            "ORDER BY engagement_count DESC, source_post_id DESC) AS rank FROM (SELECT *EXCLUDE (year, month, day), "
            "data_date AS date, coalesce(like_count,0)+coalesce(retweet_count,0)+coalesce(reply_count,0)"
            f"+coalesce(quote_count,0) AS engagement_count FROM ({posts}))) WHERE rank <= 10")


TOP_POSTS_BY_ENGAGEMENT = top_posts_by_engagement()


def hashtag_trends(tags: str = X_TAGS) -> str:
    return (f"SELECT {base(X)}, row_number() OVER (PARTITION BY date ORDER BY post_count DESC, tag DESC) AS rank, tag, "
            "'hashtag' AS tag_type, post_count FROM (SELECT data_date AS date, lower(tag) AS tag, count(*) AS post_count "
            f"FROM ({tags}) WHERE tag_type = 'hashtag' AND tag <> '' GROUP BY ALL)")


def daily_item_counts(posts: str = HN_POSTS) -> str:
    kinds = ", ".join(f"count(*) FILTER (WHERE post_type = '{k}') AS {k}_count" for k in HN_ITEM_TYPES)
    return (f"SELECT {base(HN)}, {kinds}, count(*) AS total_count FROM (SELECT data_date AS date, post_type "
            f"FROM ({posts})) GROUP BY date")


DAILY_ITEM_COUNTS = daily_item_counts()


def daily_users_metric(users: str, platform: str) -> str:
    return (f"SELECT {base(platform)}, count(DISTINCT user_id) AS total_users, count(DISTINCT user_id) AS active_users "
            f"FROM (SELECT data_date AS date, user_id FROM ({users})) GROUP BY date")


def row_hashes(table: str, names: list[str], rows: str) -> str:
    """table_name, key (the first column) and a hash over all columns, of every row of a table."""
    cells = ", ".join(f"coalesce(CAST({f'CAST({c} AS DECIMAL(9,2))' if c == 'data_quality_score' else c} AS VARCHAR), '~')"
                      for c in names)
    return (f"SELECT '{table}' AS table_name, {names[0]} AS key, md5(concat_ws('|', {cells})) AS row_hash "
            f"FROM ({rows})")


def quality_row(name: str, rows: str, platform: str) -> str:
    filled = " + ".join(f"(CASE WHEN {c} IS NOT NULL AND CAST({c} AS VARCHAR) <> '' THEN 1 ELSE 0 END)"
                        for c in SILVER[name].names)
    return (f"SELECT '{name}' AS table_name, '{platform}' AS platform, '{DAY}' AS data_date, "
            f"'{INGEST}' AS ingest_date, n AS row_count, w AS column_count, f AS non_null_cell_count, "
            "n * w AS total_cell_count, CASE WHEN n > 0 THEN round_even(CAST(f AS DOUBLE) / (n * w) * 100, 2) ELSE 0 END "
            f"AS data_quality_score, '{STAMP}' AS silver_processed_at_utc FROM (SELECT count(*) AS n, "
            f"CAST(CASE WHEN count(*) > 0 THEN {len(SILVER[name])} ELSE 0 END AS BIGINT) AS w, "
            f"CAST(coalesce(sum({filled}), 0) AS BIGINT) AS f FROM ({rows}))")


X_QUALITY = " UNION ALL ".join([
    quality_row("users", X_USERS, X), quality_row("posts", X_POSTS, X), quality_row("post_tags", X_TAGS, X),
    quality_row("post_relations", X_RELATIONS, X)])

_NO_TAGS = _silver("post_tags", HN, "events WHERE false", day("ts"), {})
_NO_RELATIONS = _silver("post_relations", HN, "events WHERE false", day("ts"), {})
HN_QUALITY = " UNION ALL ".join([
    quality_row("users", HN_USERS, HN), quality_row("posts", HN_POSTS, HN), quality_row("post_tags", _NO_TAGS, HN),
    quality_row("post_relations", _NO_RELATIONS, HN)])


# --- silver out of the item feeds ----------------------------------------------

_RANK = "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END"
AUTHOR = ("CASE WHEN event_type = 'purchase' THEN 'USER' || user_id WHEN event_type = 'signup' THEN '' "
          "ELSE 'user' || user_id END")
_CREATED = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_RUN = f"'{DAY}' AS data_date, '{INGEST}' AS ingest_date, '{STAMP}' AS silver_processed_at_utc"
_PARTS = "strftime(ts,'%Y') AS year, strftime(ts,'%m') AS month, strftime(ts,'%d') AS day"
_DAY_PARTS = f"'{DAY[:4]}' AS year, '{DAY[5:7]}' AS month, '{DAY[8:]}' AS day"


def _nulls(names: str, kind: str) -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name in names.split())


SILVER_HN_POSTS = f"""
SELECT {hn_id('CAST(event_id AS VARCHAR)')} AS post_id, '{HN}' AS platform, CAST(event_id AS VARCHAR) AS source_post_id,
  CASE WHEN author <> '' THEN {hn_id('author')} END AS author_user_id, author AS author_username,
  {choose('event_type', ITEM_TYPE)} AS post_type,
  CASE WHEN event_type = 'error' THEN 'on error' ELSE event_type || ' & ' || props END AS title,
  CASE WHEN event_type = 'error' THEN props || ' end' END AS content_text,
  {_nulls('url', 'VARCHAR')}, CAST(trunc(value) AS BIGINT) AS score,
  {_nulls('like_count retweet_count reply_count quote_count', 'BIGINT')}, {_nulls('lang source', 'VARCHAR')},
  {_CREATED} AS created_at_utc, {_PARTS}, {_RUN}
FROM (SELECT *, {AUTHOR} AS author FROM events)"""

_FIRST_AUTHORS = f"""(SELECT * FROM (SELECT author, row_number() OVER (PARTITION BY lower(author)
  ORDER BY {_RANK}, event_id) AS n FROM (SELECT *, {AUTHOR} AS author FROM events) WHERE author <> '') WHERE n = 1)"""

SILVER_HN_USERS = f"""
SELECT {hn_id('author')} AS user_id, '{HN}' AS platform, author AS source_user_id, author AS username,
  {_nulls('display_name', 'VARCHAR')}, CAST(floor(c_acctbal) AS BIGINT) AS karma_score,
  {_nulls('followers_count following_count', 'BIGINT')}, {_nulls('is_verified', 'BOOLEAN')},
  CASE WHEN c_nationkey > 4 THEN strftime(TIMESTAMP '1970-01-01' + to_days(CAST(c_custkey AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ')
  END AS user_created_at_utc, {_DAY_PARTS}, {_RUN}
FROM {_FIRST_AUTHORS} LEFT JOIN customer ON lower(author) = 'user' || c_custkey"""

SILVER_HN_TAGS = f"""
SELECT {hn_id('CAST(event_id AS VARCHAR)')} AS post_id, '{HN}' AS platform, tag, tag_type,
  {_CREATED} AS created_at_utc, {_PARTS}, {_RUN}
FROM (SELECT event_id, ts, {choose('event_type', MARKER)} AS tag, 'post_type' AS tag_type FROM events
  UNION ALL SELECT event_id, ts, 'author_user' || user_id, 'author' FROM events
  UNION ALL SELECT event_id, ts, 'Front_Page', 'hn_tag' FROM events
  UNION ALL SELECT event_id, ts, 'story_' || user_id, 'story_reference' FROM events)"""

SILVER_HN_RELATIONS = f"""
SELECT {hn_id('CAST(event_id AS VARCHAR)')} AS post_id, '{HN}' AS platform,
  CAST(user_id AS VARCHAR) AS related_source_post_id, relation_type, {_CREATED} AS created_at_utc, {_PARTS}, {_RUN}
FROM (SELECT *, 'parent' AS relation_type FROM events WHERE event_type = 'error'
  UNION ALL SELECT *, 'story' FROM events WHERE event_type IN ('error', 'click'))"""

# orders as posts: creation time in UTC, null where the text had no offset
def created_ts(day_sql: str) -> str:
    return (f"CASE o_orderpriority WHEN '1-URGENT' THEN {day_sql} - INTERVAL 2 HOUR "
            f"WHEN '2-HIGH' THEN {day_sql} + INTERVAL 10 HOUR + INTERVAL 20 MINUTE + INTERVAL 30500 MILLISECOND "
            f"WHEN '4-NOT SPECIFIED' THEN {day_sql} + INTERVAL 25 HOUR "
            f"WHEN '5-LOW' THEN {day_sql} + INTERVAL 8 HOUR + INTERVAL 14 MINUTE END")


CREATED_TS = created_ts("CAST(o_orderdate AS TIMESTAMP)")
_X_CREATED = ("CASE WHEN o_orderpriority = '2-HIGH' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.500000Z' "
              "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END")
_POST_KEY = "CAST(o_orderkey AS VARCHAR)"
_URGENT = "o_orderpriority = '1-URGENT'"
_AUTHOR_ID = f"CASE WHEN {_URGENT} THEN {x_named_id('c_name')} ELSE {x_user_id('CAST(o_custkey AS VARCHAR)')} END"

SILVER_X_POSTS = f"""
SELECT {x_post_id(_POST_KEY)} AS post_id, '{X}' AS platform, {_POST_KEY} AS source_post_id,
  {_AUTHOR_ID} AS author_user_id, c_name AS author_username,
  CASE WHEN {_URGENT} THEN 'tweet' WHEN o_orderstatus = 'F' THEN 'retweet' ELSE 'quote' END AS post_type,
  {_nulls('title', 'VARCHAR')}, o_orderpriority || ' & <b>' || o_orderstatus AS content_text,
  {_nulls('url', 'VARCHAR')}, {_nulls('score', 'BIGINT')}, likes AS like_count, retweets AS retweet_count,
  CAST(replies AS BIGINT) AS reply_count, quotes AS quote_count, 'en' AS lang, 'web' AS source,
  {_X_CREATED} AS created_at_utc, {_PARTS}, {_RUN}
FROM (SELECT *, {CREATED_TS} AS ts FROM {ORDER_METRICS} JOIN customer ON o_custkey = c_custkey)"""

SILVER_X_USERS = f"""
SELECT CASE WHEN sid IS NULL THEN {x_named_id('c_name')} ELSE {x_user_id('sid')} END AS user_id, '{X}' AS platform,
  sid AS source_user_id, c_name AS username, c_mktsegment AS display_name, {_nulls('karma_score', 'BIGINT')},
  CAST(floor(c_acctbal) AS BIGINT) AS followers_count, CAST(trunc(c_acctbal) AS BIGINT) AS following_count,
  CASE o_orderstatus WHEN 'O' THEN false ELSE true END AS is_verified,
  {_nulls('user_created_at_utc', 'VARCHAR')}, {_DAY_PARTS}, {_RUN}
FROM (SELECT *, CASE WHEN NOT {_URGENT} THEN CAST(o_custkey AS VARCHAR) END AS sid, row_number() OVER
  (PARTITION BY {_URGENT}, o_custkey ORDER BY o_orderkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey)
WHERE n = 1"""

SILVER_X_TAGS = f"""
SELECT {x_post_id(_POST_KEY)} AS post_id, '{X}' AS platform, tag, 'hashtag' AS tag_type,
  {_X_CREATED} AS created_at_utc, {_PARTS}, {_RUN}
FROM (SELECT o_orderkey, o_orderpriority, {CREATED_TS} AS ts,
  unnest([lower(c_mktsegment), lower(o_orderpriority), '#twice']) AS tag
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

SILVER_X_RELATIONS = f"""
SELECT {x_post_id(_POST_KEY)} AS post_id, '{X}' AS platform, target AS related_source_post_id, relation_type,
  {_X_CREATED} AS created_at_utc, {_PARTS}, {_RUN}
FROM (SELECT o_orderkey, o_orderpriority, {CREATED_TS} AS ts, CAST(o_custkey AS VARCHAR) AS target,
    CASE o_orderstatus WHEN 'F' THEN 'retweeted' ELSE 'quoted' END AS relation_type
  FROM orders WHERE NOT {_URGENT} AND o_orderstatus IN ('F', 'O')
  UNION ALL SELECT o_orderkey, o_orderpriority, {CREATED_TS}, 't' || o_custkey, 'quoted'
  FROM orders WHERE NOT {_URGENT})"""
