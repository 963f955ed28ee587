import pytest
from pyspark.sql import functions as F

from feedmetrics.operators.quality import quality_report, quality_score
from feedmetrics.plans import silver_hn, silver_x
from feedmetrics.schemas import HN, SILVER, X

RUN = ("2026-05-20", "2026-05-21", "2026-05-21T00:00:00Z")


def by(rows, *names):
    return sorted([tuple(row[n] for n in names) for row in rows], key=repr)


def test_hn_users_first_spelling_and_profiles(spark, items):
    flat = silver_hn.flatten(items([{"author": "mira"}, {"author": "Mira"}, {"author": " nils "}, {"author": "  "},
                                    {"author": None}, {"author": 0}, 7]))
    profiles = spark.createDataFrame([("MIRA", 123, 1735689600), ("nils", 7, None)],
                                     "username string, karma bigint, created bigint")
    rows = silver_hn.users(flat, *RUN, profiles=profiles).collect()
    assert by(rows, "username", "karma_score", "user_created_at_utc") == [
        ("mira", 123, "2025-01-01T00:00:00Z"), ("nils", 7, None)]
    assert {(r.year, r.month, r.day) for r in rows} == {("2026", "05", "20")}
    assert silver_hn.users(flat, *RUN).columns == SILVER["users"].names


def test_hn_profiles_two_spellings_keep_first_alphabetically(spark, items):
    profiles = spark.createDataFrame([("nils", 1, None), ("Nils", 2, None), (None, 3, None), ("", 4, None)],
                                     "username string, karma bigint, created bigint")
    rows = silver_hn.users(silver_hn.flatten(items([{"author": "nils"}])), *RUN, profiles=profiles).collect()
    assert by(rows, "karma_score") == [(2,)]


def test_hn_posts(items):
    values = [
        {"objectID": "1", "author": "a", "created_at_i": 1779264000, "title": "A &amp; <b>B</b>", "story_text": "&lt;p&gt;t", "points": "1_0", "url": "u&amp;"},
        {"objectID": 1, "title": "duplicate"}, {"objectID": "  "}, {"objectID": 0}, {"title": "none"},
        {"objectID": "2", "author": "", "created_at_i": "soon", "points": 3.7},
        {"objectID": "3", "author": " ", "points": "3.7"}]
    rows = silver_hn.posts(silver_hn.flatten(items(values)), *RUN).collect()
    assert by(rows, "source_post_id", "title", "content_text", "score", "created_at_utc", "day", "author_username", "url") == [
        ("1", "A & B", "t", 10, "2026-05-20T08:00:00Z", "20", "a", "u&amp;"),
        ("2", None, None, 3, None, None, None, None),
        ("3", None, None, None, None, None, "", None)]
    assert {r.author_user_id is None for r in rows if r.source_post_id in "23"} == {True}
    assert all(r.platform == HN and r.like_count is None for r in rows)


def test_hn_comment_uses_story_title(items):
    value = {"objectID": 5, "story_title": "S", "comment_text": "C", "title": "no", "story_text": "no"}
    row = silver_hn.posts(silver_hn.flatten(items([value], "comment")), *RUN).first()
    assert (row.post_type, row.title, row.content_text) == ("comment", "S", "C")


def test_hn_type_from_tags_when_folder_is_unknown(items):
    values = [{"objectID": 1, "_tags": ["story", "ask_hn"]}, {"objectID": 2, "_tags": "story"}]
    rows = silver_hn.posts(silver_hn.flatten(items(values, "misc")), *RUN).collect()
    assert by(rows, "source_post_id", "post_type") == [("1", "ask"), ("2", "unknown")]


def test_hn_tags(items):
    values = [{"objectID": 1, "_tags": ["Story", "story", " author_a ", None, " ", 7]}, {"objectID": 2, "_tags": "story"},
              {"objectID": 3}, {"_tags": ["story"]}]
    rows = silver_hn.post_tags(silver_hn.flatten(items(values)), *RUN).collect()
    assert by(rows, "tag", "tag_type") == [("7", "hn_tag"), ("Story", "hn_tag"), ("author_a", "author"), ("story", "post_type")]


def test_hn_relations(items):
    values = [{"objectID": 1, "parent_id": 9, "story_id": "9"}, {"objectID": 1, "parent_id": "9"},
              {"objectID": 2, "parent_id": " ", "story_id": ""}, {"objectID": 3, "parent_id": 0}]
    rows = silver_hn.post_relations(silver_hn.flatten(items(values)), *RUN).collect()
    assert by(rows, "related_source_post_id", "relation_type") == [("0", "parent"), ("9", "parent"), ("9", "story")]


def x_flat(items, values):
    return silver_x.flatten(items(values))


def test_x_users(items):
    """One row per id, or per name without one: the first. What is no user, or names nobody, is left out."""
    named = [{"id": 7000 + n % 3, "username": f" writer-{n} ", "followers_count": str(n)} for n in range(5)]
    values = [{"user": u} for u in named] + [{"user": {"username": "ghost", "name": part}} for part in "ab"]
    values += [{"user": {"id": None}}, {"user": []}, {"user": "writer-0"}, None, {"other": 1}]
    rows = silver_x.users(x_flat(items, values), *RUN).collect()
    assert by(rows, "source_user_id", "username", "followers_count", "display_name") == [
        ("7000", "writer-0", 0, None), ("7001", "writer-1", 1, None), ("7002", "writer-2", 2, None),
        (None, "ghost", None, "a")]


def test_x_user_fallbacks(items):
    values = [{"user": {"id": 1, "display_name": " ", "name": "N &amp; M", "verified": "maybe", "is_verified": 0,
                        "created_at": "2020-01-01T00:00:00+01:00"}}]
    row = silver_x.users(x_flat(items, values), *RUN).first()
    assert (row.display_name, row.is_verified, row.user_created_at_utc) == ("N & M", False, "2019-12-31T23:00:00Z")


def test_x_post_keys(items):
    """Posts are told apart by id, as number or text alike; those without one are left out."""
    values = [{"id": key, "text": str(n)} for n, key in enumerate((31, "31", 32, "", None, 0))] + [{}, 4]
    rows = silver_x.posts(x_flat(items, values), *RUN).collect()
    assert by(rows, "source_post_id", "content_text", "post_type") == [
        ("0", "5", "tweet"), ("31", "0", "tweet"), ("32", "2", "tweet")]


@pytest.mark.parametrize("given,count", [(4, 4), ("4", 4), (" +4 ", 4), (4.9, 4), ("4.9", None), ("many", None),
                                         (None, None), ([4], None), (True, 1)])
def test_x_post_counts(items, given, count):
    names = ["like_count", "retweet_count", "reply_count", "quote_count"]
    row = silver_x.posts(x_flat(items, [{"id": 1, "metrics": dict.fromkeys(names, given)}]), *RUN).first()
    assert [row[name] for name in names] == [count] * 4


def test_x_post_text_and_kind(items):
    kinds = {"quoted": "quote", "retweeted": "retweet", "replied_to": "reply", None: "tweet"}
    values = [{"id": kind or "none", "text": "\tone &lt;\n two&nbsp;", "created_at": "2025-11-30T23:30:00-01:00",
               "referenced_tweets": [{"type": kind, "id": 8}] if kind else []} for kind in kinds]
    rows = silver_x.posts(x_flat(items, values), *RUN).collect()
    assert by(rows, "source_post_id", "post_type", "content_text", "month") == sorted(
        (kind or "none", to, "one < two", "12") for kind, to in kinds.items())


def test_x_hashtag_forms(items):
    values = [{"id": 1, "hashtags": ["JAZZ", "#Opera", "jazz"]},
              {"id": 2, "hashtags": [{"tag": "JAZZ"}, {"text": "#Opera"}, {"tag": "jazz"}]},
              {"id": 3, "entities": {"hashtags": ["JAZZ", "opera"]}},
              {"id": 4, "hashtags": ["##x", "#", "# &amp;amp;", 5, None, {"tag": 1, "text": "t"}], "entities": 5},
              {"id": 5, "hashtags": "JAZZ"}]
    rows = silver_x.post_tags(x_flat(items, values), *RUN).collect()
    tags = {}
    for row in rows:
        tags.setdefault(row.post_id, set()).add(row.tag)
    assert sorted(tags.values(), key=sorted) == [{"#x", "&", "t"}] + [{"jazz", "opera"}] * 3


def test_x_relations(items):
    values = [{"id": 1, "referenced_tweets": [{"type": "retweeted", "id": 123}, {"type": " Retweeted ", "id": "123"},
                                              {"type": "liked", "id": 1}, {"type": "quoted"}, 5,
                                              {"type": "quoted", "id": "", "tweet_id": 9}]},
              {"id": 2, "referenced_tweets": {"type": "quoted", "id": 1}}]
    rows = silver_x.post_relations(x_flat(items, values), *RUN).collect()
    assert by(rows, "related_source_post_id", "relation_type") == [("123", "retweeted"), ("9", "quoted")]


def test_quality_score(spark):
    df = spark.createDataFrame([(1, None, ""), (0, False, "value")], "a bigint, b boolean, c string")
    row = quality_score(df).first()
    assert (row.row_count, row.column_count, row.non_null_cell_count, row.total_cell_count, row.data_quality_score) == (
        2, 3, 4, 6, 66.67)


def test_quality_score_rounds_half_even_like_python(spark):
    for filled in (1, 3, 5, 77):
        df = spark.range(800).select(F.when(F.col("id") < filled, 1).alias("a"))
        assert quality_score(df).first().data_quality_score == round(filled / 800 * 100, 2)


def test_quality_report_keeps_empty_tables(spark, items):
    flat = x_flat(items, [{"id": 1, "user": {"id": 2}}])
    rows = quality_report(silver_x.silver_tables(flat, *RUN), X, *RUN).collect()
    assert by(rows, "table_name", "row_count", "column_count") == [
        ("post_relations", 0, 0), ("post_tags", 0, 0), ("posts", 1, 23), ("users", 1, 16)]
    assert {r.data_quality_score for r in rows if r.row_count == 0} == {0.0}


def test_unescape_is_evaluated_once(items):
    plan = silver_x.post_tags(x_flat(items, [{"id": 1}]), *RUN)._jdf.queryExecution().optimizedPlan().toString()
    # the two texts of an entry, and the body of a marked one
    assert plan.count("_html_unescape(") == 3


def test_hn_tables_of_first_deliveries(items, tmp_path):
    """Posts that come once are not compared with others; all rows are as if every item were."""
    values = [
        {"objectID": 1, "_tags": ["Story", "story", " story", "STORY", "Author_a", "author_a", None, " ", 7], "parent_id": 9, "story_id": "9"},
        {"objectID": "2", "_tags": ["a", "A"], "parent_id": True, "created_at_i": 1779264000},
        {"objectID": 2, "_tags": ["b", "a"], "parent_id": 4, "story_id": "x"},
        {"objectID": 3, "_tags": [f"t{i % 90}" for i in range(200)], "story_id": 0}, {"objectID": 4, "_tags": "story"},
        {"objectID": 5}, {"_tags": ["story"], "parent_id": 1}, {"objectID": 2, "_tags": ["c"]}]
    flat = silver_hn.flatten(items(values)).localCheckpoint()
    for rows in (flat, flat.where(F.col("source_post_id").isin("1", "4", "5"))):
        tables = silver_hn.silver_tables(rows, silver_hn.first_deliveries(rows), *RUN)
        plain = {"posts": silver_hn.posts, "post_tags": silver_hn.post_tags, "post_relations": silver_hn.post_relations}
        for name, of in plain.items():
            expected = of(rows, *RUN).collect()
            assert expected and by(tables[name].collect(), *SILVER[name].names) == by(expected, *SILVER[name].names)
    # The second time no post came again: nothing is sorted to compare tags.
    assert "row_number" not in tables["post_tags"].drop("post_id")._jdf.queryExecution().optimizedPlan().toString().split(
        "Rebalance")[0]


def test_hn_fields_read_as_text_keep_their_kind(spark, items):
    from feedmetrics.functions import casts

    values = [{"objectID": value, "title": value} for value in (
        0, "0", -0.0, 0.0, "0.0", "-0", False, "false", True, "true", None, "", [], "[]", {}, "{}", {"a": 1}, [0], 7, 0.5,
        "007", -0.25, 1e300, "x", 10**30)]
    rows = items(values)
    plain = rows.select(F.nullif(casts.truthy_text(F.col("item"), "$.objectID"), F.lit("")).alias("id"),
                        casts.text_of(F.col("item"), "$.title").alias("title"))
    flat = silver_hn.flatten(rows).select(F.col("source_post_id").alias("id"), F.col("title_html").alias("title"))
    assert by(flat.collect(), "id", "title") == by(plain.collect(), "id", "title")


def test_usual_references_stay_out_of_python(spark):
    import html

    from feedmetrics.functions.text import clean_html, strip, unescape

    usual = ["a &amp; b", "&lt;p&gt;", "&amp;lt;", "&&amp;amp;", "I&#x27;m &quot;x&quot;&nbsp;", "&amp;amp;#39;", "", None]
    strange = ["&am&lt;p;", "&amp", "&lt", "&notit;", "&#39", "&#X27;", "&copy;", "a & b", "&a&quot;mp;", "&&lt;t;"]
    rows = spark.createDataFrame([(text,) for text in usual + strange], "text string")
    for text, plain in rows.select("text", unescape(F.col("text"))).collect():
        assert plain == (None if text is None else html.unescape(text)), text
    spaces = spark.createDataFrame([(f"{a}x{b}y{a}",) for a in ("", " ", " ", "\t　", "\x1f") for b in ("", " \n", " ")],
                                   "text string")
    for text, stripped, cleaned in spaces.select("text", strip(F.col("text")), clean_html(F.col("text"))).collect():
        assert stripped == text.strip() and cleaned == " ".join(text.split()), repr(text)


def test_x_tables_of_posts_that_come_once(spark, items):
    """Only ids meet to find posts that come again; all rows are as if every post were compared with all others."""
    values = [
        {"id": 1, "hashtags": ["JAZZ", "#Opera", "jazz", "# Opera ", "##x", "#", " "], "created_at": "2025-11-30T23:30:00-01:00",
         "referenced_tweets": [{"type": " Quoted ", "id": "a|b"}, {"type": "quoted", "id": "a|b"}, {"type": "liked", "id": 1}]},
        {"id": 2, "hashtags": ["a", {"tag": " ", "text": "B"}], "text": "first", "referenced_tweets": [{"type": "quoted", "id": 5}]},
        {"id": "2", "hashtags": ["b", "c"], "text": "second", "referenced_tweets": [{"type": "quoted", "tweet_id": "5"}, {"type": "retweeted", "id": 5}]},
        {"id": 3, "hashtags": ["R&amp;B", "# &amp;amp;", "r&b", {"tag": None, "text": "x&y"}]}, {"id": 4, "hashtags": "JAZZ"},
        {"id": 5, "entities": {"hashtags": [None, 5, {"tag": 1, "text": "#T"}]}, "referenced_tweets": [{"type": "quoted"}, 5]},
        {"hashtags": ["lost"]}, {"id": None}, {"id": 6, "hashtags": [f"t{i % 90}" for i in range(300)]}, {"id": 7}]
    flat = x_flat(items, values).localCheckpoint()
    plain = {"posts": silver_x.posts, "post_tags": silver_x.post_tags, "post_relations": silver_x.post_relations, "users": silver_x.users}
    for rows in (silver_x.marked(flat, silver_x.delivered_again(flat)), flat.where("source_post_id IN ('1', '4', '5', '6')")):
        tables = silver_x.silver_tables(rows, *RUN)
        for name, of in plain.items():
            expected = of(rows, *RUN).collect()
            assert by(tables[name].collect(), *SILVER[name].names) == by(expected, *SILVER[name].names), name
    # The second time no post came again: posts, tags and references are dealt by day, and meet no others.
    for name in silver_x.DEALT:
        plan = tables[name].drop("post_id")._jdf.queryExecution().optimizedPlan().toString()
        assert "row_number" not in plan and plan.count("RebalancePartitions") == 1


def test_ids_are_worked_out_behind_the_shuffle_of_a_write(items):
    """An id is 36 characters that no codec packs; a key is a few."""
    tables = silver_x.silver_tables(x_flat(items, [{"id": 1, "hashtags": ["a"], "referenced_tweets": [{"type": "quoted", "id": 5}]}]), *RUN)
    for name in silver_x.DEALT:
        plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "sha1" in plan.split("RebalancePartitions")[0] and "sha1" not in plan.split("RebalancePartitions")[1], name
