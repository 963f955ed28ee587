import random

import pytest
from pyspark.sql import functions as F

from feedmetrics.operators.days import on_day, row_date
from feedmetrics.operators.quality import conform
from feedmetrics.operators.ranking import presentation_order, rank_by_count, top_k
from feedmetrics.plans import gold, views
from feedmetrics.schemas import HN_ITEM_TYPES as GOLD_KINDS
from feedmetrics.schemas import GOLD, HN, SILVER, X

STAMP = "2026-05-21T00:00:00Z"
DAY = "2026-05-20"


@pytest.fixture
def silver(spark):
    def build(table, rows):
        names = sorted({name for row in rows for name in row})
        kinds = {f.name: f.dataType.simpleString() for f in SILVER[table]}
        df = spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows],
                                   ", ".join(f"{n} {kinds[n]}" for n in names))
        return conform(df, SILVER[table])

    return build


def test_daily_item_counts(silver):
    """Every kind in a number of its own, over two days; other kinds do not count."""
    numbers = dict(zip((*GOLD_KINDS, "other"), (3, 5, 1, 4, 2, 6)))
    posts = [{"platform": HN, "data_date": day, "post_type": kind} for kind, n in numbers.items()
             for day in (DAY, "2026-06-01") for _ in range(n if day == DAY else 7 - n)]
    posts += [{"platform": X, "data_date": DAY, "post_type": "poll"}, {"platform": HN, "post_type": "ask"}]
    rows = {r.date: r for r in gold.daily_item_counts(silver("posts", posts), STAMP).collect()}
    assert {r.platform for r in rows.values()} == {HN} and set(rows) == {DAY, "2026-06-01"}
    for kind in GOLD_KINDS:
        assert rows[DAY][f"{kind}_count"] == numbers[kind] and rows["2026-06-01"][f"{kind}_count"] == 7 - numbers[kind]
    assert (rows[DAY].total_count, rows["2026-06-01"].total_count) == (15, 20)
    assert (rows["2026-06-01"].year, rows["2026-06-01"].month, rows["2026-06-01"].day) == ("2026", "06", "01")


def test_gold_layouts(silver):
    tables = {name: silver(name, [{"platform": HN}]) for name in SILVER}
    for platform, built in ((HN, gold.hn_gold_tables(tables, STAMP)), (X, gold.x_gold_tables(tables, STAMP))):
        assert list(built) == list(GOLD[platform])
        for name, df in built.items():
            assert sorted(df.columns) == sorted(GOLD[platform][name].names), name


def test_daily_users_metric(silver):
    users = [{"platform": HN, "data_date": DAY, "user_id": u} for u in ("a", "a", "b", "", None)]
    row = gold.daily_users_metric(silver("users", users), HN, STAMP).first()
    assert (row.total_users, row.active_users) == (2, 2)


def ranked(df, key):
    return [(row["rank"], row[key]) for row in presentation_order(df).collect()]


def test_top_stories_and_tie_break(silver):
    posts = [{"platform": HN, "data_date": DAY, "post_type": kind, "source_post_id": i, "score": score}
             for i, kind, score in (("1", "story", 10), ("2", "story", 30), ("3", "job", 100), ("10", "story", 10),
                                    (None, "story", 10), ("4", "story", None))]
    df = gold.top_posts_by_score(silver("posts", posts), "story", STAMP)
    assert ranked(df, "source_post_id") == [(1, "2"), (2, "10"), (3, "1"), (4, None)]


def test_karma_both_ways(silver):
    users = [{"platform": p, "data_date": DAY, "username": n, "karma_score": k}
             for n, k, p in (("mira", 61, HN), ("nils", None, HN), ("olga", 940, HN), ("petra", 61, HN), ("x", 500, X))]
    table = silver("users", users)
    assert ranked(gold.top_users_by_karma(table, STAMP), "username") == [(1, "olga"), (2, "petra"), (3, "mira")]
    assert ranked(gold.top_users_by_karma(table, STAMP, descending=False), "username") == [
        (1, "mira"), (2, "petra"), (3, "olga")]


def test_followers(silver):
    users = [{"platform": p, "data_date": DAY, "username": n, "followers_count": k}
             for n, k, p in (("mira", 10, X), ("nils", 50, X), ("x", 500, HN), ("none", None, X))]
    assert ranked(gold.top_users_by_followers(silver("users", users), STAMP), "username") == [(1, "nils"), (2, "mira")]


def test_engagement(silver):
    counts = {"1": (1, 2, 3, 4), "2": (20, 0, 0, 0), "3": (None,) * 4, "4": (None, 5, None, None)}
    posts = [{"platform": X, "data_date": DAY, "source_post_id": i,
              **dict(zip(("like_count", "retweet_count", "reply_count", "quote_count"), c))} for i, c in counts.items()]
    df = gold.top_posts_by_engagement(silver("posts", posts), STAMP)
    assert [(r.source_post_id, r.engagement_count, r.like_count) for r in presentation_order(df).collect()] == [
        ("2", 20, 20), ("1", 10, 1), ("4", 5, None), ("3", 0, None)]


def test_hashtags(silver):
    rows = [(X, "JAZZ", DAY, "hashtag"), (X, "jazz", DAY, None), (X, "opera", DAY, "hashtag"), (X, "jazz", "2026-05-21", None),
            (HN, "jazz", DAY, None), (X, "jazz", DAY, "hn_tag"), (X, "", DAY, None)]
    tags = [dict(zip(("platform", "tag", "data_date", "tag_type"), row)) for row in rows]
    df = gold.hashtag_trends(silver("post_tags", tags), STAMP)
    assert [(r.date, r["rank"], r.tag, r.post_count) for r in presentation_order(df).collect()] == [
        (DAY, 1, "jazz", 2), (DAY, 2, "opera", 1), ("2026-05-21", 1, "jazz", 1)]


def test_row_date_order_of_sources(silver):
    posts = [{"data_date": "a", "year": "2026", "month": "05", "day": "20"}, {"data_date": "", "year": "2026", "month": "05", "day": "20"},
             {"year": "2026", "month": "", "day": "20", "created_at_utc": "2026-01-02T03:04:05Z"}, {"created_at_utc": "2026"}]
    df = silver("posts", posts)
    assert sorted(r.d or "" for r in df.select(row_date(df).alias("d")).collect()) == ["", "2026-01-02", "2026-05-20", "a"]


def test_bad_date_has_no_parts(silver):
    row = gold.daily_users_metric(silver("users", [{"platform": HN, "data_date": "someday", "user_id": "a"}]), HN, STAMP).first()
    assert (row.date, row.year, row.month, row.day) == ("someday", None, None, None)


def test_on_day_pushes_a_plain_predicate(spark, silver, tmp_path):
    silver("posts", [{"data_date": DAY, "platform": HN}]).write.parquet(str(tmp_path / "p"))
    df = on_day(spark.read.parquet(str(tmp_path / "p")), DAY)
    assert "EqualTo(data_date,2026-05-20)" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 1


@pytest.mark.parametrize("groups,per_group,most", [(1, 5000, 20), (40, 50, 3), (3, 400, 1)])
def test_rank_by_count_equals_a_window(spark, groups, per_group, most):
    """One large group, many small ones, and counts that all tie; texts that begin alike, and one that is empty."""
    rng = random.Random(groups)
    rows = [(f"g{g}" if g else None, rng.randint(1, most), rng.choice(["t", "tag", "täglich", "😀", ""]) + (f"{i:05d}" if i else ""))
            for g in range(groups) for i in range(per_group)]
    df = spark.createDataFrame(rows, "date string, n bigint, tag string")
    ranked_rows = rank_by_count(df, ["date"], "n", "tag").collect()
    expected = {}
    for group in {row[0] for row in rows}:
        members = sorted((r for r in rows if r[0] == group), key=lambda r: (r[1], r[2].encode()), reverse=True)
        expected |= {r: i for i, r in enumerate(members, start=1)}
    assert {(r.date, r.n, r.tag): r["rank"] for r in ranked_rows} == expected


def test_rank_by_count_runs_nothing_when_built(spark, silver):
    tags = silver("post_tags", [{"platform": X, "data_date": DAY, "tag": t, "tag_type": "hashtag"} for t in "abca"])
    spark.sparkContext.setJobGroup("ranking", "ranking")
    try:
        df = gold.hashtag_trends(tags, STAMP)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ranking")
        assert [(r["rank"], r.tag) for r in df.orderBy("rank").collect()] == [(1, "a"), (2, "c"), (3, "b")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_top_k_beyond_the_group_limit_threshold(spark):
    df = spark.range(3000).select(F.lit("g").alias("date"), "id")
    rows = top_k(df, ["date"], [F.desc("id")], 1500).collect()
    assert {(r.id, r["rank"]) for r in rows} == {(2999 - i, i + 1) for i in range(1500)}


def test_top_k_limits_before_the_shuffle(spark, silver, tmp_path):
    silver("posts", [{"platform": HN}]).write.parquet(str(tmp_path / "p"))
    plan = gold.top_posts_by_score(spark.read.parquet(str(tmp_path / "p")), "story", STAMP)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_daily_activity_join_is_null_safe(spark):
    items = conform(spark.createDataFrame([("d", "p", None, "1"), ("e", "p", "2026", "1")],
                                          "date string, platform string, year string, gold_processed_at_utc string"),
                    GOLD[HN]["daily_item_counts"])
    users = conform(spark.createDataFrame([("d", "p", None, 5, "2")],
                                          "date string, platform string, year string, total_users bigint, gold_processed_at_utc string"),
                    GOLD[HN]["daily_users_metric"])
    view = views.hn_daily_activity({"hn_daily_item_counts": items, "hn_daily_users_metric": users}.__getitem__)
    assert [(r.date, r.total_users, r.gold_processed_at_utc) for r in view.orderBy("date").collect()] == [
        ("d", 5, "2"), ("e", None, "1")]
