"""Scans and sinks: bronze, silver, gold, warehouse."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from feedmetrics.functions import casts
from feedmetrics.operators.quality import check_columns, conform
from feedmetrics.plans import jobs, views
from feedmetrics.schemas import GOLD, HN, HN_ITEM_TYPES, SILVER, X
from feedmetrics.session import scratch_dir, shared_dir
from feedmetrics.sources import bronze, json_arrays, lake, pages, warehouse

DAY, INGEST, STAMP = "2026-05-20", "2026-05-21", "2026-05-21T00:00:00Z"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- bronze ------------------------------------------------------------------

def land_hn(write_json, root, by_type, **options):
    for name in HN_ITEM_TYPES:
        write_json(root / f"ingest_date={INGEST}/data_date={DAY}/{name}/part-000.json", by_type.get(name, []), **options)


@pytest.mark.parametrize("layout,options", [("document", {}), ("document", {"indent": 2}), ("indented", {"indent": 2}),
                                            ("auto", {}), ("auto", {"indent": 2})])
def test_hn_array_scan(spark, tmp_path, write_json, layout, options):
    tricky = {"n": {"m": {}, "list": [{"k": "\n  },\n"}, []]}, "text": "a\n  },\n  {"}
    by_type = {"story": [tricky, {"i": 1}, 5, "x", {}, {"i": 2}], "job": [{"i": 3}], "poll": [7]}
    land_hn(write_json, tmp_path, by_type, **options)
    rows = bronze.read_hn(spark, str(tmp_path), INGEST, DAY, layout).orderBy("seq").select("item_type", F.to_json("item").alias("j"))
    got = [(r.item_type, r.j) for r in rows.collect()]
    assert [(t, j) for t, j in got if t != "story"] == [("job", '{"i":3}'), ("poll", "7")]
    stories = [j for t, j in got if t == "story"]
    assert stories[1:] == ['{"i":1}', "5", '"x"', "{}", '{"i":2}'] and '"text":"a\\n  },\\n  {"' in stories[0]


def test_indented_scan_splits_a_file(spark, tmp_path, write_json):
    values = [{"i": i, "pad": "x" * 50, "sub": {"a": [1, {"b": 2}]}} for i in range(3000)]
    path = tmp_path / "big.json"
    write_json(path, values, indent=2)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        df = json_arrays.scan_indented(spark, [str(path)])
        assert df.rdd.getNumPartitions() > 4
        assert [r.i for r in df.orderBy("seq").select(F.try_variant_get("item", "$.i", "int").alias("i")).collect()] == list(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_hn_scan_errors(spark, tmp_path, write_json):
    with pytest.raises(FileNotFoundError):
        bronze.read_hn(spark, str(tmp_path), INGEST, DAY)
    land_hn(write_json, tmp_path, {"job": {"not": "a list"}})
    with pytest.raises(Exception, match="Expected a JSON array"):
        bronze.read_hn(spark, str(tmp_path), INGEST, DAY).collect()


@pytest.mark.parametrize("payload,expected", [
    ([{"id": 1}, {"id": 2}], [1, 2]), ({"tweets": [{"id": 1}], "data": [{"id": 9}]}, [1]),
    ({"tweets": "x", "data": [{"id": 9}]}, [9]), ({"other": []}, []), (5, [])])
def test_x_payload_forms(spark, tmp_path, write_json, payload, expected):
    write_json(tmp_path / f"ingest_date={INGEST}/dataset_name=d/tweets.json", payload)
    rows = bronze.read_x(spark, str(tmp_path), INGEST, "d").orderBy("seq")
    assert [r.id for r in rows.select(casts.int_of(F.col("item"), "$.id").alias("id")).collect()] == expected


def test_land_x_dataset(spark, tmp_path, write_json):
    source, root = tmp_path / "in", str(tmp_path / "bronze")
    write_json(source / "tweets.json", [{"id": 1}, 5, {"id": 2}])
    with pytest.raises(ValueError, match="does not exist"):
        bronze.land_x_dataset(spark, str(source), root, INGEST, "d")
    for metadata, error in (([], "No object in"), ({"record_count": 4}, "announces 4 records")):
        write_json(source / "metadata.json", metadata)
        with pytest.raises(ValueError, match=error):
            bronze.land_x_dataset(spark, str(source), root, INGEST, "d")
    with pytest.raises(ValueError, match="ingest_date"):
        bronze.land_x_dataset(spark, str(source), root, "2026-5-1", "d")
    write_json(source / "metadata.json", {"record_count": None})
    plan = bronze.land_x_dataset(spark, str(source), root, INGEST, "d", dry_run=True).collect()
    assert {(r.record_count, r.dry_run) for r in plan} == {(3, True)} and not (tmp_path / "bronze").exists()
    write_json(source / "metadata.json", {"record_count": 3})
    bronze.land_x_dataset(spark, str(source), root, INGEST, "d")
    rows = bronze.read_x(spark, root, INGEST, "d").orderBy("seq").select(F.to_json("item").alias("j")).collect()
    assert [r.j for r in rows] == ['{"id":1}', "5", '{"id":2}']
    with pytest.raises(FileNotFoundError):
        bronze.read_x(spark, root, INGEST, "other")


def hits(*ids):
    return [{"objectID": i} for i in ids]


PAGES = {
    100: [{"hits": hits("a", "b"), "nbPages": 2}, {"hits": hits("b", "c"), "nbPages": 2}, {"hits": hits("z"), "nbPages": 9}],
    200: [{"hits": hits("d")}, {"hits": []}, {"hits": hits("z")}],
    300: [{"hits": hits("e")}, None, {"hits": hits("z")}],
    400: [{"hits": "bad"}, {"hits": hits("z")}],
    500: [{"hits": hits(f"p{i}"), "nbPages": 50} for i in range(7)],
    600: [{"hits": [5, {"objectID": None}, {"objectID": None}, {"objectID": "a"}], "nbPages": 0}, {"hits": hits("z")}],
    700: [[1], {"hits": hits("z")}],
    800: [{"nbPages": 3}, {"hits": hits("z")}],
}


def test_page_collection(spark, tmp_path, write_json):
    for window, responses in PAGES.items():
        for page, response in enumerate(responses):
            if response is not None:
                write_json(tmp_path / f"window_start={window}/page={page}/response.json", response)
    (tmp_path / "window_start=900/page=0").mkdir(parents=True)
    (tmp_path / "window_start=900/page=0/response.json").write_text("not json")
    items = pages.collect_items(pages.read_pages(spark, str(tmp_path)))
    rows = items.select("window_start", casts.id_text(F.col("item"), "$.objectID").alias("id")).collect()
    assert sorted((r.window_start, r.id or "") for r in rows) == sorted(
        [(100, "a"), (100, "b"), (100, "c"), (200, "d"), (300, "e"), (600, ""), (600, "")]
        + [(500, f"p{i}") for i in range(7)])
    few = pages.collect_items(pages.read_pages(spark, str(tmp_path)), max_pages=2)
    assert few.where("window_start = 500").count() == 2
    with pytest.raises(ValueError, match="max_pages"):
        pages.usable_pages(items, 0)


def test_many_pages_of_a_window(spark):
    rows = [(1, p, json.dumps({"hits": [{"objectID": f"w{p}"}], "nbPages": 71})) for p in (*range(70), 69, 75)]
    landed = spark.createDataFrame(rows, "window_start bigint, page bigint, t string").select(
        "window_start", "page", F.parse_json("t").alias("response"))
    assert sorted(r.page for r in pages.usable_pages(landed).collect()) == sorted([*range(70), 69])
    assert pages.collect_items(landed, 65).count() == 65


def test_collect_job(spark, tmp_path, write_json):
    marks = ["story", "ask_hn", "comment", "job", "poll", "other"]
    write_json(tmp_path / "pages/window_start=1779235200/page=0/r.json",
               {"hits": [{"objectID": str(i), "_tags": ["story", m] if m == "ask_hn" else [m]} for i, m in enumerate(marks)]})
    report = jobs.collect_hn_day(spark, str(tmp_path / "pages"), str(tmp_path / "b"), DAY, INGEST)
    row = report["manifest"].first()
    assert (row.counts.asDict(), row.total_collected_count) == (dict.fromkeys(HN_ITEM_TYPES, 1), 6)
    assert (row.start_ts, row.end_ts - row.start_ts) == (1779235200, 86400)
    back = bronze.read_hn(spark, str(tmp_path / "b"), INGEST, DAY).orderBy("seq").collect()
    assert [r.item_type for r in back] == list(HN_ITEM_TYPES)


# --- silver and gold -----------------------------------------------------------

def posts(spark, rows):
    df = spark.createDataFrame(rows, "post_id string, year string, month string, day string, score bigint")
    return conform(df.withColumns({"platform": F.lit(HN), "data_date": F.lit(DAY)}), SILVER["posts"])


def test_partition_text_and_unknown(spark, tmp_path):
    root = str(tmp_path)
    report = lake.write_silver(spark, {"posts": posts(spark, [("a", "2026", "05", "20", 1), ("b", None, "", "07", None)])}, root)
    assert (report["posts"]["row_count"], report["posts"]["partitions_written"], report["posts"]["written"]) == (2, 2, True)
    rows = lake.read_silver(spark, root, "posts", HN).orderBy("post_id").collect()
    assert [(r.year, r.month, r.day) for r in rows] == [("2026", "05", "20"), ("unknown", "unknown", "07")]
    assert (tmp_path / f"posts/platform={HN}/year=2026/month=05/day=20").is_dir()


def test_write_counts_filled_cells_like_the_score(spark, tmp_path):
    df = posts(spark, [("a", "2026", "05", "20", 1), ("", None, None, None, 0)])
    from feedmetrics.operators.quality import quality_score
    written = lake.write_silver(spark, {"posts": df}, str(tmp_path))["posts"]
    assert written["non_null_cell_count"] == quality_score(df).first().non_null_cell_count


def test_overwrite_keeps_other_partitions_and_empty_writes_nothing(spark, tmp_path):
    root = str(tmp_path)
    lake.write_silver(spark, {"posts": posts(spark, [("a", "2026", "05", "20", 1), ("b", "2026", "05", "21", 1)])}, root)
    lake.write_silver(spark, {"posts": posts(spark, [("c", "2026", "05", "21", 1)])}, root)
    report = lake.write_silver(spark, {"posts": posts(spark, [])}, root)["posts"]
    assert (report["row_count"], report["written"], report["partitions_written"]) == (0, False, 0)
    assert sorted(r.post_id for r in lake.read_silver(spark, root, "posts", HN).collect()) == ["a", "c"]
    lake.write_silver(spark, {"posts": posts(spark, [("d", "2026", "05", "21", 1)])}, root, "append")
    assert sorted(r.post_id for r in lake.read_silver(spark, root, "posts", HN).collect()) == ["a", "c", "d"]
    for mode in lake.MODES:
        assert not lake.write_silver(spark, {"posts": posts(spark, [])}, root, mode)["posts"]["written"]
    assert sorted(r.post_id for r in lake.read_silver(spark, root, "posts", HN).collect()) == ["a", "c", "d"]
    lake.write_silver(spark, {"posts": posts(spark, [("e", "2026", "05", "22", 1)])}, root, "overwrite")
    assert sorted(r.post_id for r in lake.read_silver(spark, root, "posts", HN).collect()) == ["e"]
    with pytest.raises(ValueError, match="rite mode"):
        lake.write_silver(spark, {"posts": posts(spark, [])}, root, "replace")


def test_scans_prune_partitions(spark, tmp_path):
    root = str(tmp_path)
    lake.write_silver(spark, {"posts": posts(spark, [("a", "2026", "05", "20", 1), ("b", "2026", "05", "21", 1)])}, root)
    day = lake.read_silver(spark, root, "posts", HN, DAY)
    filters = plan_of(day).split("PartitionFilters: [")[1].split("]")[0]
    assert all(name in filters for name in ("platform", "year", "month", "day"))
    assert [r.post_id for r in day.collect()] == ["a"]
    assert [f.rsplit("/", 2)[1] for f in day.inputFiles()] == ["day=20"]  # no other folder is listed
    assert len(lake.read_silver(spark, root, "posts", HN).inputFiles()) == 2
    assert lake.read_silver(spark, root, "posts", X).count() == 0
    narrow = plan_of(day.select("score")).split("ReadSchema: ")[1]
    assert narrow.startswith("struct<score:bigint>")
    with pytest.raises(ValueError, match="not a day like"):
        lake.read_silver(spark, root, "posts", HN, "2026-5-20")


def test_missing_tables_read_as_empty(spark, tmp_path):
    assert lake.read_silver(spark, str(tmp_path), "users", HN, DAY).count() == 0
    rows, missing = lake.read_gold(spark, str(tmp_path), X, "hashtag_trends", DAY)
    assert missing and rows.count() == 0 and rows.columns == GOLD[X]["hashtag_trends"].names


# --- warehouse -------------------------------------------------------------------

@pytest.fixture
def database(spark, tmp_path):
    name = f"w{abs(hash(str(tmp_path))) % 10**9}"
    warehouse.create_tables(spark, name, str(tmp_path / "wh"))
    return name


def users_metric(spark, day, *totals, platform=HN):
    df = spark.createDataFrame([(day, platform, t, t, STAMP) for t in totals],
                               "date string, platform string, total_users bigint, active_users bigint, gold_processed_at_utc string")
    return conform(df, GOLD[HN]["daily_users_metric"])


def totals(spark, database, table="hn_daily_users_metric"):
    return sorted((str(r.date), r.total_users) for r in warehouse.read_table(spark, database, table).collect())


def test_replace_date(spark, database):
    name = "hn_daily_users_metric"
    warehouse.replace_date(spark, database, name, users_metric(spark, DAY, 1, 1), DAY)
    warehouse.replace_date(spark, database, name, users_metric(spark, "2026-05-19", 3), "2026-05-19")
    assert totals(spark, database) == [("2026-05-19", 3), (DAY, 1), (DAY, 1)]
    warehouse.check_day_count(spark, database, name, DAY, 2)
    warehouse.replace_date(spark, database, name, users_metric(spark, DAY), DAY)
    assert totals(spark, database) == [("2026-05-19", 3)]
    with pytest.raises(ValueError, match="expected 1"):
        warehouse.check_day_count(spark, database, name, DAY, 1)
    row = warehouse.read_table(spark, database, name).first()
    assert row.date == dt.date(2026, 5, 19) and row.gold_processed_at_utc == dt.datetime(2026, 5, 21)


def test_missing_column_loads_as_null_and_contract_reports_it(spark, database):
    rows = users_metric(spark, DAY, 4).drop("active_users").withColumn("extra", F.lit(1))
    warehouse.replace_date(spark, database, "hn_daily_users_metric", rows, DAY)
    assert warehouse.read_table(spark, database, "hn_daily_users_metric").first().active_users is None
    with pytest.raises(ValueError, match=r"without \['active_users'\], with \['extra'\]"):
        check_columns("t", rows, GOLD[HN]["daily_users_metric"])
    with pytest.raises(ValueError, match="no warehouse table"):
        warehouse.table_schema("nope")


def test_load_clears_what_is_missing(spark, tmp_path, database):
    root = str(tmp_path / "gold")
    lake.write_gold(spark, {"daily_users_metric": users_metric(spark, DAY, 5).withColumns(
        {"year": F.lit("2026"), "month": F.lit("05"), "day": F.lit("20")})}, root, HN)
    old = conform(spark.createDataFrame([(DAY, HN, 9)], "date string, platform string, total_count bigint"),
                  GOLD[HN]["daily_item_counts"])
    warehouse.replace_date(spark, database, "hn_daily_item_counts", old, DAY)
    report = jobs.load_warehouse(spark, root, database, str(tmp_path / "wh"), "hacker-news", None, DAY)
    rows = {r.dataset: r for r in report.collect()}
    assert len(rows) == 7
    done, gone = rows["daily_users_metric"], rows["daily_item_counts"]
    assert (done.loaded_row_count, done.inserted_row_count, done.missing_files, done.skipped) == (1, 1, False, False)
    assert (gone.loaded_row_count, gone.inserted_row_count, gone.missing_files, gone.skipped) == (0, 0, True, True)
    assert done.partition_filter == {"platform": HN, "year": "2026", "month": "05", "day": "20"}
    assert warehouse.read_table(spark, database, "hn_daily_item_counts").count() == 0


def loads(spark, *frames):
    return [warehouse.Load("hacker-news", name.removeprefix("hn_"), name, "p", {}, df, False) for name, df in frames]


def test_a_bad_dataset_changes_no_table(spark, database):
    warehouse.replace_date(spark, database, "hn_daily_users_metric", users_metric(spark, DAY, 1), DAY)
    bad = users_metric(spark, DAY, 2).withColumn("total_count", F.raise_error(F.lit("bad row")).cast("bigint"))
    with pytest.raises(Exception, match="bad row"):
        warehouse.load_all_or_nothing(spark, database, loads(
            spark, ("hn_daily_users_metric", users_metric(spark, DAY, 7)), ("hn_daily_item_counts", bad)), DAY)
    assert totals(spark, database) == [(DAY, 1)]


def test_a_load_that_never_commits_is_not_seen(spark, database, monkeypatch):
    warehouse.replace_date(spark, database, "hn_daily_users_metric", users_metric(spark, DAY, 1), DAY)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "commit", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            warehouse.load_all_or_nothing(spark, database, loads(
                spark, ("hn_daily_users_metric", users_metric(spark, DAY, 7)),
                ("hn_daily_item_counts", users_metric(spark, DAY))), DAY)
    assert totals(spark, database) == [(DAY, 1)]
    warehouse.replace_date(spark, database, "hn_daily_users_metric", users_metric(spark, DAY, 8, 9), DAY)
    assert warehouse.drop_superseded(spark, database) == 1  # the lost load may be one that runs
    assert totals(spark, database) == [(DAY, 8), (DAY, 9)]
    versions = spark.sql(f"SHOW PARTITIONS {database}.hn_daily_users_metric_versions").collect()
    ids = {v.partition.split("/")[0].split("=")[1] for v in versions}
    assert warehouse.drop_superseded(spark, database, lost=ids - {spark.table(f"{database}.load_log").orderBy(F.desc("seq")).first().load_id}) == 1
    assert totals(spark, database) == [(DAY, 8), (DAY, 9)]


def test_a_later_commit_wins_in_all_tables(spark, database):
    for load_id, total in (("b", 1), ("a", 2)):
        for table in ("hn_daily_users_metric", "x_daily_users_metric"):
            rows = users_metric(spark, DAY, total).withColumn("platform", F.lit(HN if table.startswith("hn") else X))
            warehouse.write_version(spark, database, load_id, table, rows, DAY)
        warehouse.commit(spark, database, load_id, {"hn_daily_users_metric": 1, "x_daily_users_metric": 1}, DAY)
    assert totals(spark, database) == totals(spark, database, "x_daily_users_metric") == [(DAY, 2)]


def test_view_sql_equals_the_plans(spark, tmp_path, database):
    """Every view, filled, by its SQL in the catalog and by its plan."""
    for table, (platform, dataset) in warehouse.WAREHOUSE.items():
        schema = GOLD[platform][dataset]
        given = {"date": DAY, "data_date": DAY, "platform": platform, "gold_processed_at_utc": STAMP, "year": "2026",
                 "month": "05", "day": "20", "table_name": "posts"}
        kinds = {"string": "t", "bigint": 5, "double": 99.5, "boolean": True}
        row = [given.get(f.name, kinds[f.dataType.simpleString()] if not f.name.endswith("_at_utc") else STAMP) for f in schema]
        row = [DAY if f.name == "ingest_date" else v for f, v in zip(schema, row)]
        warehouse.replace_date(spark, database, table, spark.createDataFrame([row], schema), DAY)
    views.register_views(spark, database)
    assert views.missing_views(spark.newSession(), database) == []
    for name, build in views.VIEWS.items():
        plan, view = build(lambda table: warehouse.read_table(spark, database, table)), spark.table(f"{database}.{name}")
        assert view.columns == plan.columns and sorted(view.collect()) == sorted(plan.collect()) and view.count() > 0


def test_views_over_empty_tables(spark, database):
    views.register_views(spark, database)
    assert views.missing_views(spark) == []
    assert {r.view_name: r.row_count for r in views.view_counts(spark).collect()} == dict.fromkeys(views.VIEWS, 0)
    with pytest.raises(ValueError, match="vw_x_top_posts"):
        views.check_views_filled(spark)


# --- jobs ----------------------------------------------------------------------------

def test_both_platforms_to_views(spark, tmp_path, write_json):
    """Two collected platforms, read as documents, up to the dashboard views."""
    root = str(tmp_path)
    land_hn(write_json, tmp_path / "hn", {
        "story": [{"objectID": str(i), "author": f"u{i}", "created_at_i": 1779264000 + i, "points": i, "_tags": ["story"]} for i in range(12)],
        "job": [{"objectID": "j", "author": "u1", "created_at_i": 1779264000, "points": 1, "_tags": ["job"]},
                {"objectID": "late", "author": "u1", "created_at_i": 0, "points": 9, "_tags": ["job"]}]})
    write_json(tmp_path / f"x/ingest_date={DAY}/dataset_name=d/tweets.json", {"data": [
        {"id": i, "text": "t", "created_at": "2020-01-01T00:00:00Z", "user": {"id": i % 3, "followers_count": i},
         "metrics": {"like_count": i}, "hashtags": ["a", f"b{i}"]} for i in range(5)]})
    profiles = spark.createDataFrame([(f"U{i}", i, 0) for i in range(12)], "username string, karma bigint, created bigint")
    hn = jobs.hn_silver(spark, f"{root}/hn", f"{root}/silver", DAY, INGEST, STAMP, profiles=profiles)
    assert {n: t["row_count"] for n, t in hn["tables"].items()} == {
        "users": 12, "posts": 14, "post_tags": 14, "post_relations": 0, "data_quality_report": 4}
    jobs.x_silver(spark, f"{root}/x", f"{root}/silver", DAY, "d", processed_at=STAMP)
    gold_hn = jobs.hn_gold(spark, f"{root}/silver", f"{root}/gold", DAY, STAMP)["tables"]
    assert gold_hn["top_job_posts"]["row_count"] == 2  # the late one was created on another day
    jobs.x_gold(spark, f"{root}/silver", f"{root}/gold", DAY, STAMP)
    jobs.load_warehouse(spark, f"{root}/gold", "both", f"{root}/wh", data_date=DAY)
    jobs.apply_views(spark, "both")
    views.check_views_filled(spark)
    assert {r.view_name: r.row_count for r in views.view_counts(spark).collect()} == {
        "vw_hn_daily_activity": 1, "vw_x_daily_activity": 1, "vw_hn_top_posts": 12, "vw_hn_top_users": 20,
        "vw_x_top_posts": 5, "vw_x_top_users": 3, "vw_x_hashtag_trends": 6, "vw_data_quality_score": 8}
    top = spark.table("vw_x_top_users").orderBy("rank").first()
    assert (top.followers_count, top.source_user_id) == (2, "2")
    jobs.hn_gold(spark, f"{root}/silver", f"{root}/gold2", DAY, STAMP, strict_created_day=True)
    assert lake.read_gold(spark, f"{root}/gold2", HN, "top_job_posts", DAY)[0].count() == 1
    assert not [p for p in (tmp_path.parent.glob("shared*/*")) if p.name.startswith(("hn-items", "x-items", "load-"))]


def test_option_checks():
    now = dt.datetime(2026, 7, 2, tzinfo=dt.timezone.utc)
    assert jobs.resolve_days(None, None, now) == ("2026-07-01", "2026-07-02")
    assert jobs.resolve_days("2026-01-01", "2026-01-03", now) == ("2026-01-01", "2026-01-03")
    assert jobs.resolve_load_request(now=now) == (["hacker-news", "x"], None, "2026-07-02")
    assert jobs.resolve_load_request("x", "hashtag_trends", "replace_date", "2026-01-01") == (
        ["x"], ["hashtag_trends"], "2026-01-01")
    for arguments in ({"platforms": "reddit"}, {"platforms": 5}, {"datasets": ["hashtag_trends"]}, {"mode": "append"},
                      {"data_date": "2026-1-1"}):
        with pytest.raises(ValueError):
            jobs.resolve_load_request(**arguments)
    with pytest.raises(ValueError, match="silver_root is required"):
        jobs.hn_gold(None, "", "gold")


def test_shared_folder_comes_from_the_session(spark):
    assert "shared" in shared_dir(spark)
    assert scratch_dir(spark, "a").startswith(shared_dir(spark)) and scratch_dir(spark, "a") != scratch_dir(spark, "a")


def test_rows_dealt_by_partition_are_written_as_they_come(spark, tmp_path):
    """They used to be shuffled again, and the settings of a write came back after it."""
    from feedmetrics.queries import feeds
    rows = feeds.x_tags(spark, "/root/testdata/sf0.001", feeds.month_text, dealt=True)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    counts = lake.write_silver(spark, {"post_tags": rows}, str(tmp_path), dealt=["post_tags"])["post_tags"]
    plain = feeds.x_tags(spark, "/root/testdata/sf0.001", feeds.month_text)
    written = lake.read_silver(spark, str(tmp_path), "post_tags", "X").select(plain.columns)
    assert written.exceptAll(plain).isEmpty() and plain.exceptAll(written).isEmpty()
    assert counts["row_count"] == plain.count() and counts["partitions_written"] == plain.select("data_date").distinct().count()
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_hn_lines_of_all_types_are_written_unsorted(spark, tmp_path, monkeypatch):
    """A task holds no rows in memory to sort them by type: it has a file open for each."""
    from pyspark.sql import DataFrameWriter

    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.json
    monkeypatch.setattr(DataFrameWriter, "json", lambda self, *a, **k: (seen.append(int(spark.conf.get(name))), write(self, *a, **k)))
    before = spark.conf.get(name)
    rows = spark.range(50).select(F.element_at(F.array(*map(F.lit, HN_ITEM_TYPES)), (F.col("id") % 5 + 1).cast("int")).alias("item_type"),
                                  F.lit(0).cast("bigint").alias("window_start"), F.lit(0).cast("bigint").alias("page"), F.col("id").alias("pos"),
                                  F.to_variant_object(F.struct("id")).alias("item"))
    bronze.write_hn_items(rows, str(tmp_path), "2026-05-21", "2026-05-20")
    assert seen == [len(HN_ITEM_TYPES) + 1] and spark.conf.get(name) == before
    read = bronze.read_hn(spark, str(tmp_path), "2026-05-21", "2026-05-20")
    assert read.groupBy("item_type").count().collect() and read.count() == 50


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """They stayed until the driver collected garbage, all tables' at once."""
    def shuffled():
        # One file of a shuffle holds all partitions of a map task; a removal is asked for, not awaited.
        files = spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
            spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles())
        return {f.getPath() for f in files if "shuffle_" in f.getName()}

    import time
    before = shuffled()
    rows = conform(spark.range(2000).select(F.sha1(F.col("id").cast("string")).alias("post_id"), F.lit(X).alias("platform"),
                                            F.lit("2026").alias("year"), F.lit("05").alias("month"),
                                            F.lpad((F.col("id") % 9 + 1).cast("string"), 2, "0").alias("day")), SILVER["posts"])
    assert lake.write_silver(spark, {"posts": rows, "post_tags": rows}, str(tmp_path))["posts"]["partitions_written"] == 9
    until = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert lake.read_silver(spark, str(tmp_path), "posts", X).count() == 2000


def test_silver_tables_are_written_one_after_the_other(spark, tmp_path, monkeypatch):
    """So the disks hold one table's shuffle at a time."""
    import threading

    running, most, write, lock = [], [], lake.write_partitioned, threading.Lock()

    def slow(*args, **kwargs):
        with lock:
            running.append(1)
            most.append(len(running))
        try:
            return write(*args, **kwargs)
        finally:
            with lock:
                running.pop()

    monkeypatch.setattr(lake, "write_partitioned", slow)
    rows = spark.createDataFrame([("a", X, "2026", "05", "20")], "post_id string, platform string, year string, month string, day string")
    lake.write_silver(spark, {name: conform(rows, SILVER[name]) for name in ("posts", "post_tags", "post_relations")}, str(tmp_path))
    assert most == [1, 1, 1]


def test_landed_orders_are_packed_in_files_of_few_rows(spark, monkeypatch):
    """As plain text they were six times the input."""
    from feedmetrics.queries import lake as lake_queries

    monkeypatch.setattr(jobs, "x_silver", lambda *args: None)
    root = lake_queries._x_silver(spark, "/root/testdata/sf0.001")
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(f"{root}/bronze").select("path", "length").collect()
    assert parts and all(row.path.endswith(".json.gz") for row in parts)
    rows = bronze.read_x(spark, f"{root}/bronze", "2024-02-01", "orders")
    assert rows.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()


def test_feeds_of_a_load_are_dealt_before_they_get_ids(spark):
    """All tables of a load went through the shuffle of their write with ids of 36 characters; the rows are the same."""
    from feedmetrics.queries import feeds

    def totals(rows):
        return rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()

    sf = "/root/testdata/sf0.001"
    dealt = {**feeds.x_silver(spark, sf, feeds.month_text, dealt=True), "hn_posts": feeds.hn_posts(spark, sf, dealt=True),
             "hn_users": feeds.hn_users(spark, sf, dealt=True)}
    plain = {**feeds.x_silver(spark, sf, feeds.month_text), "hn_posts": feeds.hn_posts(spark, sf), "hn_users": feeds.hn_users(spark, sf)}
    for name, rows in dealt.items():
        behind, before = rows._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
        assert "sha1" in behind and "sha1" not in before, name
        assert totals(rows) == totals(plain[name]), name


def test_silver_is_packed_by_the_codec_asked_for(spark, tmp_path):
    """Ids of random hexadecimal characters: snappy leaves them as they are."""
    rows = conform(spark.range(20000).select(F.sha1(F.col("id").cast("string")).alias("post_id"), F.lit(X).alias("platform"), F.lit("2026").alias("year"),
                                             F.lit("05").alias("month"), F.lit("20").alias("day")), SILVER["posts"])
    sizes = {}
    for codec in ("snappy", "zstd"):
        lake.write_silver(spark, {"posts": rows}, f"{tmp_path}/{codec}", compression=codec)
        sizes[codec] = sum(f.stat().st_size for f in (tmp_path / codec).rglob(f"*.{codec}.parquet"))
    lake.write_silver(spark, {"posts": rows}, f"{tmp_path}/default")
    assert list((tmp_path / "default").rglob("*.snappy.parquet")) and 0 < sizes["zstd"] < 0.75 * sizes["snappy"]
