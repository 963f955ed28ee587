"""The structural scan against Python's own JSON reader."""

import json
import random

import pytest

from feedmetrics.sources import json_scan

STRINGS = ["", "a", "}", "{", "]", '"', "\\", '\\"', "},{", '"}', "é", "line\nbreak", "[[", "x}y]z", "\\\\", "tweets"]


def made(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind < 2:
        return rng.choice(STRINGS) + rng.choice(STRINGS)
    if kind < 6:
        return rng.choice([None, True, 0, -1.5, 12345678901, "end"])
    if kind == 6:
        return [made(rng, depth + 1) for _ in range(rng.randrange(4))]
    names = rng.sample(["a", "b", "}", '"', "tweets", "data", "{", "c]"], rng.randrange(4))
    return {name: made(rng, depth + 1) for name in names}


def dumped(rng, value):
    return rng.choice([
        lambda: json.dumps(value), lambda: json.dumps(value, separators=(",", ":"), ensure_ascii=False),
        lambda: json.dumps(value, indent=2), lambda: "\n " + json.dumps(value, indent=1) + "\n\n"])()


def normal(text):
    return json.dumps(json.loads(text), sort_keys=True)


def read(scan, spark, paths, split=None):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(split or before))
    try:
        rows = scan(spark, [str(p) for p in paths]).selectExpr("path", "seq", "to_json(item) AS item").collect()
    finally:
        spark.conf.set(key, before)
    found = {p.name: [] for p in paths}
    for row in sorted(rows, key=lambda r: (r.path, r.seq.block, r.seq.piece, r.seq.pos)):
        found[row.path.rsplit("/", 1)[1]].append(normal(row.item))
    return found


@pytest.mark.parametrize("split", [None, 7, 64])
def test_arrays(spark, tmp_path, split):
    rng, wanted = random.Random(split or 0), {}
    for n in range(25):
        value = [made(rng) for _ in range(rng.choice([0, 1, 2, 12]))]
        path = tmp_path / f"a{n}.json"
        path.write_text(dumped(rng, value), encoding="utf-8")
        wanted[path] = [json.dumps(v, sort_keys=True) for v in value]
    found = read(json_scan.scan_arrays, spark, list(wanted), split)
    assert found == {p.name: items for p, items in wanted.items()}


def plain_posts(document):
    if isinstance(document, dict):
        document = next((document[k] for k in ("tweets", "data") if isinstance(document.get(k), list)), [])
    return document if isinstance(document, list) else []


@pytest.mark.parametrize("split", [None, 7, 64])
def test_payloads(spark, tmp_path, split):
    rng, wanted = random.Random(100 + (split or 0)), {}
    posts = lambda n: [made(rng) for _ in range(n)]
    objects = lambda n: [{"id": k, "text": rng.choice(STRINGS), "of": {"x": [{}, {"y": [1]}]}} for k in range(n)]
    documents = [[], {}, 5, "}", None, objects(9), {"tweets": objects(9)}, {"data": objects(9)}, {"tweets": []},
                 {"data": objects(3), "tweets": objects(4)}, {"tweets": "x", "data": objects(5)},
                 {"tweets": {"a": {"b": {}}, "c": {}}, "data": objects(5), "meta": {"d": {"tweets": [{}, {}]}}},
                 {"meta": [{"x": 1}, {"y": {}}], "tweets": [], "data": objects(2)},
                 {"a": [{}, {}, {}], "b": {"x": {}, "y": {}}, "data": [1, {}, 2, {}, {}, [{}], "s"], "z": [{}, {}]},
                 {"tweets": None, "data": None}, {"data": {"tweets": [{}]}}, [[{"a": 1}, {}], {}, {}]]
    for _ in range(15):
        documents.append({name: posts(rng.randrange(6)) if rng.random() < 0.6 else made(rng)
                          for name in rng.sample(["tweets", "data", "meta", "x}", "includes"], rng.randrange(5))})
    for n, document in enumerate(documents):
        path = tmp_path / f"p{n}.json"
        path.write_text(dumped(rng, document), encoding="utf-8")
        wanted[path] = [json.dumps(v, sort_keys=True) for v in plain_posts(document)]
    found = read(json_scan.scan_payloads, spark, list(wanted), split)
    assert found == {p.name: items for p, items in wanted.items()}


@pytest.mark.parametrize("text", ["", " ", "{", "[1,]", '[{"a":1}{"b":2}]', '[{"a":1},]', '[{"a":1}', '[{"a":1}] x',
                                  '{"tweets": [{"a":1}, {"b":2}', '{"tweets": [{"a":1} {"b":2}]}', '{"tweets"}'])
def test_malformed(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text)
    for scan in (json_scan.scan_arrays, json_scan.scan_payloads):
        with pytest.raises(Exception):
            scan(spark, [str(path)]).collect()


def test_not_an_array(spark, tmp_path):
    for n, text in enumerate(['{"a": [{}, {}]}', "5", '"[]"', "null"]):
        (tmp_path / f"{n}.json").write_text(text)
        with pytest.raises(Exception, match="Expected a JSON array"):
            json_scan.scan_arrays(spark, [str(tmp_path / f"{n}.json")]).collect()


def test_large_file_is_read_by_many_tasks(spark, tmp_path):
    """One line of 24 MB, its elements all over the splits."""
    path = tmp_path / "tweets.json"
    items = [{"id": k, "text": "}{]\\\" " * 20, "of": [{"n": k}]} for k in range(100_000)]
    path.write_text(json.dumps({"meta": {"n": 1}, "tweets": items}, separators=(",", ":")))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1m")
    try:
        found = json_scan.scan_payloads(spark, [str(path)])
        assert spark.read.text(str(path), lineSep="}").rdd.getNumPartitions() > 8
        row = found.selectExpr("count(*) n", "sum(variant_get(item, '$.id', 'bigint')) s",
                               "count(DISTINCT seq.block) blocks").first()
    finally:
        spark.conf.set(key, before)
    assert (row.n, row.s) == (100_000, sum(range(100_000))) and row.blocks > 8


def test_small_elements_share_a_run():
    """A piece is cut into runs of some KiB, not one per element, and no byte is lost or doubled."""
    text = json.dumps([{"id": k, "text": '\\"}{' * (k % 3)} for k in range(2000)]).encode() + b"}"
    runs = list(json_scan._runs_of(text, "[", 0, 0, True))
    assert b"".join(run[1] for run in runs) == text[:-1]
    assert len(runs) < 30 and max(len(run[1]) for run in runs) <= 1 << 13


def test_documents_are_written_by_many_tasks(spark, tmp_path):
    from pyspark.sql import functions as F

    from feedmetrics.queries.lake import _write_documents

    items = spark.range(0, 100, numPartitions=5).select(F.lit("a").alias("key"), F.struct("id").alias("item"))
    _write_documents(spark, items, {key: (str(tmp_path / f"{key}.json"), '{"x": [', "]}") for key in "ab"})
    assert json.loads((tmp_path / "a.json").read_text()) == {"x": [{"id": n} for n in range(100)]}
    assert json.loads((tmp_path / "b.json").read_text()) == {"x": []}
