"""Mixing and sharding."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import mixing, sharding


def plain_seats(votes, seats):
    won = Counter()
    for _ in range(seats):
        best = max(range(len(votes)), key=lambda i: (Fraction(votes[i], 2 * won[i] + 1), -i))
        won[best] += 1
    return [won[i] for i in range(len(votes))]


@pytest.mark.parametrize("votes, seats", [([5, 5, 5], 4), ([100, 1, 1, 1], 7), ([1] * 9, 4), ([7], 3), ([3, 0, 2], 5),
                                          ([53, 24, 23], 100), ([10 ** 6, 3, 3, 3, 3], 11), ([4, 9], 0)])
def test_apportion(spark, votes, seats):
    rows = spark.createDataFrame([(i, v, seats) for i, v in enumerate(votes)], "shard int, votes int, seats int")
    found = mixing.apportion(rows, [], [F.col("shard")], "votes", "seats").collect()
    assert [r.quota for r in sorted(found, key=lambda r: r.shard)] == plain_seats(votes, seats)


def plain_targets(sizes, weights, total, cap):
    target, free = {}, set(sizes)
    while free:
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= cap * sizes[s]}
        if not full:
            return target | share
        target |= {s: float(cap * sizes[s]) for s in full}
        free -= full
    return target


def test_mix(docs, texts):
    weights = mixing.cyclic_weights(docs, (5, 2, 1))
    assert [(r.source, r.weight) for r in weights.orderBy(F.col("source").isNull(), "source").collect()] == [
        ("s0", 5), ("s1", 2), ("s2", 1), (None, 5)]
    found = mixing.mix(docs, weights, shard_docs=4).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, _ in texts)
    assert sorted(r.size for r in found) == sorted(len((t or "").encode().split()) for _, t in texts)
    sizes, taken = Counter(), Counter()
    for r in found:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    by_name = sorted(sizes, key=lambda s: (s is None, s or ""))
    expected = plain_targets(sizes, dict(zip(by_name, (5, 2, 1, 5))), sum(sizes.values()), 3)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(expected[r.source])
    for source in sizes:
        assert abs(taken[source] - expected[source]) <= 16 * 8
    again = mixing.mix(docs.repartition(5), weights, shard_docs=4).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


@pytest.fixture(scope="module")
def small_sources(spark):
    """A large source, one at its cap, empty texts, and forty sources of three documents; 100 shards at shard_docs=20."""
    rows = [(i, "large", "w " * 100) for i in range(1_400)] + [(2_000 + i, "full", "w " * 5) for i in range(83)]
    rows += [(3_000 + i, "blank", " ") for i in range(390)] + [(3_500, "blank", "w " * 7)]
    rows += [(4_000 + i, f"s{i % 40:02}", "w " * 50) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    weights = [("large", 40_000), ("full", 4_000), ("blank", 4_000), *((f"s{i:02}", 20) for i in range(40))]
    return docs, spark.createDataFrame(weights, "source string, weight bigint")


def test_small_sources_reach_their_targets(small_sources):
    found = mixing.mix(*small_sources, shard_docs=20).collect()
    assert len(found) == 1_994 and all(0 <= r.taken <= 3 * r.size for r in found)
    taken, target = Counter(), {r.source: r.target for r in found}
    for r in found:
        taken[r.source] += r.taken
    assert (target["full"], target["blank"]) == (3 * 83 * 5, 3 * 7)
    assert (taken["full"], taken["blank"]) == (3 * 83 * 5, 3 * 7)
    for source in target:  # seats of 16 words are rounded alike for forty equal sources
        assert abs(taken[source] - target[source]) <= (8 * 43 if source == "large" else 8)


def test_mixed_documents(docs):
    mixed = mixing.mixed_documents(docs, mixing.cyclic_weights(docs, (5, 2, 1)))
    assert mixed.columns == docs.columns
    assert all((r.text or "").split() for r in mixed.collect())


def test_whole_documents_reach_the_targets(spark):
    """400 sources of one document each, of which weights 1, 2 and 3 take about 1/2, 1 and 3/2."""
    docs = spark.createDataFrame([(i, f"s{i:03}", "w " * 400) for i in range(400)],
                                 "doc_id bigint, source string, text string")
    weights = spark.createDataFrame([(f"s{i:03}", 1 if i < 66 else 3 if i < 132 else 2) for i in range(400)],
                                    "source string, weight bigint")
    mixed = {r.source: r.taken for r in mixing.mix(docs, weights).collect()}
    copies = Counter(r.source for r in mixing.mixed_documents(docs, weights).collect())
    for s, taken in mixed.items():
        assert taken // 400 <= copies[s] <= -(-taken // 400)
    for low, high in ((0, 66), (66, 132), (132, 400)):
        names = [f"s{i:03}" for i in range(low, high)]
        words, wanted = 400 * sum(copies[s] for s in names), sum(mixed[s] for s in names)
        assert abs(words - wanted) <= 400 * 2 * (high - low) ** 0.5


def test_empty_tables(no_docs):
    assert mixing.mix(no_docs, mixing.cyclic_weights(no_docs, (5, 2, 1))).count() == 0
    assert sharding.shard_rows(no_docs, "doc_id", ["a", "b"], 13).count() == 0


def plain_table(shards, size):
    def number(text):
        return int.from_bytes(hashlib.md5(text.encode()).digest()[:7], "big")

    orders = {s: [(number(f"{s}/offset") + k * (number(f"{s}/skip") % (size - 1) + 1)) % size for k in range(size)]
              for s in shards}
    owner = {}
    while len(owner) < size:
        for s in shards:
            free = [x for x in orders[s] if x not in owner]
            if free:
                owner[free[0]] = s
    return [shards.index(owner[i]) for i in range(size)]


def test_lookup_table():
    shards = [f"n{i}" for i in range(7)]
    table = sharding.lookup_table(shards, 101)
    assert table == plain_table(shards, 101)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.lookup_table(shards[:-1], 101)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 25
    for bad in ((shards, 100), (shards, 5), (["a", "a"], 13), ([], 13)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_shard_rows(docs, texts):
    shards = ["a", "b", "c"]
    found = sharding.shard_rows(docs, "doc_id", shards, 103).collect()
    table = sharding.lookup_table(shards, 103)
    assert len(found) == len(texts)
    by_id = defaultdict(set)
    for r in found:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % 103
        assert (r.slot, r.shard) == (slot, shards[table[slot]])
        by_id[r.doc_id].add(r.shard)
    assert all(len(s) == 1 for s in by_id.values())


def test_query_sql_at_caps_and_in_small_shards(spark, tmp_path):
    """Sources at their cap, of few words, of no words, and one dealt into several shards."""
    import duckdb

    from feedmetrics.llm.queries import ORACLE_SQL, QUERIES

    rows = [(i, " ".join(["w"] * (1 + i % 7)), "a" if i % 41 else "b") for i in range(12_000)]
    rows += [(20_000 + i, "one two", f"s{i % 90}") for i in range(300)]
    rows += [(30_000, " ".join(["long"] * 40_000), "c"), (30_001, None, None), (30_002, " ", "d"), (30_003, "x", None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op5_mix_sources"](spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    names = ", ".join(found.columns)
    wanted = duck.execute(f"SELECT {names} FROM ({ORACLE_SQL['op5_mix_sources']})").fetchall()
    number = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    assert sorted((number(r) for r in found.collect()), key=repr) == sorted(map(number, wanted), key=repr)
    taken, full = Counter(), {}
    for r in found.collect():
        taken[r.source] += r.taken
        full[r.source] = (r.target, r.source_size)
    assert any(target == 3 * size > 0 for target, size in full.values())
    for source, (target, size) in full.items():
        assert abs(taken[source] - target) <= (0 if target == 3 * size else 16 * 4)
