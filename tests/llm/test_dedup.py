"""Exact, near and substring deduplication against plain Python."""

import hashlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from feedmetrics.llm import exact_dedup, simhash, substring_dedup
from feedmetrics.llm.components import connected


def plain_groups(texts):
    groups = defaultdict(list)
    for doc_id, text in texts:
        groups[text or ""].append(doc_id)
    return groups


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("hashed", [exact_dedup.content_hash, lambda text: F.substring(F.md5(text), 1, 1)])
def test_exact_duplicates(docs, texts, keep, hashed):
    found = exact_dedup.exact_duplicates(docs, keep=keep, hashed=hashed).collect()
    groups = plain_groups(texts)
    assert len(found) == len(texts)
    kept = defaultdict(int)
    for row in found:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == row.text_sha256)
        ids = [i for i in groups[text] if i is not None]
        assert row.doc_id in groups[text] and row.group_size == len(groups[text])
        assert row.keep_id == ((max if keep == "largest" else min)(ids) if ids else None)
        assert not row.kept or row.doc_id == row.keep_id
        kept[text] += row.kept
    assert set(kept.values()) == {1}


def test_distinct_documents_keeps_whole_rows(docs, texts):
    kept = exact_dedup.distinct_documents(docs, keep="largest")
    assert kept.columns == docs.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted(plain_groups(texts))


def test_empty_tables(no_docs):
    assert exact_dedup.exact_duplicates(no_docs).count() == 0
    assert exact_dedup.distinct_documents(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_of_each(no_docs).count() == 0
    assert substring_dedup.without_repeats(no_docs).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(bits):
    root = {b: b for b in bits}

    def find(b):
        while root[b] != b:
            b = root[b]
        return b

    order = sorted(bits)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {b: find(b) for b in order}


def test_near_duplicates(docs, texts):
    own = [(i, plain_fingerprint(t)) for i, t in texts]
    roots = plain_components({b for _, b in own})
    first = {}
    for i, b in own:
        if i is not None:
            first[roots[b]] = min(i, first.get(roots[b], i))
    expected = sorted([(str(i), f"{b:016x}", str(first.get(roots[b]))) for i, b in own])
    found = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in found) == expected
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, b in own if i == first.get(roots[b])}


def test_links_are_all_pairs_within_three_bits(spark):
    import random

    rng, values = random.Random(5), set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for flips in (0, 1, 2, 3, 4, 5):
            value = base
            for bit in rng.sample(range(64), flips):
                value ^= 1 << bit
            values |= {value, base}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(v,) for v in signed], "bits bigint")
    mask = (1 << 64) - 1
    for bits in (0, 1, 2, 3):
        found = {(r.a, r.b) for r in simhash.links(frame, bits).collect()}
        assert found == {(a, b) for a in signed for b in signed
                         if a < b and ((a ^ b) & mask).bit_count() <= bits}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = connected(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)}


def plain_removal(texts, window):
    """Rows with equal id and text are one document; nulls last; rows of one id are ordered as the operator does."""
    words = {d: (d[1] or "").encode().split() for d in texts}
    seen, removed = {}, {}
    for d in sorted(words, key=lambda d: (d[0] is None, d[0] or 0, xxh(d[1]))):
        gone = [False] * len(words[d])
        for s in range(len(words[d]) - window + 1):
            key = tuple(words[d][s:s + window])
            if key in seen:
                gone[s:s + window] = [True] * window
            seen.setdefault(key, d)
        removed[d] = b" ".join(w for w, g in zip(words[d], gone) if not g).decode(), sum(gone)
    return removed


def xxh(text):
    value = xxhash.xxh64_intdigest((text or "").encode(), seed=42)
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("window, inner, heavy, bits", [(20, 8, 10_000, 27), (20, 8, 1, 20), (6, 3, 2, 8), (5, 5, 3, 19)])
def test_substring_removal(docs, texts, window, inner, heavy, bits):
    more = [(n, t) for n, t in enumerate([
        " ".join(f"w{i}" for i in range(60)), "x y " + " ".join(f"w{i}" for i in range(10, 50)) + " z",
        " ".join(f"w{i % 7}" for i in range(90)), " ".join(f"w{i}" for i in range(30, 90))], 20)]
    rows = docs.select("doc_id", "text").union(docs.sparkSession.createDataFrame(more, "doc_id bigint, text string"))
    found = substring_dedup.without_repeats(rows, window, inner, bits, heavy).collect()
    every = texts + more
    expected = plain_removal(every, window)
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in found) == sorted(
        (str(d[0]), len((d[1] or "").encode().split()), expected[d][1], expected[d][0]) for d in every)


def test_repeats_of_text_ids(spark):
    """The same documents under numbers and under texts in the same order."""
    rows = [(n, " ".join(f"w{(n % 3) * 7 + i}" for i in range(40))) for n in range(12)] + [(None, "a b")]
    by_number = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    texts = [(None if n is None else f"id-{n:03d}", t) for n, t in rows]
    by_text = substring_dedup.without_repeats(spark.createDataFrame(texts, "doc_id string, text string"))
    plain = lambda found: sorted((r.n_words, r.n_removed, r.kept_text, str(r.doc_id)[-2:].lstrip("-0") or "0")
                                 for r in found.collect())
    assert plain(by_number) == plain(by_text) and any(r[1] for r in plain(by_text))
    assert dict(by_text.dtypes)["doc_id"] == "string"
