"""Min-max hashing against all pairs in plain Python."""

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from feedmetrics.llm import minmax


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def plain_components(rows, percent=80):
    """(doc_id, text) rows -> sorted (doc_id, n, component_id, kept)."""
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[plain_set(text)].append(doc_id)
    sets = [s for s in ids if s]
    root = {s: s for s in sets}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s

    for a, b in combinations(sets, 2):
        if 100 * len(a & b) >= percent * len(a | b):
            root[find(a)] = find(b)
    lowest = defaultdict(list)
    for s in sets:
        lowest[find(s)] += [i for i in ids[s] if i is not None]
    found = []
    for doc_id, text in rows:
        s = plain_set(text)
        component = (min(lowest[find(s)]) if lowest[find(s)] else None) if s else doc_id
        found.append((doc_id, len(s), component, doc_id == component))
    return sorted(found, key=repr)


def rows_of(found):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()), key=repr)


def test_near_duplicates(docs, texts):
    assert rows_of(minmax.near_duplicates(docs)) == plain_components(texts)


def test_chains_and_hot_buckets(spark):
    """Groups that no single member links, copies of parts, sets a bit too far from each other, one-value bands."""
    rng = random.Random(3)
    rows = []
    for group in range(4):
        words = [f"w{rng.randrange(5000)}" for _ in range(60)]
        original = words
        for step in range(25):
            words = list(words)
            words[rng.randrange(60)] = f"v{rng.randrange(5000)}"
            if step % 3 == 0:
                words[rng.randrange(60)] = f"x{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(words)))
        for step in range(40):
            stray = [f"y{rng.randrange(9)}" if rng.random() < 0.08 else w for w in original[rng.randrange(8):]]
            rows.append((len(rows), " ".join(stray[:rng.randrange(40, 61)])))
    rows += [(len(rows) + i, " ".join(["common", "words", "here"] * 3 + [f"u{i}"])) for i in range(20)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    wanted = plain_components(rows)
    assert 50 < len({r[2] for r in wanted}) < len(rows) - 40
    assert rows_of(minmax.near_duplicates(docs)) == wanted
    # Bands of one value put nearly all into the same buckets.
    assert rows_of(minmax.near_duplicates(docs, bands=16, rows=1)) == wanted


@pytest.mark.parametrize("percent", [50, 80, 95])
def test_remaining_misses_no_link(spark, percent):
    rng = random.Random(percent)
    sets = []
    for node in range(150):
        base = range(30 * (node % 3), 30 * (node % 3) + 30)
        own = {x for x in base if rng.random() < 0.95} | {1000 + rng.randrange(40) for _ in range(rng.randrange(6))}
        sets.append((node, sorted(own), node % 5 if node % 4 else 1000 + node))
    found = minmax._remaining(spark.createDataFrame(sets, "node bigint, members array<bigint>, root bigint"), percent)
    pairs = {(r.a, r.b) for r in found.collect()}
    links = {(a, b) for (a, x, p), (b, y, q) in combinations(sets, 2)
             if p != q and 100 * len(set(x) & set(y)) >= percent * len(set(x) | set(y))}
    assert links and links <= pairs


def test_signatures_estimate_similarity():
    random_ = np.random.default_rng(5)
    whole = random_.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for shared in (400, 1600, 2800):
        a, b = np.unique(whole[:(4000 + shared) // 2]), np.unique(whole[(4000 - shared) // 2:])
        found = minmax.MinMax(40, 5, 1).signatures([a, b])
        assert abs((found[0] == found[1]).mean() - shared / 4000) < 0.1
        assert found.shape[1] == 200


def test_text_ids_and_repeated_rows(spark):
    rows = [("b", "one two three"), ("a", "ONE two Three"), ("a", "ONE two Three"), ("c", "x"), ("c", "y"), ("d", " ")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert rows_of(minmax.near_duplicates(docs)) == plain_components(rows)


def test_empty(no_docs):
    assert minmax.near_duplicates(no_docs).count() == 0
