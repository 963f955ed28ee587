"""Quality classifier, quality rules and language-model scores."""

import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedmetrics.llm import ppm, quality_fm, rule_cascade

SF = "/root/testdata/sf0.01"
NO_LABELS = "doc_id bigint, quality int"


def fold(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def test_pairwise_identity():
    machine = quality_fm.Machine(3)
    machine.weights = np.random.default_rng(1).normal(size=quality_fm.SIZE)
    index, value = np.array([5, 9, 700, 2, 9]), np.array([0.5, 1.0, 2.0, -1.0, 0.25])
    raw, _ = machine.raw(index, value, np.array([0, 3]))
    for part, found in ((slice(0, 3), raw[0]), (slice(3, 5), raw[1])):
        i, x = index[part], value[part]
        pairs = sum(machine.factors[i[a]] @ machine.factors[i[b]] * x[a] * x[b]
                    for a in range(len(i)) for b in range(a + 1, len(i)))
        assert found == pytest.approx(machine.bias + machine.weights[i] @ x + pairs)


def test_untrained_scores_and_edge_rows(spark, docs, no_docs, texts):
    machine = quality_fm.train(docs, spark.createDataFrame([], NO_LABELS))
    found = quality_fm.scored(docs.select("doc_id", "text", "n_chars"), machine).collect()
    assert len(found) == len(texts)
    for row in found:
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
        assert row.held_out == (fold(row.doc_id, 5) == 0)
    assert quality_fm.scored(no_docs, machine).count() == 0
    assert quality_fm.accepted(docs, machine).columns == docs.columns
    assert quality_fm.accepted(no_docs, machine).count() == 0


def test_labels_with_nulls_repeats_and_strangers(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (4, 0), (4, None), (None, 1), (999, 1), (12, 0), (11, 1),
                                    (16, 0), (10, 0)], NO_LABELS)
    machine = quality_fm.train(docs, labels, rounds=1, epochs=2)
    scores = {r.doc_id: r.score for r in quality_fm.scored(docs.select("doc_id", "text", "n_chars"), machine).collect()}
    assert all(0 <= s <= 1 for s in scores.values())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    machine = quality_fm.train(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_fm.scored(docs.select("doc_id", "text", "n_chars"), machine).collect()
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert len(held) > 50 and sum(p == y for p, y in held) >= 0.95 * len(held)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i:i + 8])].append(i)
    repeated = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated))


def test_rules(docs, no_docs, texts):
    found = rule_cascade.judged(docs).collect()
    expected = []
    for doc_id, text in texts:
        counts = plain_counts(text or "")
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        kept = not failed and not any(fails(rule_cascade.Text(text)) for fails in rule_cascade.RULES.values())
        expected.append((str(doc_id), *counts, failed, kept))
    assert sorted((str(r.doc_id), *r[1:]) for r in found) == sorted(expected)
    names = list(rule_cascade.RULES)
    assert sorted(map(str, rule_cascade.judged(docs, names[::-1]).collect())) == sorted(map(str, found))
    assert rule_cascade.judged(no_docs).count() == 0


def test_rule_order_is_by_rejection_per_cost(spark, monkeypatch):
    import time

    def rule(name, seconds):
        def fails(text):
            time.sleep(seconds)
            return name in text.text

        return fails

    monkeypatch.setattr(rule_cascade, "RULES", {"never": rule("!", 0), "cheap": rule("a", 0.0005),
                                                "dear": rule("a", 0.02), "often": rule("", 0.0005)})
    docs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)] * 5, "text string")
    assert rule_cascade.rule_order(docs) == ["often", "cheap", "dear", "never"]


def test_short_circuit(monkeypatch):
    calls = []
    monkeypatch.setattr(rule_cascade, "RULES", {n: lambda t, n=n: calls.append(n) or n == "b" for n in "abc"})
    text = rule_cascade.Text("x")
    assert any(rule_cascade.RULES[n](text) for n in "abc") and calls == ["a", "b"]


@pytest.mark.parametrize("window", [1, 2, 5, 8, 11])
def test_repeated_words(window):
    for words in (b"a " * 40, b"a b c d e f g h i j k l " * 3, b"a b c a b d a b", b"", b"a"):
        own = words.split()
        places = defaultdict(list)
        for i in range(len(own) - window + 1):
            places[tuple(own[i:i + window])].append(i)
        expected = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(window)}
        assert rule_cascade.repeated_words(own, window) == len(expected)


def plain_ppm(texts, folds, order):
    """Scores by dictionaries of contexts, one byte after the other."""
    contexts, words = defaultdict(Counter), Counter()
    data = []
    for doc_id, text in texts:
        own = (text or "").encode().lower().split()
        data.append((doc_id, own, b"\n" * order + b" ".join(own) + b"\n"))
        if fold(doc_id, folds):
            words.update([*own, b"\n"])
            for p in range(order, len(data[-1][2])):
                for j in range(order + 1):
                    contexts[data[-1][2][p - j:p]][data[-1][2][p]] += 1

    def log(context, byte):
        gone, p = set(), 1.0
        for j in range(len(context), -1, -1):
            left = {b: n for b, n in contexts.get(context[len(context) - j:], {}).items() if b not in gone}
            total = sum(left.values())
            if byte in left:
                return math.log10(p * (left[byte] - 0.5) / total)
            if left:
                p *= len(left) / (2 * total)
            gone |= set(left)
        return math.log10(p / (256 - len(gone)))

    total, kinds = sum(words.values()), len(words)
    for doc_id, own, raw in data:
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in [*own, b"\n"])
        yield (str(doc_id), fold(doc_id, folds) == 0, len(own) + 1, sum(words[w] > 0 for w in [*own, b"\n"]), total,
               pytest.approx(base), pytest.approx(sum(log(raw[p - order:p], raw[p]) for p in range(order, len(raw)))))


@pytest.mark.parametrize("order, folds, block", [(4, 10, 1 << 20), (2, 3, 500), (0, 2, 2_000)])
def test_ppm(docs, texts, order, folds, block):
    short = docs.filter("doc_id IS NULL OR doc_id <> 11")
    found = sorted((str(r.doc_id), *r[1:]) for r in ppm.scored(short, order, folds, block_bytes=block).collect())
    expected = list(plain_ppm([t for t in texts if t[0] != 11], folds, order))
    key = lambda row: (row[0], row[2])
    assert len(found) == len(expected)
    for a, b in zip(sorted(found, key=key), sorted(expected, key=key)):
        assert a == b


def test_ppm_of_no_and_long_texts(docs, no_docs, spark):
    assert ppm.scored(no_docs).count() == 0
    assert ppm.scored(docs).count() == docs.count()
    untrained = ppm.scored(spark.createDataFrame([(None, "ab"), (None, None)], "doc_id bigint, text string")).collect()
    assert sorted(r.score for r in untrained) == pytest.approx([3 * math.log10(1 / 256), math.log10(1 / 256)])


def test_training_rows_are_bounded_where_an_id_repeats(spark):
    """An id with many rows and many texts trains with no more rows than asked for, equal rows once."""
    many = spark.range(3000).selectExpr("7L AS doc_id", "CAST(id % 500 AS STRING) AS text", "1 AS n_chars")
    labels = spark.createDataFrame([(7, 1), (7, 0), (7, 1)], "doc_id bigint, quality int")
    for most, expected in ((200, 200), (20_000, 500)):
        rows, count = quality_fm.training_rows(many, labels, 5, most)
        assert rows.count() == count == expected and {r.y for r in rows.collect()} == {1}
