"""Queries against their SQL, and the pipeline against its stages in plain Python."""

import os
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_queries import compare, connect  # noqa: E402
from feedmetrics.llm import quality_fm  # noqa: E402
from feedmetrics.llm.base import staged  # noqa: E402
from feedmetrics.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file  # noqa: E402
from test_dedup import plain_components, plain_fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    assert compare(spark, duck, name, SF) is None


def test_fingerprints_of_the_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots, first = plain_components(set(prints.values())), {}
    for i in texts:
        first[roots[prints[i]]] = min(i, first.get(roots[prints[i]], i))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_dedup"](spark, SF).collect()} == {
        (i, f"{bits:016x}", first[roots[bits]]) for i, bits in prints.items()}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_has_every_document(spark, name):
    documents = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()} == documents


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "exact_dedup", "simhash_dedup", "mix_sources", "pack"]
    texts = {r.doc_id: r.text for r in docs.collect()}

    kept = stages["quality_classifier"](spark, docs, SF)
    machine = quality_fm.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    wanted = {r.doc_id for r in quality_fm.scored(docs, machine).collect() if r.predicted}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == wanted

    exact = stages["exact_dedup"](spark, docs, SF)
    last = {}
    for doc_id, text in texts.items():
        last[text] = max(doc_id, last.get(text, doc_id))
    assert exact.columns == docs.columns and {r.doc_id for r in exact.collect()} == set(last.values())

    near = stages["simhash_dedup"](spark, docs, SF)
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots, first = plain_components(set(prints.values())), {}
    for i in texts:
        first[roots[prints[i]]] = min(i, first.get(roots[prints[i]], i))
    assert near.columns == docs.columns and {r.doc_id for r in near.collect()} == set(first.values())

    mixed = stages["mix_sources"](spark, docs, SF)
    assert mixed.columns == docs.columns
    copies = Counter()
    for r in mixed.collect():
        assert texts[r.doc_id] == r.text
        copies[r.doc_id] += 1
    taken = QUERIES["op5_mix_sources"](spark, SF).collect()
    assert sorted(r.doc_id for r in taken) == sorted(texts)
    for r in taken:
        whole, part = divmod(r.taken, r.size) if r.size else (0, 0)
        assert copies[r.doc_id] - whole in ((0, 1) if part else (0,))


def test_run(spark):
    """The pieces hold every token of what the stages before keep, once for each copy, and lie as the contract says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, SF), f"test-{name}")
    whole = Tokenizer.from_file(tokenizer_file())
    copies, ids = Counter(), {}
    for r in docs.collect():
        copies[r.doc_id] += 1
        ids[r.doc_id] = np.array([*whole.encode(r.text or "", add_special_tokens=False).ids, 2], dtype="<u4")

    pieces, places = defaultdict(Counter), defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and 0 < r.length <= 4096
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        pieces[r.doc_id][r.start] += 1
        pieces[r.doc_id][r.start + r.length] -= 1
        places[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(copies)
    for doc_id, changes in pieces.items():
        steps = sorted((at, n) for at, n in changes.items() if n)
        assert steps == [(0, copies[doc_id]), (len(ids[doc_id]), -copies[doc_id])]
    for own in places.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 4096
    tokens = sum(len(ids[i]) * n for i, n in copies.items())
    padded = sum(0 if (n := sum(x for _, x in own)) & (n - 1) == 0 else 4096 - n for own in places.values())
    assert padded < 0.05 * tokens
