"""Packing: tokens, least squares, sequences."""

import itertools
import re
import struct
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from feedmetrics.llm import packing

tokenizers = pytest.importorskip("tokenizers")
FILE = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
WHOLE, WORDS = tokenizers.Tokenizer.from_file(FILE), packing.WordEncoder(FILE, "<u4", part=40)

LONG = packing.WordEncoder(FILE, "<u4")


def whole(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aéŁſİß'sS<|>́ \n\x1c\xa0")))))
def test_words_have_the_ids_of_the_text(texts):
    assert [np.frombuffer(ids, "<u4").tolist() for ids in WORDS(texts)] == list(map(whole, texts))


def test_added_tokens_inside_words():
    texts = ["a<|endoftext|>b", "<|startoftext|>", "<|endoftext|", "can't CAN'T it's 'sS"]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in WORDS(texts)] == list(map(whole, texts))


PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\\sa-z0-9ß-öø-ſ]+")


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("abdelmrstvéßſŸ''''  \t\n\v\f\r09!&(/:@[`{~_")))
def test_pieces_by_kinds_are_those_of_the_pattern(text):
    found = packing.marked(text.lower())
    assert re.findall("[^\x01]+", found) == PIECE.findall(text.lower()) and not re.search("[^\x01]$", found)


def test_pieces_cost_less_than_by_the_pattern():
    text = "some words, it's said, cost 12 times what others' do. " * 4000

    def least(cut):
        times = []
        for _ in range(5):
            start = time.process_time()
            cut(text)
            times.append(time.process_time() - start)
        return min(times)

    assert least(packing.marked) < 0.7 * least(lambda t: PIECE.sub("\\g<0>\x01", t))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["usual it's words " * 20, "one ", " ", "—", "<|endoftext|>", "<", "|", "e\u0301 ", " \u0301",
                                 "\u2028", "中文", "İ "])).map("".join))
def test_few_unusual_words_leave_the_others_usual(text):
    assert [np.frombuffer(ids, "<u4").tolist() for ids in LONG([text])] == [whole(text)]


def test_one_unusual_word_does_not_send_a_text_to_the_tokenizer(monkeypatch):
    seen = []
    monkeypatch.setattr(LONG, "_other", lambda text: seen.append(text) or b"")
    list(LONG(["usual words " * 1000 + "a — b " + "usual words " * 1000]))
    assert seen == [" —"]


def test_a_worker_builds_one_encoder():
    assert packing.encoder_of(FILE, "<u2") is packing.encoder_of(FILE, "<u2")


@pytest.mark.parametrize("bins, depth", [(1, 1), (6, 3), (12, 4), (5, 9)])
def test_combinations(bins, depth):
    expected = {t for d in range(1, depth + 1) for t in itertools.product(range(bins, 0, -1), repeat=d)
                if sum(t) == bins and list(t) == sorted(t, reverse=True)}
    found = packing.combinations(bins, depth)
    assert set(found) == expected and len(found) == len(expected)


def test_least_squares_is_optimal():
    random = np.random.default_rng(4)
    for _ in range(20):
        a, b = random.random((8, 12)), random.normal(size=8)
        x = packing.nonnegative_least_squares(a, b, 200)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gradient < 1e-5).all() and abs(gradient[x > 0]).max(initial=0) < 1e-5


def test_repeats_never_use_more_than_there_is():
    histogram = {1: 3, 5: 40, 11: 39, 16: 7, 8: 1}
    used = defaultdict(int)
    for way, times in packing.repeats(histogram, 16, 3):
        assert sum(way) == 16 and times > 0
        for part in way:
            used[part] += times
    assert all(used[b] <= n for b, n in histogram.items()) and used[5] >= 39 and used[16] == 7
    assert packing.repeats({}, 16, 3) == []


@pytest.mark.parametrize("window, bin_tokens", [(4096, 16), (64, 8), (16, 1)])
def test_pack(docs, texts, window, bin_tokens):
    rows = packing.pack(docs, FILE, 2, window, bin_tokens).collect()
    tokens = [(i, whole(t or "") + [2]) for i, t in texts]
    left = defaultdict(int)
    for i, ids in tokens:
        left[str(i), len(ids)] += 1
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[str(r.doc_id), r.doc_tokens].append(r)
    assert set(by_doc) == set(left)
    pieces = sum(len(p) for p in by_doc.values())
    assert pieces == len(rows)
    for i, ids in tokens:
        own = by_doc[str(i), len(ids)]
        covered = sum(r.length for r in own)
        assert covered == len(ids) * left[str(i), len(ids)]
        if left[str(i), len(ids)] == 1:
            at = 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at
                assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at:at + r.length]))
                at += r.length
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and (at & (at - 1) == 0 or window - at < 3 * bin_tokens)


def test_pack_nothing(no_docs):
    assert packing.pack(no_docs, FILE, 2).count() == 0
