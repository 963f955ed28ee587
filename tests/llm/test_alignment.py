"""Cross-tokenizer alignment against plain Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from feedmetrics.llm import alignment
from feedmetrics.llm.queries import QUERIES, tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ODD = ["a▁b", "<s>x</s> <0x41> <|endoftext|>", " lead  two\n\n three \n \n x\t", " x　y​", "\x00\x1c",
       "é ﬁ ① \U0001f468‍\U0001f469‍\U0001f467", "꟎꟏ Ᲊᲊ x", " ", "▁"]


def plain_tokens(text, a, b, decode):
    whole = b" " + text.encode()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(decode[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in b_ids]
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], []
    ends = []
    for parts in (a_bytes, b_bytes):
        at, own = 0, []
        for p in parts:
            at += len(p)
            own.append(at)
        ends.append(own)
    return list(zip(a_ids, ends[0])), list(zip(b_ids, ends[1]))


def plain_alignment(rows):
    """Rows (doc_id, text) -> sorted contract rows."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    decode = {letter: byte for byte, letter in alignment.byte_letters().items()}
    found, counts = [], Counter()
    for doc_id, text in rows:
        own_a, own_b = plain_tokens(text, a, b, decode) if text else ([], [])
        links = [(x, y) for y, e in own_b for x, f in own_a if e == f] if len(own_a) < 3000 else [
            (x, dict((e, y) for y, e in own_b)[f]) for x, f in own_a if f in {e for _, e in own_b}]
        counts.update(links)
        cuts = sorted({e for _, e in own_a} & {e for _, e in own_b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(",".join(str(x) for x, e in own_a if low < e <= cut) + "|"
                          + ",".join(str(y) for y, e in own_b if low < e <= cut))
            low = cut
        text = ";".join(groups)
        found.append((doc_id, len(own_a), len(own_b), len(cuts), links, text))
    best = {}
    for (x, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    return sorted(((i, na, nb, ng, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else "") for i, na, nb, ng, links, text in found),
                  key=repr)


@pytest.mark.parametrize("block_bytes,work", [(8 << 20, 1 << 16), (300, 7)])
def test_aligned(spark, docs, texts, block_bytes, work):
    small = [(i, t) for i, t in texts if not t or len(t) < 20_000] + [(100 + n, t) for n, t in enumerate(ODD)]
    extra = spark.createDataFrame([(100 + n, t) for n, t in enumerate(ODD)], "doc_id bigint, text string")
    given = docs.filter("text IS NULL OR length(text) < 20000").unionByName(extra, allowMissingColumns=True)
    found = alignment.aligned(given, A, B, block_bytes=block_bytes, work=work).collect()
    rows = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
             hashlib.sha256(r.groups.encode()).hexdigest() if r.n_groups else r.groups) for r in found]
    assert sorted(rows, key=repr) == plain_alignment(small)
    for r in found:
        ends = np.frombuffer(r.ends, "<u4")
        assert len(ends) == r.n_groups and (np.diff(ends.astype(int)) > 0).all()


@pytest.mark.parametrize("seed", range(20))
def test_joint_ends(seed):
    random = np.random.default_rng(seed)
    total = int(random.integers(1, 400))
    a, b = (np.append(np.flatnonzero(random.random(total - 1) < share) + 1, total) for share in random.random(2))
    for work in (1, 2, 3, 50, 1000):
        i, j = alignment.diagonals(a, b, work)
        assert (np.diff(i + j) <= work).all() and i[-1] == len(a) and j[-1] == len(b)
        x, y = alignment.joint_ends(a, b, work)
        assert a[x].tolist() == b[y].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_overlaps():
    random = np.random.default_rng(1)
    a, b = (np.append(np.flatnonzero(random.random(199) < 0.4) + 1, 200) for _ in range(2))
    own = set(zip(*[x.tolist() for x in alignment.overlaps(a, b)[:2]])) | set(
        zip(*[x.tolist() for x in alignment.overlaps(a, b)[2:]]))
    low = lambda ends, k: ends[k - 1] if k else 0
    assert own == {(x, y) for x in range(len(a)) for y in range(len(b)) if max(low(a, x), low(b, y)) < min(a[x], b[y])}


def test_empty(no_docs):
    assert alignment.aligned(no_docs, A, B).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
            if not r.text or len(r.text) < 6_000]
    found = QUERIES["op13_tokenizer_alignment"](spark, sf).collect()
    ids = {i for i, _ in rows}
    wanted = {r[0]: (*r[:5], r[7]) for r in plain_alignment(rows)}
    assert {r.doc_id: (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) for r in found
            if r.doc_id in ids} == wanted
