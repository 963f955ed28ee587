"""The prefix trie against plain Python, and the slot table against sets."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from feedmetrics.llm import prefix_trie

COLUMNS = ("conv_id bigint, turn bigint, role string, text string, hi bigint, nth string, digest string, depth string, "
           "bytes string, n_convs string, base string, h string")


def plain_trie(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, x) for _, r, x in sorted(turns)] for c, turns in own.items()}
    seqs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, children, ends = defaultdict(set), defaultdict(set), defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
            if d:
                children[seq[:d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved, found = defaultdict(int), defaultdict(int), []
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        found.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                      len(children[node]), leaves[node], saved[node], digest))
    return sorted(found, key=repr)


def rows_of(found):
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                             "ends_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, n, *["x"] * 7) for n, r in enumerate(rows)], COLUMNS).repartition(3)


def made(seed, n=60):
    """Common openings, whole copies, nulls, ties, repeated rows, and one long conversation with its copy."""
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(300), n):
        for turn in range(rng.randrange(12)):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]),
                         rng.choice(["a", "b", "", None, "längst"])))
        if rng.random() < 0.3:
            rows += [(c, 1, "user", "a")] * rng.randrange(4)
    rows += [(c, turn, "user", f"t{turn}") for c in (1000, 1001, 1004) for turn in range(150)]
    rows += [(5000 + k, turn, "system", f"t{turn}") for k in range(40) for turn in range(9)]
    rows += [(None, 1, "user", "x"), (None, None, None, None), (-7, 0, "user", "minus"), (7777, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,shard_nodes", [(1, 1 << 14), (2, 40), (3, 1)])
def test_trie(spark, seed, shard_nodes):
    rows = made(seed)
    assert rows_of(prefix_trie.conversation_trie(conversations(spark, rows), shard_nodes=shard_nodes)) == plain_trie(rows)


def test_small(spark):
    for rows in ([], [(None, 1, "user", "x")], [(8, 1, "user", "x")], [(10, 1, "user", "x"), (11, 1, "user", "x")]):
        assert rows_of(prefix_trie.conversation_trie(conversations(spark, rows))) == plain_trie(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30_000])
def test_slot_table(n):
    keys = np.unique(np.random.default_rng(n).integers(-1 << 63, 1 << 63, (2 * n, 2), dtype=np.int64), axis=0)
    np.random.default_rng(1).shuffle(keys)
    own, others = keys[:n], keys[n:]
    table = prefix_trie.SlotTable(own[:, 0], own[:, 1])
    assert sorted(table.slots(own[:, 0], own[:, 1]).tolist()) == list(range(n))
    assert (table.slots(others[:, 0], others[:, 1]) == -1).all()


def test_equal_digests_are_an_error():
    with pytest.raises(ValueError):
        prefix_trie.SlotTable(np.array([1, 1]), np.array([2, 2]))
