"""The conversation trie against a plain version on edge cases, and hot conversations in blocks."""

import hashlib
import os
import random
import sys
import zlib
from collections import defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from tallygrid.llm import trie  # noqa: E402

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, x string, weight int"


def plain_nodes(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    for c in turns:
        turns[c] = [(r.decode(), t.decode()) for _, _, r, t in sorted(turns[c])]
    members = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = (abs(c) - abs(c) % 100) * (1 if c >= 0 else -1)
        seq = turns.get(base, [])[:h] + turns[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append((c, d == len(seq)))
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[k] for k in kids[path]) or 1
        saved[path] = sum(saved[k] for k in kids[path]) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    low = {path: min(c for c, _ in m) for path, m in members.items()}
    return sorted((low[p], len(p), low[p[:-1]] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(c for c, e in m if e)).encode()).hexdigest())
                  for p, m in members.items())


def found(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)


def special(seed=3):
    rng, rows = random.Random(seed), []
    for c in [*range(0, 40), *range(100, 130), 201, 205, 399, 7_000_000_123, -5, -100, -105, 300]:
        for k in range(rng.randrange(0, 9) if c % 100 else 4):
            rows.append((c, k, rng.choice(["user", "assistant"]), rng.choice(["", "hi", "🙂 é", "a longer text"])))
    rows += [(500, None, None, None), (500, None, "b", None), (500, 1, None, "t"), (500, 1, None, "s"), (500, 1, None, "s")]
    rows += [(None, 0, "user", "lost"), (None, None, None, None), (501, 3, "user", "x" * 300_000), (502, 3, "user", "x" * 300_000)]
    rows += [(c, 0, "user", "same") for c in range(1000, 1200)]
    return rows


def test_edge_cases(spark):
    assert found(trie.nodes(trie.rebuild(frame(spark, special())))) == plain_nodes(special())


def test_empty(spark):
    assert found(trie.nodes(trie.rebuild(frame(spark, special()).where("false")))) == []
    assert found(trie.nodes(trie.rebuild(frame(spark, [(None, 1, "a", "b")])))) == []


@pytest.mark.parametrize("turns", [2300])
def test_hot_conversation(spark, monkeypatch, turns):
    """One conversation holds most rows: numbered by ranges, its prefixes made of blocks."""
    rng = random.Random(1)
    rows = special() + [(c, k, "user", str(k * (c < 650) + k % 3)) for c in (600, 601, 602, 650) for k in range(turns if c != 602 else 900)]
    rng.shuffle(rows)
    monkeypatch.setattr(trie.prefixes, "__defaults__", (64,))
    monkeypatch.setattr(trie.end_lists, "__defaults__", (3,))
    assert found(trie.nodes(trie.rebuild(frame(spark, rows), hot_rows=200))) == plain_nodes(rows)
