"""The conversation trie against brute force over rebuilt texts."""

from __future__ import annotations

import hashlib
import random
from zlib import crc32

import pytest

from landfall.llm import prefix_trie
from landfall.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, ts in turns.items():
        h = crc32(str(c).encode()) % 9
        rebuilt[c] = turns.get(c - c % 5, [])[:h] + ts[h:]
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(found), len(node), parent, len(found), len(children.get(node, [])), leaves[node], saved[node], digest))
    return sorted(out, key=str)


def rows(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=str)


def test_query_agrees_with_brute_force(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert rows(QUERIES["op12_prefix_trie"](spark, SF)) == brute([tuple(r) for r in turns.collect()])


def conversations(seed=3):
    """Shared openings, copies, absent bases, empty rebuilt conversations, long ones, ties, nulls."""
    draw = random.Random(seed)
    out = []
    for c in [c for c in range(130) if c % 10 != 5]:
        n = draw.choice([1, 2, 3, 8, 12])
        for i in range(n):
            out.append((c, i, draw.choice(["user", "assistant"]) if i else "system", draw.choice(["hé", "yes", "no 中"]) if i < 4 else f"{i}"))
    out += [(200, i, "user", f"turn {i % 7}") for i in range(700)]
    out += [(202, i, "user", f"turn {i % 7}") for i in range(650)]
    out += [(301, None, None, None), (301, 0, "user", None), (301, 0, "assistant", "tie"), (301, 0, "assistant", "tie"), (None, 1, "user", "lost")]
    out += [(302, 3, None, ""), (302, None, "", "x" * 5000)]
    return out


@pytest.fixture
def scattered(spark):
    """Sorted rows are cut into many tasks, so that conversations span them."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.unset(key)


@pytest.mark.parametrize("near", [9, 32])
def test_conversations_that_span_tasks(spark, scattered, near):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in conversations()], f"{SCHEMA}, conv string, depth int")
    assert rows(prefix_trie.trie(frame.repartition(6), near=near)) == brute(conversations())


def test_colliding_fingerprints_are_taken_anew(spark):
    frame = spark.createDataFrame(conversations(5)[:200], SCHEMA)
    assert rows(prefix_trie.trie(frame, bits=(3, 64))) == brute(conversations(5)[:200])
    with pytest.raises(RuntimeError, match="fingerprints"):
        prefix_trie.trie(frame, bits=(1,))


def test_products_compose():
    maps = [prefix_trie.turn_map(hash((i, "one")), hash((i, "two"))) for i in range(5)]
    a, b, c = maps[:3]
    assert prefix_trie.then(prefix_trie.then(a, b), c) == prefix_trie.then(a, prefix_trie.then(b, c))
    assert prefix_trie.then(a, b) != prefix_trie.then(b, a)
    assert prefix_trie.then(prefix_trie.inverse(a), prefix_trie.then(a, b)) == b


def test_pieces_of_ends_join(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_PIECE", 7)
    same = [(c, 0, "user", "hello") for c in range(0, 500, 5)]
    assert rows(prefix_trie.trie(spark.createDataFrame(same, SCHEMA).repartition(4))) == brute(same)


def test_empty_table(spark):
    assert rows(prefix_trie.trie(spark.createDataFrame([], SCHEMA))) == []
