"""Benchmark passages against brute force over all windows."""

from __future__ import annotations

import hashlib
import re

import pytest

from landfall.llm import decontaminate
from landfall.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORDS.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    found = {}
    for item, text in items:
        ws = words(text)
        size = min(window, len(ws))
        for i in range(len(ws) - size + 1 if size else 0):
            found.setdefault((size, tuple(ws[i : i + size])), set()).add(item)
    sizes = {size for size, _ in found}
    out = []
    for doc, text in docs:
        ws, hit, held = words(text), set(), set()
        for size in sizes:
            for i in range(len(ws) - size + 1):
                if (size, tuple(ws[i : i + size])) in found:
                    hit |= set(range(i, i + size))
                    held |= found[size, tuple(ws[i : i + size])]
        names = sorted(str(i) for i in held if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(ws), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def rows(frame):
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in frame.select(*names).collect()), key=str)


def test_query_agrees_with_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert rows(QUERIES["op13_decontamination"](spark, SF)) == want
    assert any(r[5] for r in want)


ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog while SEVEN wizards"),
    (2, "word3 word4 word5"),
    (3, "dog, while; seven"),
    (4, None),
    (5, " .. "),
    (6, "word3 word4 word5"),
    (6, "word3 word4 word5"),
    (7, "naïve straße 中文"),
    (10, "a a a a a a a a a a a a"),
    (None, "one two three"),
]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(*r, "clash") for r in ITEMS], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("block_chars", [40, 4_000_000])
@pytest.mark.parametrize("shard_words", [5, 1_000_000])
def test_edge_rows_in_blocks_and_shards(edge, edge_rows, items, monkeypatch, block_chars, shard_words):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block_chars)
    docs = [(r[0], r[1]) for r in edge_rows]
    assert rows(decontaminate.contamination(edge, items, shard_words=shard_words)) == brute(docs, ITEMS)


def test_matches_do_not_cross_documents(spark, items):
    docs = [(1, "word3 word4"), (2, "word5 the quick brown"), (3, "a " * 9), (4, "a " * 10), (5, "x " + "A " * 500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert rows(decontaminate.contamination(frame, items)) == brute(docs, ITEMS)


def test_removal_keeps_clean_rows_and_columns(edge, edge_rows, items):
    left = decontaminate.without_contaminated(edge, items)
    assert left.schema == edge.schema
    hit = {r[0] for r in brute([(r[0], r[1]) for r in edge_rows], ITEMS) if r[5]}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in edge_rows if r[0] not in hit)


def test_longest_matches_and_their_places(spark, items):
    docs = [(1, "so the quick brown fox sat"), (2, "quick brown fox jumps over the moon"), (3, "")]
    found = decontaminate.longest_matches(spark.createDataFrame(docs, "doc_id long, text string").repartition(2), items)
    got = {(r["item_id"], r["item_start"]): (r["length"], r["doc_id"], r["doc_start"]) for r in found.collect()}
    assert got["1", 0] == (4, 1, 1)
    assert got["1", 1] == (5 + 1, 2, 0)
    assert ("2", 0) not in got


def test_empty_tables(edge, empty, items, spark):
    assert rows(decontaminate.contamination(empty, items)) == []
    none = spark.createDataFrame([], items.schema)
    assert not any(r[5] for r in rows(decontaminate.contamination(edge, none)))
