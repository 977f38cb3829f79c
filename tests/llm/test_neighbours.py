"""Nearest neighbours: recall against brute force, odd vectors."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from landfall.llm import neighbours

SF = "/root/testdata/sf0.1"


def test_recall_and_scores(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = vectors.collect()
    ids = np.array([r["vec_id"] for r in rows])
    matrix = np.array([r["embedding"] for r in rows], float)
    got = neighbours.search(vectors, vectors.where("vec_id % 100 = 0")).collect()
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        scores = matrix @ matrix[ids == q][0]
        scores[ids == q] = -np.inf
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(abs(m[2] - scores[ids == m[1]][0]) < 1e-9 for m in mine)
        hits += sum(m[2] >= np.sort(scores)[-20] - 1e-9 for m in mine)
        total += 20
    assert hits >= 0.9 * total


def test_odd_vectors_take_no_part(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0])]
    rows += [(7, [None, 1.0]), (8, [float("inf"), 1.0]), (9, [1.0]), (None, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cell", "2 AS id")
    got = neighbours.search(frame, frame, k=2).collect()
    assert sorted(map(tuple, got)) == [
        (1, 1, 2, 0.5), (1, 2, 3, 0.5), (2, 1, 1, 0.5), (2, 2, 3, 0.5), (3, 1, 1, 0.5), (3, 2, 2, 0.5),
    ]
    assert neighbours.search(frame.limit(0), frame.limit(0)).count() == 0


@pytest.mark.parametrize("n", [15, 17, 20, 21, 25, 40])
def test_small_tables_give_all_there_is(spark, n):
    draw = np.random.default_rng(n)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.standard_normal((n, 8)))]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(r["query_id"] for r in neighbours.search(frame, frame).collect())
    assert got == {i: min(20, n - 1) for i in range(n)}


def test_scan_abandons_only_what_is_far():
    draw = np.random.default_rng(1)
    block, query = draw.standard_normal((3000, 65)), draw.standard_normal(65)
    exact = np.argsort(((block - query) ** 2).sum(1))[:20]
    found, _ = neighbours.adaptive_scan(block, query, 20)
    assert len(set(exact) & set(found)) >= 18 and len(found) <= 20
