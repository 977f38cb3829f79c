"""Exact closing of batches against a plain loop."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from landfall.operators.closing import assign_batches_exact

START = datetime(2024, 7, 9, tzinfo=UTC)
SCHEMA = "id long, src string, at timestamp, weight long"


def fold(rows, limit, delay):
    """Chunk after chunk: (source, number of the batch) by id."""
    found, state = {}, {}
    places = {}
    for i, source, at, weight in rows:
        places.setdefault((source, at, i), []).append(weight or 0)
    for (source, at, i), weights in sorted(places.items(), key=lambda p: (p[0][0] or "", p[0][1] or datetime.min.replace(tzinfo=UTC), p[0][2])):
        held, since, number = state.get(source, (0, None, -1))
        late = number >= 0 and (at is not None and (since is None or at - since >= timedelta(seconds=delay)))
        if number < 0 or held >= limit or late:
            held, since, number = 0, at, number + 1
        state[source] = (held + sum(weights), since, number)
        found[i] = (source, number)
    return found


def closed(spark, rows, limit, delay, **more):
    frame = assign_batches_exact(spark.createDataFrame(rows, SCHEMA), "src", "at", "id", "weight", limit, delay, **more)
    return {r["id"]: (r["source"], r["batch_seq"]) for r in frame.collect()}


def chunks(count, seed, sources="hhhhhhhhab", spread=60_000, heaviest=50):
    rng = random.Random(seed)
    return [
        (i, rng.choice(sources), START + timedelta(milliseconds=rng.randrange(spread)), rng.randrange(heaviest))
        for i in range(count)
    ]


@pytest.mark.parametrize("pieces", [1, 2, 5, 16])
def test_hot_source_over_many_ranges(spark, pieces):
    rows = chunks(600, seed=pieces)
    assert closed(spark, rows, 100, 2.0, pieces=pieces) == fold(rows, 100, 2.0)


def test_chains_that_never_meet(spark):
    """Equal weights: from each place on, batches begin elsewhere, so the first chunk decides all."""
    rows = [(i, "s", START, 1) for i in range(203)]
    assert closed(spark, rows, 7, 1.0, pieces=9) == {i: ("s", i // 7) for i in range(203)}


def test_batches_longer_than_ranges(spark):
    rows = [(i, "s", START + timedelta(milliseconds=i), 1) for i in range(90)]
    assert closed(spark, rows, 60, 100.0, pieces=12) == {i: ("s", i // 60) for i in range(90)}
    assert set(closed(spark, rows, 10**9, 100.0, pieces=12).values()) == {("s", 0)}


def test_delay_counts_from_the_first_chunk_of_a_batch(spark):
    rows = [(i, "s", START + timedelta(milliseconds=400 * i), 1) for i in range(8)]
    assert [n for _, n in sorted(closed(spark, rows, 99, 1.0).values())] == [0, 0, 0, 1, 1, 1, 2, 2]


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, None, None), (2, None, START, 5), (3, "s", None, 9), (4, "s", START, 1), (4, "s", START, 1)]
    assert closed(spark, rows, 9, 1.0, pieces=3) == fold(rows, 9, 1.0)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", batch_seq string, `a.b` string")
    out = assign_batches_exact(frame, "src", "at", "id", "weight", 9, 1.0)
    assert out.columns == ["id", "src", "at", "weight", "a.b", "source", "batch_seq"] and out.count() == 5


def test_no_chunks_and_no_room(spark):
    assert closed(spark, [], 9, 1.0) == {}
    with pytest.raises(ValueError):
        closed(spark, [], 0, 1.0)


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 30), st.integers(0, 9)), max_size=60),
    st.integers(1, 25),
    st.integers(1, 9),
    st.integers(1, 7),
)
def test_any_chunks(spark, drawn, limit, delay, pieces):
    rows = [(i, s, START + timedelta(seconds=t), w) for i, (s, t, w) in enumerate(drawn)]
    assert closed(spark, rows, limit, float(delay), pieces=pieces) == fold(rows, limit, float(delay))
