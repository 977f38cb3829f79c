from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import events
from pyspark.sql import functions as F

from landfall.operators.batching import assign_batches, combine_batches, earliest_parsed
from landfall.operators.parse import parse_lines

START = datetime(2024, 1, 1, tzinfo=UTC)


def chunks(spark, count=400, hot=0.9, seed=5):
    """One source holds most rows, many of them at the same instant."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        source = "hot" if rng.random() < hot else rng.choice("abc")
        at = START + timedelta(milliseconds=rng.choice([0, 0, 0, rng.randrange(3000)]))
        rows.append((i, source, at, rng.randrange(1, 50)))
    schema = "id long, src string, at timestamp, weight long"
    return spark.createDataFrame(rows, schema), rows


def brute_force(rows, max_bytes, delay):
    expected, running = {}, {}
    for i, source, at, weight in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        bucket = int((at - datetime(1970, 1, 1, tzinfo=UTC)).total_seconds() * 1000) // int(delay * 1000)
        before = running.get((source, bucket), 0)
        expected[i] = (source, bucket, before // max_bytes)
        running[source, bucket] = before + weight
    return expected


def assigned(frame, **limits) -> dict:
    out = assign_batches(frame, "src", "at", "id", "weight", 100, 1.0, **limits)
    return {r["id"]: (r["source"], r["delay_bucket"], r["batch_seq"]) for r in out.collect()}


def test_batches_close_by_size_and_delay(spark):
    frame, rows = chunks(spark)
    assert assigned(frame) == brute_force(rows, 100, 1.0)


def test_hot_source_is_split_and_gives_the_same_batches(spark):
    frame, rows = chunks(spark)
    expected = brute_force(rows, 100, 1.0)
    for pieces in (None, 2, 7):
        assert assigned(frame, pieces=pieces) == expected


def test_no_chunks(spark):
    frame, _ = chunks(spark, count=0)
    assert assigned(frame) == {}


def parsed(spark):
    own = events.own("shop/order/jsonschema/2-0-0", {})
    two = events.listed(("test/a/jsonschema/1-0-0", {}), ("test/b/jsonschema/1-0-0", {}))
    rows = [
        (1, events.line("a", own, two, tstamp="2024-01-01 00:00:02")),
        (1, events.line("b", own, tstamp="2024-01-01 00:00:01")),
        (1, "nonsense"),
        (2, "nonsense"),
    ]
    lines = spark.createDataFrame(rows, "batch long, value string")
    return parse_lines(lines, events.layout(), keep=("batch",)), rows


def test_combine(spark):
    frame, rows = parsed(spark)
    combined = {r["batch"]: r for r in combine_batches(frame, ["batch"], "collector_tstamp").collect()}
    assert (combined[1]["parsed"], combined[1]["failed"]) == (2, 1)
    assert combined[1]["bytes"] == sum(len(v) for b, v in rows if b == 1)
    assert combined[1]["entities"] == [
        "contexts test/a/jsonschema/1-0-0",
        "contexts test/b/jsonschema/1-0-0",
        "unstruct shop/order/jsonschema/2-0-0",
    ]
    assert (combined[2]["parsed"], combined[2]["failed"], combined[2]["earliest"]) == (0, 1, None)
    assert combined[2]["entities"] == []


def test_earliest_counts_parsed_rows_only(spark):
    frame, _ = parsed(spark)
    earliest = earliest_parsed(frame, ["batch"], "collector_tstamp")
    millis = earliest.select("batch", F.unix_millis("earliest")).collect()
    assert {tuple(r) for r in millis} == {(1, 1704067201000), (2, None)}
