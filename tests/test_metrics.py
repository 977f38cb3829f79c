from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest

from landfall.operators import metrics

NOON = datetime(2024, 1, 1, 12, tzinfo=UTC)


def at(seconds: float) -> datetime:
    return NOON + timedelta(seconds=seconds)


@pytest.fixture
def logs(spark):
    batches = spark.createDataFrame(
        [
            (at(1), 4, 0, at(1) - timedelta(milliseconds=3450)),
            (at(2), 1, 2, at(0)),
            (at(61), 0, 6, None),
        ],
        "loaded_at timestamp, good long, bad long, earliest timestamp",
    )
    received = spark.createDataFrame(
        [(at(0), at(3)), (at(0), at(1)), (at(200), at(190))],
        "ingested_at timestamp, processed_at timestamp",
    )
    attempts = spark.createDataFrame(
        [
            (at(5), 0, ["ServerError"]),
            (at(6), 1, ["LoadFailed", "Unauthenticated"]),
            (at(7), 2, ["Timeout"]),
            (at(8), 3, []),
            (at(9), 0, None),
        ],
        "attempted_at timestamp, attempt int, error_chain array<string>",
    )
    return batches, received, attempts


def test_latency(logs):
    batches, received, _ = logs
    assert metrics.e2e_latency(batches).first()[0] == 3450
    assert metrics.stream_latency(received).first()[0] == 3000
    assert metrics.stream_latency(received.limit(0)).first()[0] == 0
    assert metrics.e2e_latency(batches.where("good = 0")).first()[0] is None


def test_attempt_classes(logs):
    found = {tuple(r) for r in metrics.attempt_classes(logs[2]).collect()}
    assert found == {("transient", 2), ("setup", 1)}


def test_report(logs):
    report = metrics.metrics_report(*logs)
    rows = report.selectExpr("unix_seconds(period_start) AS p", "key", "value", "type").collect()
    noon = int(NOON.timestamp())
    found = {}
    for r in rows:
        found.setdefault(r["p"] - noon, {})[r["key"]] = (r["value"], r["type"])
    assert found == {
        0: {
            "events_good": (5, "count"),
            "events_bad": (2, "count"),
            "latency_millis": (3000, "gauge"),
            "e2e_latency_millis": (3450, "gauge"),
            "load_errors": (2, "count"),
            "setup_errors": (1, "count"),
        },
        60: {"events_good": (0, "count"), "events_bad": (6, "count"), "latency_millis": (0, "gauge")},
        180: {"events_good": (0, "count"), "events_bad": (0, "count"), "latency_millis": (0, "gauge")},
    }


def test_idle_periods_report_zeros(logs):
    batches, received, attempts = logs
    late = batches.selectExpr("loaded_at + INTERVAL 4 MINUTES AS loaded_at", "good", "bad", "earliest").where("good = 4")
    report = metrics.metrics_report(batches.union(late), received.limit(0), attempts.limit(0), idle=True)
    rows = report.selectExpr("unix_seconds(period_start) AS p", "key", "value").collect()
    noon = int(NOON.timestamp())
    good = {r["p"] - noon: r["value"] for r in rows if r["key"] == "events_good"}
    assert good == {0: 5, 60: 0, 120: 0, 180: 0, 240: 4}
    assert {r["key"] for r in rows if r["p"] == noon + 120} == {"events_good", "events_bad", "latency_millis"}
    none = metrics.metrics_report(*[log.limit(0) for log in logs], idle=True)
    assert none.count() == 0
