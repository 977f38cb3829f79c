"""Shape of the physical plans: one parse per row, narrow scans, small shuffles."""

from __future__ import annotations

import re

import events

from landfall.operators import batching
from landfall.operators.entities import discover_entities
from landfall.operators.parse import good_rows, parse_lines
from landfall.operators.project import assemble, transform_events
from landfall.plans.columns import SeenVersion, plan_columns
from landfall.queries import QUERIES
from landfall.sources.landing import read_landing, write_batch

SF = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_good_rows_parse_each_line_once(spark):
    text = plan(good_rows(parse_lines(events.lines(spark, "x"), events.layout())))
    # One read of each of the three JSON fields, however often the failure is looked at.
    assert text.count("from_json(") == 3
    assert len(re.findall(r"split\(", text)) == 1


def test_unused_columns_are_not_computed(spark):
    text = plan(parse_lines(events.lines(spark, "x"), events.layout()).select("event_id"))
    assert "from_json(" not in text and "make_valid_utf8" not in text.lower()


def test_discovery_shuffles_partial_aggregates_only(spark):
    text = plan(discover_entities(parse_lines(events.lines(spark, "x"), events.layout())))
    assert text.count("Exchange") == 1 and "partial_count" in text
    assert "make_valid_utf8" not in text.lower()


def test_transform_does_not_shuffle(spark):
    schemas = {("shop", "order", 2): {(1, 3): events.SCHEMAS["shop/order/2-1-3"]}}
    columns = plan_columns([SeenVersion("unstruct", "shop", "order", 2, 1, 3)], schemas)
    parsed = parse_lines(events.lines(spark, "x"), events.layout())
    text = plan(assemble(transform_events(parsed, events.layout(), columns), events.layout(), columns))
    assert "Exchange" not in text and "Python" not in text
    assert text.count("from_json(") == 3


def test_scan_reads_only_the_columns_a_query_needs(spark, monkeypatch):
    """The plan that is checkpointed, and what is read for it."""
    seen = []
    whole = batching.cut_into_pieces
    monkeypatch.setattr(batching, "cut_into_pieces", lambda *a: seen.append(whole(*a)) or seen[-1])
    QUERIES["batch_assign"](spark, SF)
    text = plan(seen[0])
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert set(re.findall(r"(\w+):", schema)) == {"event_id", "ts", "event_type", "props"}
    assert text.split("== Initial Plan ==")[0].count("Exchange") == 1


def test_filter_on_load_date_prunes_folders(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        write_batch(spark.range(3), f"{tmp_path}/load_tstamp_date={day}/load_batch=q-0")
    days = read_landing(spark, str(tmp_path), partition_columns=True)
    one = days.where("load_tstamp_date = DATE'2024-01-02' AND id > 1")
    text = plan(one)
    assert "PartitionFilters: [isnotnull(load_tstamp_date" in text
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,1)]" in text
    assert one.count() == 1
