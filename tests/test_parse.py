from __future__ import annotations

from datetime import UTC, datetime

import events
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.layout import DEFAULT_LAYOUT, Layout
from landfall.operators.parse import failed_rows, good_rows, parse_lines
from landfall.options import LoadOptions, Processor


def failures(spark, *texts, layout=None) -> list:
    parsed = parse_lines(events.lines(spark, *texts), layout or events.layout())
    found = {r["_payload"]: r["_failure"] for r in parsed.select("_payload", "_failure").collect()}
    return [found[t] for t in texts]


def test_good_line_is_typed(spark):
    text = events.line("a", tstamp="2024-08-19 11:00:00.123987", amount="12.30")
    row = good_rows(parse_lines(events.lines(spark, text), events.layout())).select(
        "event_id", F.unix_micros("collector_tstamp").alias("t"), "etl_tstamp", "amount", "_bytes"
    ).first()
    instant = datetime(2024, 8, 19, 11, tzinfo=UTC).timestamp()
    assert row["event_id"] == "a"
    assert row["t"] == int(instant) * 1_000_000 + 123_000
    assert row["etl_tstamp"] is None
    assert str(row["amount"]) == "12.30"
    assert row["_bytes"] == len(text)


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("nonsense1", "expected 7 fields, found 1"),
        ("", "expected 7 fields, found 1"),
        ("a\t" * 7, "expected 7 fields, found 8"),
        (events.line(""), "event_id: missing required value"),
        (events.line("a", tstamp=""), "collector_tstamp: missing required value"),
        (events.line("a", tstamp="10:00:00"), "collector_tstamp: not a valid timestamp"),
        (events.line("a", tstamp="2023-13-01 00:00:00"), "collector_tstamp: not a valid timestamp"),
        (events.line("a", amount="x1"), "amount: not a valid decimal"),
        (events.line("a", unstruct="{"), "unstruct_event: not a self-describing item"),
        (events.line("a", unstruct='{"data":{"data":1}}'), "unstruct_event: not a self-describing item"),
        (events.line("a", events.own("v/n/jsonschema/1-0", {})), "unstruct_event: not a self-describing item"),
        (events.line("a", events.own("v/n/other/1-0-0", {})), "unstruct_event: not a self-describing item"),
        (events.line("a", contexts='{"data":{}}'), "contexts: not a list of items"),
        (events.line("a", derived='{"data":5}'), "derived_contexts: not a list of items"),
        (events.line("a", contexts='{"data":[{"schema":"x","data":1}]}'), "contexts: not a self-describing item"),
        (events.line("a", events.own("v/n/jsonschema/1-0-0", {})), None),
        (events.line("a", contexts=events.listed(("v/n/jsonschema/1-0-0", {"k": 1}))), None),
        (events.line("a", contexts=events.listed()), None),
        (events.line("a", tstamp="2024-08-19T11:00:00.000Z"), None),
    ],
)
def test_reasons(spark, text, reason):
    assert failures(spark, text) == [reason]


def test_repeated_json_key_fails(spark):
    unstruct = '{"data":{"schema":"sd:v/n/jsonschema/1-0-0","data":{"k":1,"k":2}}}'
    assert failures(spark, events.line("a", unstruct)) == ["unstruct_event: not a self-describing item"]


def test_items_of_all_list_fields_keep_their_order(spark):
    one = events.listed(("v/a/jsonschema/1-0-0", {}), ("v/b/jsonschema/1-0-0", {}))
    two = events.listed(("v/c/jsonschema/1-0-0", {}))
    parsed = parse_lines(events.lines(spark, events.line("x", "", one, two)), events.layout())
    schemas = parsed.select("_contexts.schema").first()[0]
    assert [s.split("/")[1] for s in schemas] == ["a", "b", "c"]


def test_layout_without_envelope(spark):
    layout = events.layout(envelope=False)
    bare = '{"schema":"sd:v/n/jsonschema/1-0-0","data":{"k":1}}'
    parsed = parse_lines(events.lines(spark, events.line("x", bare, f"[{bare}]")), layout)
    row = parsed.select("_failure", "_unstruct.schema", F.size("_contexts").alias("n")).first()
    assert tuple(row) == (None, "sd:v/n/jsonschema/1-0-0", 1)


def test_invalid_utf8_payload_is_repaired(spark):
    raw = spark.createDataFrame([(bytearray(b"bad\xff\ttext"),)], "value binary")
    failed = failed_rows(parse_lines(raw, events.layout()), Processor("p", "v")).first()
    assert failed.asDict() == {
        "processor_name": "p",
        "processor_version": "v",
        "failure": "expected 7 fields, found 2",
        "payload": "bad�\ttext",
    }


def test_keep_carries_input_columns(spark):
    rows = spark.createDataFrame([(7, "nonsense")], "offset long, value string")
    assert parse_lines(rows, events.layout(), keep=("offset",)).select("offset").first()[0] == 7


def test_default_layout():
    assert DEFAULT_LAYOUT.base_schema.fieldNames()[:2] == ["event_id", "collector_tstamp"]
    assert "contexts" not in DEFAULT_LAYOUT.base_schema.fieldNames()


def test_bad_layouts_are_refused(spark):
    with pytest.raises(ValueError, match="repeated"):
        Layout.from_ddl("a STRING, A STRING", unstruct=None, contexts=())
    with pytest.raises(ValueError, match="must exist"):
        Layout.from_ddl("collector_tstamp TIMESTAMP, unstruct_event STRING", contexts=())
    with pytest.raises(ValueError, match="event time"):
        Layout.from_ddl("a STRING", unstruct=None, contexts=())
    with pytest.raises(ValueError, match="no entity field"):
        Layout.from_ddl("collector_tstamp TIMESTAMP, x VARIANT", unstruct=None, contexts=())


def test_options_are_checked():
    assert LoadOptions("a", "b", "c", codec="ZSTD").codec == "zstd"
    for bad in ({"codec": "brotli"}, {"failed_max_bytes": 0}, {"skip_schemas": ("nonsense",)}):
        with pytest.raises(ValueError):
            LoadOptions("a", "b", "c", **bad)


def test_base_schema_keeps_required(spark):
    base = events.layout().base_schema
    assert base["event_id"].nullable is False and base["amount"].dataType == T.DecimalType(18, 2)
