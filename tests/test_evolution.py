from __future__ import annotations

import json

import events
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from landfall.functions.names import CONTEXTS, UNSTRUCT, column_name, normalize_name, normalized
from landfall.functions.schema_uri import Criterion, matches_any
from landfall.plans.columns import ClashingSchemas, SeenVersion, plan_columns
from landfall.plans.evolve import merge_versions
from landfall.plans.field_types import planned_type

TEXT, NUMBER = {"type": "string"}, {"type": "integer"}
obj = events.object_schema


def test_planned_types():
    schema = obj(
        {
            "s": TEXT,
            "n": NUMBER,
            "i": {"type": "integer", "minimum": -5, "maximum": 5},
            "big": {"type": "integer", "minimum": 0, "maximum": 2**70},
            "d": {"type": "number"},
            "cents": {"type": "number", "multipleOf": 0.01, "minimum": 0, "maximum": 9},
            "step": {"type": "number", "multipleOf": 0.05},
            "t": {"type": "string", "format": "date-time"},
            "day": {"type": "string", "format": "date"},
            "mixed": {"type": ["string", "integer"]},
            "list": {"type": "array", "items": TEXT},
            "free": {"type": "object"},
            "closed": {"type": "object", "additionalProperties": False},
        },
        ["s"],
    )
    kinds = {f.name: (f.dataType.simpleString(), f.nullable) for f in planned_type(schema)}
    assert kinds == {
        "s": ("string", False),
        "n": ("bigint", True),
        "i": ("int", True),
        "big": ("decimal(38,0)", True),
        "d": ("double", True),
        "cents": ("decimal(9,2)", True),
        "step": ("double", True),
        "t": ("timestamp", True),
        "day": ("date", True),
        "mixed": ("variant", True),
        "list": ("array<string>", True),
        "free": ("variant", True),
    }


def test_merge_unites_fields_and_loosens_required():
    merged = merge_versions(
        {(0, 0): obj({"a": TEXT}, ["a"]), (0, 1): obj({"a": TEXT, "b": TEXT}, ["a", "b"])}
    )
    assert merged.recovered == {}
    assert [(f.name, f.nullable) for f in merged.merged] == [("a", False), ("b", True)]


def test_merge_goes_into_nested_types():
    older = obj({"o": {"type": "object", "properties": {"x": TEXT}}})
    newer = obj({"o": {"type": "object", "properties": {"y": NUMBER}}})
    merged = merge_versions({(0, 0): older, (0, 1): newer}).merged
    assert merged["o"].dataType.simpleString() == "struct<x:string,y:bigint>"


def test_conflicting_version_leaves_the_merge():
    texts = {
        (0, 0): obj({"a": TEXT}),
        (0, 1): obj({"a": NUMBER}),
        (0, 2): obj({"a": TEXT, "b": TEXT}),
    }
    evolution = merge_versions(texts)
    assert evolution.merged.fieldNames() == ["a", "b"]
    assert list(evolution.recovered) == [(0, 1)]


def test_empty_schemas():
    closed = json.dumps({"type": "object", "additionalProperties": False})
    opened = json.dumps({"type": "object", "additionalProperties": True})
    assert merge_versions({(0, 0): closed}).merged is None
    assert isinstance(merge_versions({(0, 0): opened}).merged, T.VariantType)
    mixed = merge_versions({(0, 0): closed, (0, 1): obj({"a": TEXT}, ["a"])}).merged
    assert mixed["a"].nullable is True


@given(st.permutations([(0, 0), (0, 1), (1, 0)]))
def test_merge_does_not_depend_on_arrival_order(order):
    texts = {(0, 0): obj({"a": TEXT}), (0, 1): obj({"a": NUMBER}), (1, 0): obj({"b": TEXT})}
    assert merge_versions({v: texts[v] for v in order}) == merge_versions(texts)


def seen(kind, vendor, name, model, *version):
    return SeenVersion(kind, vendor, name, model, *version)


SCHEMAS = {
    ("test", "broken", 1): {(0, 0): obj({"a": TEXT}), (0, 1): obj({"a": NUMBER})},
    ("test", "steady", 7): {(0, 0): obj({"a": TEXT}), (0, 1): obj({"a": TEXT, "b": TEXT})},
    ("shop", "cartItem", 2): {(0, 0): obj({"sku": TEXT})},
    ("shop", "cart_item", 2): {(1, 0): obj({"line": {"type": "object", "properties": {"sku": TEXT}}})},
    ("acme.test", "x", 3): {(0, 0): obj({"n": NUMBER})},
    ("acme", "test.x", 3): {(0, 0): obj({"n": NUMBER})},
}


def test_column_type_is_the_same_whichever_versions_a_batch_holds():
    """Else the landed files of two batches could not be read as one table."""
    newest = plan_columns([seen(UNSTRUCT, "test", "broken", 1, 0, 1)], SCHEMAS)
    both = plan_columns(
        [seen(UNSTRUCT, "test", "broken", 1, 0, v) for v in (0, 1)], SCHEMAS
    )
    assert [(c.column, c.data_type) for c in newest] == [(c.column, c.data_type) for c in both]
    assert newest[0].versions == () and newest[1].versions == ((0, 1),)
    assert newest[1].column.startswith("unstruct_event_test_broken_1_recovered_1_0_1_")


def test_versions_newer_than_seen_do_not_count():
    (column,) = plan_columns([seen(CONTEXTS, "test", "steady", 7, 0, 0)], SCHEMAS)
    assert column.output_type.simpleString() == "array<struct<_schema_version:string,a:string>>"


def test_order_of_columns():
    columns = plan_columns(
        [
            seen(CONTEXTS, "test", "steady", 7, 0, 0),
            seen(UNSTRUCT, "test", "steady", 7, 0, 1),
            seen(UNSTRUCT, "test", "broken", 1, 0, 1),
        ],
        SCHEMAS,
    )
    assert [c.kind for c in columns] == [UNSTRUCT, UNSTRUCT, UNSTRUCT, CONTEXTS]
    assert [c.recovered for c in columns] == [False, True, False, False]
    assert [c.name for c in columns] == ["broken", "broken", "steady", "steady"]


@pytest.mark.parametrize(
    "items",
    [
        [("shop", "cartItem", 2, 0, 0), ("shop", "cart_item", 2, 1, 0)],
        [("acme.test", "x", 3, 0, 0), ("acme", "test.x", 3, 0, 0)],  # alike when joined by dots
    ],
)
def test_two_owners_of_a_column_stop(items):
    first, second = ("/".join(owner) for owner in sorted(item[:2] for item in items))
    with pytest.raises(ClashingSchemas, match=f"asked for by {first} and {second}"):
        plan_columns([seen(CONTEXTS, *item) for item in items], SCHEMAS)


NAMES = ["userId", "PDFViewer", "com.acme-x", "no-fields-v2", "already_snake", "A1B", "aB.cD"]


def test_names():
    assert [normalize_name(n) for n in NAMES] == [
        "user_id",
        "pdf_viewer",
        "com_acme_x",
        "no_fields_v2",
        "already_snake",
        "a1_b",
        "a_b_c_d",
    ]
    assert column_name(CONTEXTS, "com.acme", "no-fields-v2", 1) == "contexts_com_acme_no_fields_v2_1"


def test_names_over_a_column_agree(spark):
    rows = spark.createDataFrame([(n,) for n in NAMES], "n string")
    got = {r[0]: r[1] for r in rows.select("n", normalized(rows.n)).collect()}
    assert got == {n: normalize_name(n) for n in NAMES}


@pytest.mark.parametrize(
    ("criterion", "matched"),
    [
        ("sd:v/n/jsonschema/1-0-0", {"1-0-0"}),
        ("sd:v/n/jsonschema/1-0-*", {"1-0-0", "1-0-12"}),
        ("sd:v/n/jsonschema/1-*-*", {"1-0-0", "1-0-12", "1-1-0"}),
        ("v/n/jsonschema/*-*-*", {"1-0-0", "1-0-12", "1-1-0", "2-0-0"}),
        ("sd:v.x/n/jsonschema/*-*-*", set()),
    ],
)
def test_criteria(spark, criterion, matched):
    keys = [f"v/n/jsonschema/{v}" for v in ("1-0-0", "1-0-12", "1-1-0", "2-0-0")]
    rows = spark.createDataFrame([(k,) for k in [*keys, "vax/n/jsonschema/1-0-0"]], "key string")
    kept = rows.where(matches_any([Criterion.parse(criterion)], "key")).collect()
    assert {r[0].split("/")[-1] for r in kept} == matched


@pytest.mark.parametrize("text", ["v/n/jsonschema/1-0", "v/n/1-0-0", "v/n/jsonschema/0-0-0", ""])
def test_bad_criteria_are_refused(text):
    with pytest.raises(ValueError):
        Criterion.parse(text)
