from __future__ import annotations

import json

import pytest

from landfall.functions.strict_json import landed_type, read_parts, strict_error, strict_value, text_shape
from landfall.plans.field_types import planned_type


def field(schema: dict, required: bool = False) -> str:
    return json.dumps(
        {"type": "object", "properties": {"x": schema}, "required": ["x"] if required else []}
    )


def read(spark, schema_json: str, text: str, staged: bool = True) -> tuple:
    kind = planned_type(schema_json)
    rows = spark.createDataFrame([(text,)], "t string").selectExpr("t", "try_parse_json(t) AS j")
    parts = read_parts("j", kind) if staged else None
    rows = rows.selectExpr("*", f"{parts or 'NULL'} AS p")
    shape = text_shape(kind)
    raw = None if shape is None else f"from_json(t, '{shape.simpleString()}')"
    name = "p" if parts else None
    row = rows.selectExpr(
        f"{strict_value('j', kind, raw, parts=name)} AS v",
        f"{strict_error('j', kind, 'd', nullable=False, parts=name)} AS e",
    ).first()
    return (row["v"]["x"] if row["v"] is not None else None), row["e"]


INT32 = {"type": "integer", "minimum": 0, "maximum": 100000}
CENTS = {"type": "number", "multipleOf": 0.01, "minimum": 0, "maximum": 1000}
CENTS18 = {"type": "number", "multipleOf": 0.01, "minimum": 0, "maximum": 10**15}
CENTS38 = {"type": "number", "multipleOf": 0.01, "minimum": 0, "maximum": 10**30}
TIME = {"type": "string", "format": "date-time"}
DATE = {"type": "string", "format": "date"}
FITS = [
    ({"type": "string"}, '"a"', "a"),
    ({"type": "boolean"}, "true", True),
    (INT32, "12", 12),
    ({"type": "integer"}, "9007199254740993", 9007199254740993),
    ({"type": "integer", "minimum": 0, "maximum": 10**30}, str(10**25), 10**25),
    ({"type": "number"}, "1", 1.0),
    ({"type": "number"}, "1.5", 1.5),
    ({"type": "number"}, "1e3", 1000.0),
    (CENTS, "1.25", "1.25"),
    (CENTS, "7", "7.00"),
    (CENTS18, "123456789012.25", "123456789012.25"),
    (CENTS38, "123456789012345678901234567.25", "123456789012345678901234567.25"),
    (CENTS, "1e2", "100.00"),
    (DATE, '"2024-02-29"', "2024-02-29"),
    ({"type": ["string", "null"]}, "null", None),
    ({"type": "array", "items": {"type": "integer"}}, "[1, 2]", [1, 2]),
    ({"type": "array", "items": {"type": ["integer", "null"]}}, "[1, null]", [1, None]),
    ({"type": ["string", "integer"]}, '"q"', '"q"'),
    ({"type": ["string", "integer"]}, "5", "5"),
    ({"type": "object"}, '{"z": 1, "a": [true]}', '{"z":1,"a":[true]}'),
    ({"type": "array"}, '[{"b": 1, "a": 2}, "t"]', ['{"b":1,"a":2}', '"t"']),
]
MISFITS = [
    ({"type": "string"}, "1", "string"),
    ({"type": "boolean"}, '"true"', "boolean"),
    ({"type": "boolean"}, "1", "boolean"),
    (INT32, "3000000000", "integer"),
    (INT32, '"12"', "integer"),
    ({"type": "integer"}, "1.5", "long"),
    ({"type": "integer"}, "1.0", "long"),
    ({"type": "integer"}, "9223372036854775808", "long"),
    ({"type": "number"}, '"1.5"', "double"),
    (CENTS, "1.255", "decimal"),
    (CENTS, "99999999.99", "decimal"),
    (CENTS, '"1.25"', "decimal"),
    (DATE, '"2024-02-30"', "date"),
    (DATE, '"2024"', "date"),
    (TIME, '"yesterday"', "timestamp"),
    (TIME, "5", "timestamp"),
    ({"type": "array", "items": {"type": "integer"}}, '{"a":1}', "array"),
    ({"type": "object", "properties": {"y": {"type": "string"}}}, "[1]", "struct"),
]


@pytest.mark.parametrize(("schema", "text", "expected"), FITS)
@pytest.mark.parametrize("staged", [True, False])
def test_value_that_fits(spark, schema, text, expected, staged):
    value, error = read(spark, field(schema), f'{{"x":{text}}}', staged)
    assert error is None
    if isinstance(expected, str) and value is not None:
        value = str(value)
    if isinstance(expected, int) and not isinstance(expected, bool):
        value = int(value)
    assert value == expected


@pytest.mark.parametrize(("schema", "text", "expected"), MISFITS)
def test_value_that_does_not_fit(spark, schema, text, expected):
    _, error = read(spark, field(schema), f'{{"x":{text}}}')
    assert error == f"d.x: expected {expected}"


@pytest.mark.parametrize("text", ["{}", '{"x":null}'])
def test_required_and_optional(spark, text):
    assert read(spark, field({"type": "string"}, required=True), text)[1] == "d.x: missing required value"
    assert read(spark, field({"type": "string"}), text) == (None, None)


@pytest.mark.parametrize("text", ["[]", "5", '"s"', "null"])
def test_data_must_be_an_object(spark, text):
    assert read(spark, field({"type": "string"}), text)[1] == "d: expected struct"


def test_timestamp_value(spark):
    kind = planned_type(field(TIME))
    rows = spark.sql("SELECT try_parse_json('{\"x\":\"2024-01-02T03:04:05.678901+01:00\"}') AS j")
    micros = rows.selectExpr(f"unix_micros({strict_value('j', kind)}.x)").first()[0]
    assert micros == 1704161045_678_000


def test_nested_objects_and_arrays(spark):
    inner = {"type": "object", "properties": {"n": {"type": "integer"}, "raw": {}}, "required": ["n"]}
    schema = field({"type": "array", "items": inner})
    value, error = read(spark, schema, '{"x":[{"n":1,"raw":{"b":1,"a":2}},{"n":2}]}')
    assert error is None
    assert [tuple(v) for v in value] == [(1, '{"b":1,"a":2}'), (2, None)]
    assert read(spark, schema, '{"x":[{"n":1},{"n":"2"}]}')[1] == "d.x[].n: expected long"
    assert read(spark, schema, '{"x":[{"n":1},null]}')[1] == "d.x[]: missing required value"


def test_odd_keys_and_colliding_names(spark):
    schema = json.dumps(
        {
            "type": "object",
            "properties": {
                "it's": {"type": "integer"},
                "userId": {"type": "string"},
                "user_id": {"type": "string"},
            },
        }
    )
    kind = planned_type(schema)
    assert landed_type(kind).fieldNames() == ["it_s", "user_id"]
    for text, expected in (
        ('{"it\'s":4,"userId":"a"}', (4, "a")),
        ('{"it\'s":4,"user_id":"b"}', (4, "b")),
    ):
        rows = spark.createDataFrame([(text,)], "t string").selectExpr("parse_json(t) AS j")
        assert tuple(rows.selectExpr(strict_value("j", kind) + " AS v").first()["v"]) == expected
