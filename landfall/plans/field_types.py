"""JSON schema text to a planned type (see ``functions.strict_json`` for its meaning)."""

from __future__ import annotations

import json
from decimal import Decimal

from pyspark.sql import types as T

from landfall.functions.names import normalize_name
from landfall.functions.strict_json import KEYS

JSON_TEXT = T.VariantType()
_INT32 = (-(2**31), 2**31 - 1)
_INT64 = (-(2**63), 2**63 - 1)
_DECIMAL_DIGITS = (9, 18, 38)


class TypeConflict(Exception):
    """Two versions give one field types that cannot share a column."""


def planned_type(schema_json: str) -> T.DataType | None:
    """Type of a schema's data; None for a closed schema with no fields."""
    return _type_of(json.loads(schema_json))


def _type_names(schema: dict) -> tuple[list[str], bool]:
    """The non-null type names, and whether null is allowed."""
    declared = schema.get("type", [])
    names = [declared] if isinstance(declared, str) else list(declared)
    nullable = "null" in names or None in schema.get("enum", [])
    return [n for n in names if n != "null"], nullable


def _type_of(schema: dict) -> T.DataType | None:
    names, _ = _type_names(schema)
    if len(names) != 1:
        return JSON_TEXT
    readers = {
        "object": _object,
        "array": _array,
        "string": _string,
        "integer": _integer,
        "number": _number,
        "boolean": lambda _: T.BooleanType(),
    }
    return readers[names[0]](schema) if names[0] in readers else JSON_TEXT


def _object(schema: dict) -> T.DataType | None:
    required = set(schema.get("required", []))
    fields = []
    for key, inner in schema.get("properties", {}).items():
        kind = _type_of(inner)
        if kind is not None:
            nullable = key not in required or _type_names(inner)[1]
            fields.append(T.StructField(key, kind, nullable))
    if fields:
        return T.StructType(_one_per_column(fields))
    return None if schema.get("additionalProperties") is False else JSON_TEXT


def _one_per_column(fields: list[T.StructField]) -> list[T.StructField]:
    """Keys whose normalised names coincide share one field that reads either key."""
    by_name: dict[str, T.StructField] = {}
    for f in fields:
        name = normalize_name(f.name)
        if name not in by_name:
            by_name[name] = f
            continue
        first = by_name[name]
        keys = [*(first.metadata or {}).get(KEYS, [first.name]), f.name]
        try:
            kind = merge_types(first.dataType, f.dataType)
        except TypeConflict:
            kind = JSON_TEXT
        by_name[name] = T.StructField(first.name, kind, True, {KEYS: keys})
    return list(by_name.values())


def _array(schema: dict) -> T.DataType:
    items = schema.get("items")
    if not isinstance(items, dict):
        return T.ArrayType(JSON_TEXT, True)
    kind = _type_of(items)
    return T.ArrayType(JSON_TEXT if kind is None else kind, _type_names(items)[1])


def _string(schema: dict) -> T.DataType:
    formats = {"date-time": T.TimestampType(), "date": T.DateType()}
    return formats.get(schema.get("format"), T.StringType())


def _bounds(schema: dict) -> tuple | None:
    low, high = schema.get("minimum"), schema.get("maximum")
    return None if low is None or high is None else (low, high)


def _integer(schema: dict) -> T.DataType:
    bounds = _bounds(schema)
    if bounds is None:
        return T.LongType()
    if _INT32[0] <= bounds[0] and bounds[1] <= _INT32[1]:
        return T.IntegerType()
    if _INT64[0] <= bounds[0] and bounds[1] <= _INT64[1]:
        return T.LongType()
    return T.DecimalType(38, 0)


def _number(schema: dict) -> T.DataType:
    step = Decimal(str(schema.get("multipleOf", 0)))
    scale = -step.normalize().as_tuple().exponent
    if step <= 0 or step != Decimal(1).scaleb(-scale) or scale < 0:
        return T.DoubleType()
    bounds = _bounds(schema)
    whole = 38 - scale if bounds is None else max(len(str(int(abs(b)))) for b in bounds)
    for digits in _DECIMAL_DIGITS:
        if whole + scale <= digits:
            return T.DecimalType(digits, scale)
    return T.DoubleType()


def merge_types(older: T.DataType, newer: T.DataType) -> T.DataType:
    """One type for two versions; raises :class:`TypeConflict` when there is none.

    Structs unite their fields, and a field that only one side has becomes nullable.
    Everything else must be equal: widening a number would leave files in the landing
    folder whose columns Parquet readers cannot merge.
    """
    if isinstance(older, T.StructType) and isinstance(newer, T.StructType):
        return T.StructType(_merge_fields(older, newer))
    if isinstance(older, T.ArrayType) and isinstance(newer, T.ArrayType):
        element = merge_types(older.elementType, newer.elementType)
        return T.ArrayType(element, older.containsNull or newer.containsNull)
    if older == newer:
        return older
    raise TypeConflict(f"{older.simpleString()} and {newer.simpleString()}")


def _merge_fields(older: T.StructType, newer: T.StructType) -> list[T.StructField]:
    added = {normalize_name(f.name): f for f in newer.fields}
    merged = []
    for f in older.fields:
        match = added.pop(normalize_name(f.name), None)
        if match is None:
            merged.append(T.StructField(f.name, f.dataType, True, f.metadata))
            continue
        keys = list(
            dict.fromkeys(
                key for side in (f, match) for key in (side.metadata or {}).get(KEYS, [side.name])
            )
        )
        merged.append(
            T.StructField(
                f.name,
                merge_types(f.dataType, match.dataType),
                f.nullable or match.nullable,
                {KEYS: keys} if keys != [f.name] else None,
            )
        )
    merged += [T.StructField(f.name, f.dataType, True, f.metadata) for f in added.values()]
    return merged
