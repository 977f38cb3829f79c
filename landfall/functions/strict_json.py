"""Strict typed reads of JSON values, generated as SQL from a planned type.

A planned type is a Spark ``DataType`` in which ``VariantType`` means "keep as JSON
text". A struct field may carry the JSON keys it reads in its metadata (``keys``);
without them the key is the field's name. ``from_json`` and plain variant casts accept
``"12"`` for a number and ``12`` for a string; here the JSON type itself must fit.

Every function takes the value as the SQL of a variant. Where JSON text is kept, ``raw``
is the same value as raw text, because a variant reorders keys. ``depth`` keeps the names
of nested lambda variables apart. ``parts`` is the SQL of the members of a struct read
beforehand, see :func:`read_parts`.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

from landfall.functions import sql
from landfall.functions.names import normalize_name
from landfall.functions.typed_text import text_to_date, text_to_timestamp

KEYS = "keys"
_PLAIN_KEY = re.compile(r"[^'?\\]+")


def keys_of(field: T.StructField) -> list[str]:
    return list((field.metadata or {}).get(KEYS, [field.name]))


def keeps_text(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(keeps_text(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return keeps_text(kind.elementType)
    return isinstance(kind, T.VariantType)


def landed_type(kind: T.DataType) -> T.DataType:
    """The type as written: normalised field names, JSON as string."""
    if isinstance(kind, T.StructType):
        return T.StructType(
            [
                T.StructField(normalize_name(f.name), landed_type(f.dataType), f.nullable)
                for f in kind.fields
            ]
        )
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(landed_type(kind.elementType), kind.containsNull)
    return T.StringType() if isinstance(kind, T.VariantType) else kind


def _read(value: str, kind: str, path: str = "$") -> str:
    return f"try_variant_get({value}, {sql.text(path)}, {sql.text(kind)})"


def _missing(value: str) -> str:
    """Absent or JSON null."""
    return f"({value} IS NULL OR is_variant_null({value}))"


def _member(value: str, key: str) -> str:
    if _PLAIN_KEY.fullmatch(key):
        return _read(value, "variant", f"$['{key}']")
    quoted = sql.name(key)
    return f"{_read(value, f'struct<{quoted} variant>')}.{quoted}"


def _field_value(value: str, field: T.StructField) -> str:
    members = [_member(value, key) for key in keys_of(field)]
    if len(members) == 1:
        return members[0]
    return _first_present(members)


def read_parts(value: str, kind: T.DataType) -> str | None:
    """One read of all members of a struct, as variants; NULL for anything but an object.

    Put it in a projection of its own: the checks and the values of the members then
    share one walk through the object. None when the type has no such read.
    """
    if not isinstance(kind, T.StructType):
        return None
    keys = [key for f in kind.fields for key in keys_of(f)]
    if len({key.lower() for key in keys}) < len(keys):
        return None
    return _read(value, f"struct<{', '.join(f'{sql.name(key)} variant' for key in keys)}>")


def _members_of(value: str, field: T.StructField, parts: str | None) -> str:
    if parts is None:
        return _field_value(value, field)
    members = [f"{parts}.{sql.name(key)}" for key in keys_of(field)]
    return members[0] if len(members) == 1 else _first_present(members)


def _first_present(members: list[str]) -> str:
    return sql.coalesce([f"CASE WHEN NOT {_missing(m)} THEN {m} END" for m in members])


def _elements(value: str) -> str:
    return _read(value, "array<variant>")


def _is_object(value: str) -> str:
    # A one-field read is NULL for anything but an object and skips the other members.
    return f"{_read(value, 'struct<`_` variant>')} IS NOT NULL"


def _json_type(value: str) -> str:
    return f"schema_of_variant({value})"


def _decimal_fits(value: str, kind: T.DecimalType) -> str:
    """In range and exact: reads as decimals round, so the stored scale is compared."""
    json_type, target = _json_type(value), _read(value, kind.simpleString())
    # The type reads DECIMAL(precision,scale).
    scale = f"try_cast(rtrim(')', substring_index({json_type}, ',', -1)) AS INT)"
    return (
        f"({target} IS NOT NULL AND CASE WHEN {json_type} = 'BIGINT' THEN true"
        f" WHEN {json_type} LIKE 'DECIMAL%' THEN {scale} <= {kind.scale}"
        f" WHEN {json_type} = 'DOUBLE'"
        f" THEN CAST({target} AS DOUBLE) = {_read(value, 'double')} ELSE false END)"
    )


def _leaf_fits(value: str, kind: T.DataType) -> str:
    json_type = _json_type(value)
    if isinstance(kind, T.VariantType):
        return "true"
    if isinstance(kind, T.StringType):
        return f"{json_type} = 'STRING'"
    if isinstance(kind, T.BooleanType):
        return f"{json_type} = 'BOOLEAN'"
    if isinstance(kind, T.LongType):
        return f"{json_type} = 'BIGINT'"
    if isinstance(kind, T.IntegerType):
        return f"({json_type} = 'BIGINT' AND {_read(value, 'int')} IS NOT NULL)"
    if isinstance(kind, T.DoubleType):
        return f"({json_type} IN ('BIGINT', 'DOUBLE') OR {json_type} LIKE 'DECIMAL%')"
    if isinstance(kind, T.DecimalType):
        return _decimal_fits(value, kind)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return f"({json_type} = 'STRING' AND {_leaf_value(value, kind)} IS NOT NULL)"
    raise TypeError(f"no strict read for {kind.simpleString()}")


def _leaf_value(value: str, kind: T.DataType, raw: str | None = None) -> str:
    if isinstance(kind, T.VariantType):
        # Raw text of a JSON string has lost its quotes; the variant gives them back.
        return f"CASE WHEN {_json_type(value)} = 'STRING' THEN to_json({value}) ELSE {raw} END"
    if isinstance(kind, T.DateType):
        return text_to_date(_read(value, "string"))
    if isinstance(kind, T.TimestampType):
        return text_to_timestamp(_read(value, "string"))
    return _read(value, kind.simpleString())


def strict_error(
    value: str,
    kind: T.DataType,
    path: str,
    nullable: bool = True,
    depth: int = 0,
    parts: str | None = None,
) -> str:
    """Why the value does not fit the type; NULL when it fits."""
    missing = "NULL" if nullable else sql.text(f"{path}: missing required value")
    wrong = sql.text(f"{path}: expected {landed_type(kind).typeName()}")
    if isinstance(kind, T.VariantType):
        return "CAST(NULL AS STRING)" if nullable else f"CASE WHEN {value} IS NULL THEN {missing} END"
    checked = f"CASE WHEN {_missing(value)} THEN {missing}"
    if isinstance(kind, T.StructType):
        inner = sql.coalesce(
            [
                strict_error(
                    _members_of(value, f, parts), f.dataType, f"{path}.{f.name}", f.nullable, depth
                )
                for f in kind.fields
            ]
        )
        if parts is not None:
            return f"CASE WHEN {parts} IS NULL THEN {wrong} ELSE {inner} END"
        return f"{checked} WHEN NOT {_is_object(value)} THEN {wrong} ELSE {inner} END"
    if isinstance(kind, T.ArrayType):
        elements, item = _elements(value), f"e{depth}"
        error = strict_error(item, kind.elementType, f"{path}[]", kind.containsNull, depth + 1)
        errors = f"filter(transform({elements}, {item} -> {error}), x -> x IS NOT NULL)"
        return f"{checked} WHEN {elements} IS NULL THEN {wrong} ELSE get({errors}, 0) END"
    return f"{checked} WHEN NOT {_leaf_fits(value, kind)} THEN {wrong} END"


def text_shape(kind: T.DataType) -> T.DataType | None:
    """``from_json`` type that reads only the parts kept as text, all as raw text."""
    if isinstance(kind, T.VariantType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        inner = text_shape(kind.elementType)
        return inner and T.ArrayType(inner)
    if isinstance(kind, T.StructType):
        fields = [
            T.StructField(key, shape)
            for f in kind.fields
            if (shape := text_shape(f.dataType)) is not None
            for key in keys_of(f)
        ]
        return T.StructType(fields) if fields else None
    return None


def strict_value(
    value: str,
    kind: T.DataType,
    raw: str | None = None,
    depth: int = 0,
    parts: str | None = None,
) -> str:
    """The typed value of a variant known to fit. ``raw`` is shaped by :func:`text_shape`."""
    if isinstance(kind, T.StructType):
        members = struct_members(value, kind, raw, depth, parts)
        is_object = _is_object(value) if parts is None else f"{parts} IS NOT NULL"
        return f"CASE WHEN {is_object} THEN named_struct({members}) END"
    if isinstance(kind, T.ArrayType):
        item, position = f"e{depth}", f"i{depth}"
        part = f"get({raw}, {position})" if keeps_text(kind.elementType) else None
        inner = strict_value(item, kind.elementType, part, depth + 1)
        return f"transform({_elements(value)}, ({item}, {position}) -> {inner})"
    return f"CASE WHEN NOT is_variant_null({value}) THEN {_leaf_value(value, kind, raw)} END"


def struct_members(
    value: str,
    kind: T.StructType,
    raw: str | None = None,
    depth: int = 0,
    parts: str | None = None,
) -> str:
    """Names and values of a struct's members, under their normalised names."""
    members = []
    for f in kind.fields:
        part = None
        if keeps_text(f.dataType):
            part = sql.coalesce([f"{raw}.{sql.name(key)}" for key in keys_of(f)])
        member = strict_value(_members_of(value, f, parts), f.dataType, part, depth)
        members.append(f"{sql.text(normalize_name(f.name))}, {member}")
    return ", ".join(members)
