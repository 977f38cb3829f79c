"""Event lines to typed rows, with the reason beside each row that does not fit.

``parse_lines`` adds to the typed fixed columns:

``_failure``   why the line is bad, NULL for a good line
``_payload``   the line as valid UTF-8 text
``_bytes``     its weight
``_unstruct``  the event's own self-describing item, or NULL
``_contexts``  the items of all list fields as one array, never NULL

An item is a struct ``(schema string, data variant)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions import sql
from landfall.functions.schema_uri import is_reference
from landfall.functions.typed_text import text_to_type
from landfall.layout import Layout
from landfall.options import Processor

FAILURE = "_failure"
PAYLOAD = "_payload"
BYTES = "_bytes"
UNSTRUCT_ITEM = "_unstruct"
CONTEXT_ITEMS = "_contexts"

_ITEM = "struct<schema:string,data:variant>"
# Only what JSON itself allows.
_JSON_OPTIONS = "map('allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false')"


def parse_lines(
    lines: DataFrame, layout: Layout, value: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Split each tab-separated line and cast its fields; ``keep`` carries input columns.

    The steps are separate projections so that each intermediate is computed once a row:
    cells, texts, typed values and items, the verdict.
    """
    fields = layout.schema.fields
    line = sql.name(value)
    kept = [sql.name(c) for c in keep]
    carried = [*kept, PAYLOAD, BYTES]
    split = lines.selectExpr(
        *kept,
        f"make_valid_utf8(CAST({line} AS STRING)) AS {PAYLOAD}",
        f"CAST(octet_length({line}) AS BIGINT) AS {BYTES}",
        f"split(CAST({line} AS STRING), '\\t', -1) AS _cells",
    )
    texts = split.selectExpr(
        *carried,
        "size(_cells) AS _size",
        *[f"{_cell(i, len(fields))} AS {_text(f.name)}" for i, f in enumerate(fields)],
    )
    typed = texts.selectExpr(
        *carried,
        "_size",
        *[_text(f.name) for f in fields],
        *[f"{text_to_type(_text(f.name), f.dataType)} AS {sql.name(f.name)}" for f in layout.fixed],
        f"{_single_item(layout)} AS {UNSTRUCT_ITEM}",
        *[f"{_list_items(c, layout)} AS {_list(c)}" for c in layout.contexts],
    )
    joined = typed.selectExpr("*", f"{_all_items(layout)} AS {CONTEXT_ITEMS}")
    reasons = [*_cell_failures(layout), *_item_failures(layout)]
    return joined.selectExpr(
        *kept,
        *[sql.name(f.name) for f in layout.fixed],
        PAYLOAD,
        BYTES,
        f"{sql.computed_once(sql.coalesce(reasons))} AS {FAILURE}",
        UNSTRUCT_ITEM,
        CONTEXT_ITEMS,
    )


def _text(field: str) -> str:
    return sql.name(f"_text_{field}")


def _list(field: str) -> str:
    return sql.name(f"_list_{field}")


def _cell(index: int, count: int) -> str:
    """Text of one field; NULL when empty or when the line has the wrong size."""
    cell = f"get(_cells, {index})"
    return f"CASE WHEN size(_cells) = {count} AND {cell} <> '' THEN {cell} END"


def _from_json(text: str, inner: str, layout: Layout) -> str:
    if layout.envelope:
        return f"from_json({text}, 'struct<data:{inner}>', {_JSON_OPTIONS}).data"
    return f"from_json({text}, '{inner}', {_JSON_OPTIONS})"


def _single_item(layout: Layout) -> str:
    if layout.unstruct is None:
        return f"CAST(NULL AS {_ITEM})"
    return _from_json(_text(layout.unstruct), _ITEM, layout)


def _list_items(field: str, layout: Layout) -> str:
    return _from_json(_text(field), f"array<{_ITEM}>", layout)


def _all_items(layout: Layout) -> str:
    empty = f"CAST(array() AS array<{_ITEM}>)"
    lists = [f"coalesce({_list(c)}, {empty})" for c in layout.contexts]
    if len(lists) == 1:
        return lists[0]
    return f"concat({', '.join(lists)})" if lists else empty


def _cell_failures(layout: Layout) -> list[str]:
    fields = layout.schema.fields
    found = f"concat('expected {len(fields)} fields, found ', _size)"
    found = f"coalesce({found}, 'no line')"  # a NULL line has no size
    failures = [f"CASE WHEN _size <> {len(fields)} OR _size IS NULL THEN {found} END"]
    for f in fields:
        text = _text(f.name)
        if not f.nullable:
            reason = sql.text(f"{f.name}: missing required value")
            failures.append(f"CASE WHEN {text} IS NULL THEN {reason} END")
        if not isinstance(f.dataType, (T.StringType, T.VariantType)):
            reason = sql.text(f"{f.name}: not a valid {f.dataType.typeName()}")
            bad = f"{text} IS NOT NULL AND {sql.name(f.name)} IS NULL"
            failures.append(f"CASE WHEN {bad} THEN {reason} END")
    return failures


def _item_failures(layout: Layout) -> list[str]:
    failures = []
    if layout.unstruct is not None:
        bad = f"{_text(layout.unstruct)} IS NOT NULL AND {_bad_item(UNSTRUCT_ITEM)}"
        reason = sql.text(f"{layout.unstruct}: not a self-describing item")
        failures.append(f"CASE WHEN {bad} THEN {reason} END")
    for c in layout.contexts:
        bad = f"{_text(c)} IS NOT NULL AND {_list(c)} IS NULL"
        failures.append(f"CASE WHEN {bad} THEN {sql.text(f'{c}: not a list of items')} END")
    if layout.contexts:
        bad = f"exists({CONTEXT_ITEMS}, item -> {_bad_item('item')})"
        reason = sql.text("contexts: not a self-describing item")
        failures.append(f"CASE WHEN {bad} THEN {reason} END")
    return failures


def _bad_item(item: str) -> str:
    return f"(NOT coalesce({is_reference(f'{item}.schema')}, false) OR {item}.data IS NULL)"


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(FAILURE).isNull())


def failed_rows(parsed: DataFrame, processor: Processor) -> DataFrame:
    """Failed events: who failed them, why, and the line itself."""
    return parsed.where(F.col(FAILURE).isNotNull()).select(
        F.lit(processor.name).alias("processor_name"),
        F.lit(processor.version).alias("processor_version"),
        F.col(FAILURE).alias("failure"),
        F.col(PAYLOAD).alias("payload"),
    )
