"""Entity columns: strict casts, recovery routing, assembly in output order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions import sql
from landfall.functions.names import UNSTRUCT
from landfall.functions.schema_uri import Criterion, key_of, matches_any, version_of
from landfall.functions.strict_json import (
    keeps_text,
    read_parts,
    strict_error,
    strict_value,
    struct_members,
    text_shape,
)
from landfall.layout import Layout
from landfall.operators.parse import CONTEXT_ITEMS, FAILURE, PAYLOAD, UNSTRUCT_ITEM
from landfall.plans.columns import EntityColumn

# Raw JSON text of the items, only for plans that keep some of it.
_UNSTRUCT_TEXT = "_unstruct_text"
_CONTEXT_TEXTS = "_context_texts"


# The number of the column that takes the event's own item.
_UNSTRUCT_ROUTE = "_unstruct_route"
# Context items, each with the number of its column, and these by column.
_ROUTED = "_routed"
_BY_COLUMN = "_by_column"


def _numbers(columns: list[EntityColumn]) -> dict[EntityColumn, int]:
    return {c: i for i, c in enumerate(columns)}


def _route(item: str, columns: dict[EntityColumn, int], unstruct: bool) -> str:
    """The number of an item's column, NULL if it has none: one look-up of its key."""
    pairs = {key: i for c, i in columns.items() if (c.kind == UNSTRUCT) == unstruct for key in c.keys}
    if not pairs:
        return "CAST(NULL AS INT)"
    listed = ", ".join(f"{sql.text(key)}, {i}" for key, i in pairs.items())
    return f"element_at(map({listed}), {key_of(f'{item}.schema')})"


def _routed_items(columns: dict[EntityColumn, int], texts: bool) -> str:
    """The context items that have a column, with its number."""
    members = "'schema', item.schema, 'data', item.data"
    if texts:
        members += f", 'text', get({_CONTEXT_TEXTS}, i)"
    route = _route("item", columns, unstruct=False)
    items = f"transform({CONTEXT_ITEMS}, (item, i) -> named_struct('route', {route}, {members}))"
    return f"filter({items}, item -> item.route IS NOT NULL)"


def _items_by_column() -> str:
    """Map from a column's number to the row's items for it; NULL for a row without any."""
    routes = f"array_distinct({_ROUTED}.route)"
    groups = f"transform({routes}, route -> filter({_ROUTED}, item -> item.route = route))"
    return f"CASE WHEN size({_ROUTED}) > 0 THEN map_from_arrays({routes}, {groups}) END"


def _item_texts(field: str, shape: str, layout: Layout) -> str:
    """Raw text of the data of a line field's items, each with its keys in their own order."""
    index = layout.schema.fieldNames().index(field)
    raw = f"get(split({PAYLOAD}, '\\t', -1), {index})"
    if layout.envelope:
        return f"from_json({raw}, 'struct<data:{shape}>').data.data"
    return f"from_json({raw}, '{shape}').data"


def _kept_texts(layout: Layout, columns: list[EntityColumn]) -> dict[str, str]:
    kept = {c.kind for c in columns if keeps_text(c.data_type)}
    texts = {}
    if UNSTRUCT in kept:
        texts[_UNSTRUCT_TEXT] = _item_texts(layout.unstruct, "struct<data:string>", layout)
    if kept - {UNSTRUCT}:
        empty = "CAST(array() AS array<string>)"
        lists = [_item_texts(c, "array<struct<data:string>>", layout) for c in layout.contexts]
        lists = ", ".join(f"coalesce({items}, {empty})" for items in lists)
        texts[_CONTEXT_TEXTS] = f"concat({lists})"
    return texts


def _shaped(raw: str, column: EntityColumn) -> str | None:
    shape = text_shape(column.data_type)
    if shape is None or isinstance(shape, T.StringType):
        return raw
    return f"from_json({raw}, {sql.text(shape.simpleString())})"


def _with_version(text: str, version: str) -> str:
    """JSON object text with ``_schema_version`` as its first key."""
    head = f"""concat('{{"_schema_version":"', {version}, '"')"""
    body = f"substr({text}, 2)"
    tail = f"CASE WHEN {body} = '}}' THEN '}}' ELSE concat(',', {body}) END"
    return f"CASE WHEN {text} LIKE '{{%' THEN concat({head}, {tail}) ELSE {text} END"


def _source(item: str, text: str, column: EntityColumn) -> str:
    """What a column's value is made from: the data, or its members if it is a struct."""
    parts = read_parts(f"{item}.data", column.data_type)
    members = ["'schema'", f"{item}.schema", "'data'", f"{item}.data"]
    if parts is not None:
        members = ["'schema'", f"{item}.schema", "'parts'", parts]
    if keeps_text(column.data_type):
        members += ["'text'", _shaped(text, column)]
    return f"named_struct({', '.join(members)})"


def _source_name(column: EntityColumn) -> str:
    return sql.name(f"_source_{column.column}")


def _own_source(column: EntityColumn, number: int) -> str:
    """The source of an event column, or the list of sources of a contexts column."""
    if column.kind == UNSTRUCT:
        source = _source(UNSTRUCT_ITEM, _UNSTRUCT_TEXT, column)
        return f"CASE WHEN {_UNSTRUCT_ROUTE} = {number} THEN {source} END"
    text = "item.text" if keeps_text(column.data_type) else ""
    own = f"element_at({_BY_COLUMN}, {number})"
    return f"CASE WHEN {own} IS NOT NULL THEN transform({own}, item -> {_source('item', text, column)}) END"


def _parts(source: str, column: EntityColumn) -> str | None:
    return f"{source}.parts" if read_parts("data", column.data_type) is not None else None


def _text(source: str, column: EntityColumn) -> str | None:
    return f"{source}.text" if keeps_text(column.data_type) else None


def _context_value(column: EntityColumn) -> str:
    version = version_of("item.schema")
    kind, text, parts = column.data_type, _text("item", column), _parts("item", column)
    if isinstance(kind, T.StructType):
        members = struct_members("item.data", kind, text, parts=parts)
        return f"named_struct('_schema_version', {version}, {members})"
    value = strict_value("item.data", kind, text)
    return _with_version(value, version) if isinstance(kind, T.VariantType) else value


def _value(column: EntityColumn) -> str:
    """The column's value for a row; NULL when the row has no such item."""
    source = _source_name(column)
    if column.kind == UNSTRUCT:
        value = strict_value(
            f"{source}.data",
            column.data_type,
            _text(source, column),
            parts=_parts(source, column),
        )
        return f"CASE WHEN {source} IS NOT NULL THEN {value} END"
    values = f"transform({source}, item -> {_context_value(column)})"
    return f"CASE WHEN size({source}) > 0 THEN {values} END"


def _error(column: EntityColumn) -> str:
    """Why one of the row's items does not fit this column; NULL when all do."""
    source, name = _source_name(column), column.column

    def error(item: str) -> str:
        parts = _parts(item, column)
        return strict_error(f"{item}.data", column.data_type, name, nullable=False, parts=parts)

    if column.kind == UNSTRUCT:
        return f"CASE WHEN {source} IS NOT NULL THEN {error(source)} END"
    errors = f"filter(transform({source}, item -> {error('item')}), x -> x IS NOT NULL)"
    return f"CASE WHEN size({source}) > 0 THEN get({errors}, 0) END"


def _unknown_schema(known: list[str], skipped: list[Criterion]) -> str:
    """Reason for a row with an item whose schema is neither registered nor skipped."""
    uris = f"concat(array({UNSTRUCT_ITEM}.schema), {CONTEXT_ITEMS}.schema)"
    known_or_skipped = f"key IN ({sql.texts(known)}) OR {matches_any(skipped, 'key')}"
    unknown = f"key IS NOT NULL AND NOT coalesce({known_or_skipped}, false)"
    keys = f"transform({uris}, uri -> {key_of('uri')})"
    return f"concat('schema not found: ', get(filter({keys}, key -> {unknown}), 0))"


def transform_events(
    parsed: DataFrame,
    layout: Layout,
    columns: list[EntityColumn],
    known: list[str] | None = None,
    skipped: list[Criterion] = (),
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Fixed columns, entity columns, and ``_failure``/``_payload`` for the second split.

    ``known`` holds the keys of registered schemas; give it when events with any other
    key, unless skipped, are to fail. None means that no such key occurs.
    """
    fixed = [sql.name(c) for c in (*keep, *[f.name for f in layout.fixed])]
    failure = FAILURE
    if known is not None:
        failure = sql.coalesce([FAILURE, _unknown_schema(known, list(skipped))])
    texts = _kept_texts(layout, columns)
    source = parsed.selectExpr(
        *fixed,
        PAYLOAD,
        f"{failure} AS {FAILURE}",
        UNSTRUCT_ITEM,
        CONTEXT_ITEMS,
        *[f"{raw} AS {name}" for name, raw in texts.items()],
    )
    # Each item's key is looked up once and the items of a row are grouped once, so that a
    # further column costs a row that has no item for it one look-up by number.
    numbers = _numbers(columns)
    carried = [*fixed, PAYLOAD, FAILURE, UNSTRUCT_ITEM, *(t for t in texts if t == _UNSTRUCT_TEXT)]
    routed = source.selectExpr(
        *carried,
        f"{_route(UNSTRUCT_ITEM, numbers, unstruct=True)} AS {_UNSTRUCT_ROUTE}",
        f"{_routed_items(numbers, _CONTEXT_TEXTS in texts)} AS {_ROUTED}",
    )
    grouped = routed.selectExpr(*carried, _UNSTRUCT_ROUTE, f"{_items_by_column()} AS {_BY_COLUMN}")
    sources = grouped.selectExpr("*", *[f"{_own_source(c, i)} AS {_source_name(c)}" for c, i in numbers.items()])
    return sources.selectExpr(
        *fixed,
        *[f"{_value(c)} AS {sql.name(c.column)}" for c in columns],
        f"{sql.computed_once(sql.coalesce([FAILURE, *[_error(c) for c in columns]]))} AS {FAILURE}",
        PAYLOAD,
    )


def override_load_time(events: DataFrame, layout: Layout, now: Column) -> DataFrame:
    """Set the load time field of every row to one value."""
    return events.withColumn(layout.load_time, now)


def assemble(
    events: DataFrame, layout: Layout, columns: list[EntityColumn], all_good: bool = False
) -> DataFrame:
    """Good rows with the landed columns in order: fixed, then entities."""
    names = [*[f.name for f in layout.fixed], *[c.column for c in columns]]
    good = events if all_good else events.where(F.col(FAILURE).isNull())
    return good.select(*names)
