"""Discovery, registry, evolution, entity columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions.names import UNSTRUCT
from landfall.functions.schema_uri import Criterion
from landfall.operators import registry as lookup
from landfall.operators.entities import discover_entities, entity_versions, skip_schemas
from landfall.operators.metrics import good_bad_counts
from landfall.operators.parse import FAILURE, parse_lines
from landfall.operators.project import assemble, override_load_time, transform_events
from landfall.options import LoadOptions
from landfall.plans.columns import EntityColumn
from landfall.queries import inputs
from landfall.queries.catalog import query
from landfall.queries.inputs import (
    SQL_ADDITION,
    SQL_CONTEXTS,
    SQL_GOOD,
    SQL_GOOD_LINE,
    SQL_K,
    SQL_WRONG_TYPE,
)
from landfall.streaming.loader import BatchPlan, plan_batch

_SQL_SEEN = f"""SELECT 'unstruct' AS kind, 'acme.test' AS vendor, event_type AS name, 1 AS model,
    0 AS revision, CAST({SQL_ADDITION} AS INTEGER) AS addition FROM events WHERE {SQL_GOOD_LINE}
  UNION ALL SELECT 'contexts', 'acme.test', 'session', 1, 0, 0 FROM events
    WHERE {SQL_GOOD_LINE} AND {SQL_CONTEXTS} > 0
  UNION ALL SELECT 'contexts', 'acme.test', 'meter', 2, 0, CAST({SQL_ADDITION} AS INTEGER)
    FROM events WHERE {SQL_GOOD_LINE} AND {SQL_CONTEXTS} = 2"""
_SQL_DISCOVERED = f"""SELECT kind, vendor, name, model, revision, addition, count(*) AS items
  FROM ({_SQL_SEEN}) GROUP BY ALL"""


def options(**changes) -> LoadOptions:
    """Options for queries that plan and transform but write nothing."""
    return LoadOptions("", "", "", layout=inputs.layout(), **changes)


def transformed(
    parsed: DataFrame, registry: DataFrame, settings: LoadOptions, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, BatchPlan]:
    plan = plan_batch(parsed, registry, settings)
    known = plan.known if plan.missing_items else None
    events = transform_events(
        parsed, settings.layout, plan.columns, known, settings.criteria, keep
    )
    return events, plan


def transformed_events(spark: SparkSession, sf_dir: str, **changes) -> tuple[DataFrame, BatchPlan]:
    return transformed(
        inputs.parsed_events(spark, sf_dir), inputs.registry(spark, sf_dir), options(**changes)
    )


def landed_events(spark: SparkSession, sf_dir: str, **changes) -> tuple[DataFrame, BatchPlan]:
    events, plan = transformed_events(spark, sf_dir, **changes)
    return assemble(events, inputs.layout(), plan.columns), plan


@query("entity_discovery", _SQL_DISCOVERED)
def entity_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover_entities(inputs.parsed_events(spark, sf_dir))


@query(
    "entity_versions",
    f"""SELECT kind, vendor, name, model,
    string_agg(DISTINCT revision || '-' || addition, ',' ORDER BY revision || '-' || addition)
      AS versions
    FROM ({_SQL_SEEN}) GROUP BY kind, vendor, name, model""",
)
def versions_by_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = entity_versions(discover_entities(inputs.parsed_events(spark, sf_dir)))
    return found.withColumn("versions", F.array_join("versions", ","))


_SKIPPED = (
    f"sd:{inputs.VENDOR}/click/jsonschema/1-0-0",
    f"sd:{inputs.VENDOR}/error/jsonschema/1-0-*",
    f"sd:{inputs.VENDOR}/meter/jsonschema/2-*-*",
    f"sd:{inputs.VENDOR}/session/jsonschema/*-*-*",
)


@query(
    "skip_schemas",
    f"""SELECT * FROM ({_SQL_DISCOVERED})
    WHERE NOT (name = 'click' AND addition = 0) AND name NOT IN ('error', 'meter', 'session')""",
)
def skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discover_entities(inputs.parsed_events(spark, sf_dir))
    return skip_schemas(found, [Criterion.parse(text) for text in _SKIPPED])


@query(
    "skipped_columns",
    f"""SELECT event_id, event_type AS event_name,
    CASE WHEN event_type = 'error' OR (event_type = 'click' AND {SQL_ADDITION} = 0) THEN NULL
      ELSE CAST({SQL_K} AS BIGINT) END AS k
    FROM events WHERE {SQL_GOOD_LINE}
      AND NOT ({SQL_WRONG_TYPE} AND NOT
        (event_type = 'error' OR (event_type = 'click' AND {SQL_ADDITION} = 0)))""",
)
def skipped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A skipped schema has no column and its values are not checked."""
    events, plan = landed_events(spark, sf_dir, skip_schemas=_SKIPPED)
    return events.select("event_id", "event_name", _k_of(plan, UNSTRUCT))


def _partial_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry without ``view`` and without the newest ``signup``."""
    gone = (F.col("name") == "view") | ((F.col("name") == "signup") & (F.col("addition") == 1))
    return inputs.registry(spark, sf_dir).where(~gone)


_SQL_GONE = f"(event_type = 'view' OR (event_type = 'signup' AND {SQL_ADDITION} = 1))"


@query(
    "resolve_schemas",
    f"""SELECT *, NOT (name = 'view' OR (name = 'signup' AND addition = 1)) AS resolved
    FROM ({_SQL_DISCOVERED})""",
)
def resolve_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discover_entities(inputs.parsed_events(spark, sf_dir))
    resolved = lookup.resolve(found, _partial_registry(spark, sf_dir))
    return resolved.withColumn("resolved", F.col("schema_json").isNotNull()).drop("schema_json")


@query(
    "missing_schemas",
    f"""SELECT * FROM ({_SQL_DISCOVERED})
    WHERE name = 'view' OR (name = 'signup' AND addition = 1)""",
)
def missing_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discover_entities(inputs.parsed_events(spark, sf_dir))
    return lookup.missing_schemas(found, _partial_registry(spark, sf_dir))


@query(
    "missing_schemas_lenient",
    f"""SELECT CASE WHEN event_id % 47 = 7 THEN 'expected 8 fields, found 1'
      WHEN {_SQL_GONE} THEN 'schema not found: acme.test/' || event_type || '/jsonschema/1-0-' || ({SQL_ADDITION})
      WHEN {SQL_WRONG_TYPE} THEN 'wrong type' END AS failure, count(*) AS events
    FROM events GROUP BY 1""",
)
def missing_schemas_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient: events with an unregistered schema fail, the others load."""
    events, _ = transformed(
        inputs.parsed_events(spark, sf_dir), _partial_registry(spark, sf_dir), options(strict=False)
    )
    reason = F.when(F.col(FAILURE).contains(": expected"), "wrong type").otherwise(F.col(FAILURE))
    return events.groupBy(reason.alias("failure")).agg(F.count("*").alias("events"))


@query(
    "clashing_schemas",
    f"""SELECT 'unstruct_event_acme_test_' || event_type || '_1' AS column_name,
    'acme.test.' || event_type || ',acme.test_' || event_type AS schemas
    FROM events WHERE {SQL_GOOD_LINE} GROUP BY event_type
    HAVING count(DISTINCT {SQL_ADDITION}) = 2""",
)
def clashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events come from vendor ``acme`` with names that collide with ``acme.test``'s."""
    odd = F.col("event_id") % 2 == 1
    uri = F.when(odd, F.concat(F.lit("sd:acme/test_"), "event_type")).otherwise(
        F.concat(F.lit("sd:acme.test/"), "event_type")
    )
    item = inputs.described(F.concat(uri, F.lit("/jsonschema/1-0-0")), inputs.event_data())
    lines = inputs.lines_of(inputs.spread_table(spark, sf_dir, "events"), unstruct=inputs.envelope("unstruct", item))
    found = discover_entities(parse_lines(lines, inputs.layout()))
    return lookup.clashing_schemas(found).withColumn("schemas", F.array_join("schemas", ","))


@query(
    "merged_fields",
    f"""WITH own AS (SELECT DISTINCT event_type FROM events WHERE {SQL_GOOD_LINE})
    SELECT 'unstruct' AS kind, event_type AS name, 'k' AS field,
      CASE event_type WHEN 'error' THEN 'integer,string' ELSE 'integer' END AS types,
      false AS nullable, event_type = 'error' AS conflicting FROM own
    UNION ALL SELECT 'unstruct', event_type, 'note', 'string', true, false FROM own
    UNION ALL SELECT 'contexts', 'session', 'user', 'integer', false, false
    UNION ALL SELECT 'contexts', 'meter', 'reading', 'number', false, false
    UNION ALL SELECT 'contexts', 'meter', 'flag', 'boolean', true, false""",
)
def merged_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = discover_entities(inputs.parsed_events(spark, sf_dir))
    history = lookup.field_history(found, inputs.registry(spark, sf_dir))
    return history.select(
        "kind", "name", "field", F.array_join("types", ",").alias("types"), "nullable", "conflicting"
    )


def _k_of(plan: BatchPlan, kind: str, recovered: bool = False) -> Column:
    """``k`` of whichever entity column the row fills."""
    columns = [
        c for c in plan.columns if c.kind == kind and c.recovered == recovered
    ]
    values = [F.col(c.column).getField("k") for c in columns]
    return F.coalesce(*values).alias("recovered_k" if recovered else "k")


@query(
    "recovery_columns",
    f"""SELECT event_id, event_type AS event_name,
    CASE WHEN event_type = 'error' AND {SQL_ADDITION} = 1 THEN NULL
      ELSE CAST({SQL_K} AS BIGINT) END AS k,
    CASE WHEN event_type = 'error' AND {SQL_ADDITION} = 1 THEN {SQL_K} END AS recovered_k
    FROM events WHERE {SQL_GOOD}""",
)
def recovery_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, plan = landed_events(spark, sf_dir)
    return events.select(
        "event_id", "event_name", _k_of(plan, UNSTRUCT), _k_of(plan, UNSTRUCT, recovered=True)
    )


@query(
    "unstruct_columns",
    f"""SELECT event_id, 'unstruct_event_acme_test_' || event_type || '_1' AS column_name,
    CAST({SQL_K} AS BIGINT) AS k,
    CASE WHEN {SQL_ADDITION} = 1 THEN event_type || '-' || user_id END AS note
    FROM events WHERE {SQL_GOOD} AND NOT (event_type = 'error' AND {SQL_ADDITION} = 1)""",
)
def unstruct_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event fills the one column of its schema; merged versions share it."""
    events, plan = landed_events(spark, sf_dir)
    own = [c for c in plan.columns if c.kind == UNSTRUCT and not c.recovered]
    filled = [_filled(c, c.data_type.fieldNames()) for c in own]
    one = events.select("event_id", F.inline(F.array_compact(F.array(*filled))))
    return one.select("event_id", "column_name", "k", "note")


def _filled(column: EntityColumn, names: list[str]) -> Column:
    """The column as a struct of the fields all events share; NULL when it is NULL."""
    value = F.col(column.column)
    note = value.getField("note") if "note" in names else F.lit(None).cast("string")
    row = F.struct(
        F.lit(column.column).alias("column_name"),
        value.getField("k").alias("k"),
        note.alias("note"),
    )
    return F.when(value.isNotNull(), row)


@query(
    "context_columns",
    f"""SELECT event_id, 'session' AS entity, '1-0-0' AS version, CAST(user_id AS BIGINT) AS user_id,
    NULL AS reading, NULL AS flag FROM events WHERE {SQL_GOOD} AND {SQL_CONTEXTS} > 0
    UNION ALL SELECT event_id, 'meter', '2-0-' || ({SQL_ADDITION}), NULL,
    CAST(CAST(value AS DECIMAL(9,2)) AS VARCHAR),
    CASE WHEN {SQL_ADDITION} = 1 THEN value > 20 END
    FROM events WHERE {SQL_GOOD} AND {SQL_CONTEXTS} = 2""",
)
def context_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _ = landed_events(spark, sf_dir)
    session = F.transform(
        "contexts_acme_test_session_1",
        lambda c: _context("session", c, user_id=c.getField("user").cast("long")),
    )
    meter = F.transform(
        "contexts_acme_test_meter_2",
        lambda c: _context(
            "meter", c, reading=c.getField("reading").cast("string"), flag=c.getField("flag")
        ),
    )
    items = F.concat(*[F.coalesce(x, F.array().cast(_CONTEXTS)) for x in (session, meter)])
    return events.select("event_id", F.inline(items))


_CONTEXTS = "array<struct<entity:string,version:string,user_id:bigint,reading:string,flag:boolean>>"


def _context(entity: str, item: Column, **values: Column) -> Column:
    def value(name: str, kind: str) -> Column:
        return values.get(name, F.lit(None).cast(kind)).alias(name)

    return F.struct(
        F.lit(entity).alias("entity"),
        item.getField("_schema_version").alias("version"),
        value("user_id", "bigint"),
        value("reading", "string"),
        value("flag", "boolean"),
    )


def _empty_schema_run(
    spark: SparkSession, sf_dir: str, name: str, open_schema: bool
) -> tuple[DataFrame, BatchPlan]:
    """Every event carries one schema without fields, as its own event and as a context."""
    data = F.concat(
        F.lit('{"z":'), F.get_json_object("props", "$.k"), F.lit(',"a":{"t":"'), "event_type",
        F.lit('"}}'),
    )
    data = F.when(F.lit(open_schema) & (F.col("event_id") % 3 > 0), data).otherwise(F.lit("{}"))
    item = inputs.described(F.lit(f"sd:{inputs.VENDOR}/{name}/jsonschema/1-0-0"), data)
    lines = inputs.lines_of(
        inputs.spread_table(spark, sf_dir, "events"),
        unstruct=inputs.envelope("unstruct", item),
        contexts=inputs.envelope("contexts", F.concat(F.lit("["), item, F.lit("]"))),
    )
    schema = '{"type":"object","additionalProperties":%s}' % str(open_schema).lower()
    row = inputs.registry_row(F.lit(name), (1, 0, 0), F.lit(schema))
    # One registry row, derived from the table like the others.
    registry = inputs.events(spark, sf_dir).agg(F.count("*")).select(F.inline(F.array(row)))
    events, plan = transformed(parse_lines(lines, inputs.layout()), registry, options())
    return assemble(events, inputs.layout(), plan.columns), plan


@query(
    "closed_empty_schema",
    f"""SELECT event_id, event_type AS event_name, CAST(0 AS BIGINT) AS entity_columns
    FROM events WHERE {SQL_GOOD_LINE}""",
)
def closed_empty_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No fields and none allowed: no column, and the event is good."""
    events, _ = _empty_schema_run(spark, sf_dir, "no-fields-closed", open_schema=False)
    extra = [c for c in events.columns if c.startswith(("unstruct_event_", "contexts_"))]
    count = F.lit(len(extra)).cast("long").alias("entity_columns")
    return events.select("event_id", "event_name", count)


_SQL_OPEN_TEXT = f"""'"z":' || {SQL_K} || ',"a":{{"t":"' || event_type || '"}}'"""


@query(
    "open_empty_schema",
    f"""SELECT event_id,
    CASE WHEN {SQL_CONTEXTS} > 0 THEN '{{' || {_SQL_OPEN_TEXT} || '}}' ELSE '{{}}' END AS event_json,
    CASE WHEN {SQL_CONTEXTS} > 0 THEN '{{"_schema_version":"1-0-0",' || {_SQL_OPEN_TEXT} || '}}'
      ELSE '{{"_schema_version":"1-0-0"}}' END AS context_json
    FROM events WHERE {SQL_GOOD_LINE}""",
)
def open_empty_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No fields but any allowed: the data lands as JSON text, keys in their order."""
    events, _ = _empty_schema_run(spark, sf_dir, "noFieldsOpen", open_schema=True)
    return events.select(
        "event_id",
        F.col("unstruct_event_acme_test_no_fields_open_1").alias("event_json"),
        F.explode("contexts_acme_test_no_fields_open_1").alias("context_json"),
    )


@query(
    "transform_failures",
    f"""SELECT event_id, 'unstruct_event_acme_test_' || event_type || '_1'
      || CASE WHEN event_type = 'error' AND {SQL_ADDITION} = 1 THEN '_recovered_1_0_1' ELSE '' END
      || '.k: expected '
      || CASE WHEN event_type = 'error' AND {SQL_ADDITION} = 1 THEN 'string' ELSE 'long' END
      AS failure
    FROM events WHERE {SQL_GOOD_LINE} AND {SQL_WRONG_TYPE}""",
)
def transform_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that parsed but whose entity does not fit its schema."""
    events, _ = transformed_events(spark, sf_dir)
    reason = F.regexp_replace(FAILURE, "_[0-9a-f]{8}\\.", ".")
    late = events.where(F.col(FAILURE).isNotNull() & F.col("event_id").isNotNull())
    return late.select("event_id", reason.alias("failure"))


@query(
    "etl_override",
    f"""SELECT event_id, 1700000000123 AS etl_millis FROM events WHERE {SQL_GOOD}""",
)
def etl_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, plan = transformed_events(spark, sf_dir)
    now = F.timestamp_millis(F.lit(1700000000123))
    landed = assemble(override_load_time(events, inputs.layout(), now), inputs.layout(), plan.columns)
    return landed.select("event_id", F.unix_millis("etl_tstamp").alias("etl_millis"))


@query(
    "assembled_columns",
    f"""WITH names AS (
      SELECT 0 AS part, pos AS rank, 0 AS version, name FROM (VALUES (0, 'event_id'),
        (1, 'collector_tstamp'), (2, 'etl_tstamp'), (3, 'event_name'), (4, 'user_id'), (5, 'value'))
        AS fixed(pos, name)
      UNION ALL SELECT 1, dense_rank() OVER (ORDER BY event_type), version,
        'unstruct_event_acme_test_' || event_type || '_1' || suffix
        FROM (SELECT DISTINCT event_type FROM events WHERE {SQL_GOOD_LINE}),
        (VALUES (0, ''), (1, '_recovered_1_0_1')) AS v(version, suffix)
        WHERE version = 0 OR event_type = 'error'
      UNION ALL VALUES (2, 0, 0, 'contexts_acme_test_meter_2'), (2, 1, 0, 'contexts_acme_test_session_1'))
    SELECT row_number() OVER (ORDER BY part, rank, version) - 1 AS position, name,
      (SELECT count(*) FROM events WHERE {SQL_GOOD}) AS events FROM names""",
)
def assembled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed columns in order, with the number of rows landed under them."""
    events, _ = landed_events(spark, sf_dir)
    names = [
        F.struct(F.lit(i).cast("long").alias("position"), F.lit(_without_hash(c)).alias("name"))
        for i, c in enumerate(events.columns)
    ]
    counted = events.agg(F.count("*").alias("events"))
    return counted.select(F.inline(F.array(*names)), "events")


def _without_hash(column: str) -> str:
    return column.rsplit("_", 1)[0] if "_recovered_" in column else column


@query(
    "good_bad_counts",
    f"""SELECT count(*) FILTER ({SQL_GOOD}) AS events_good,
    count(*) FILTER (NOT ({SQL_GOOD})) AS events_bad FROM events""",
)
def good_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, _ = transformed_events(spark, sf_dir)
    return good_bad_counts(events)
