"""Event lines and a schema registry derived from the driver's ``events`` table.

Every event becomes one line. So that each path of the load is taken, some lines carry a
fault, chosen by ``event_id``: malformed text, or a value of the wrong JSON type. All
rows are processed; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.layout import Layout
from landfall.operators.parse import parse_lines
from landfall.operators.registry import REGISTRY_SCHEMA
from landfall.sources.lines import spread
from landfall.sources.scratch import scratch_folder

VENDOR = "acme.test"

LAYOUT_DDL = (
    "event_id BIGINT NOT NULL, collector_tstamp TIMESTAMP NOT NULL, etl_tstamp TIMESTAMP, "
    "event_name STRING NOT NULL, user_id BIGINT, value DOUBLE, "
    "unstruct_event VARIANT, contexts VARIANT"
)

# The same conditions in SQL, for the expected results.
SQL_MALFORMED = "event_id % 47 = 7"
SQL_GOOD_LINE = "event_id % 47 <> 7"
SQL_WRONG_TYPE = "event_id % 41 = 3"
SQL_GOOD = f"{SQL_GOOD_LINE} AND NOT ({SQL_WRONG_TYPE})"
SQL_ADDITION = "event_id % 2"
SQL_CONTEXTS = "event_id % 3"
SQL_K = "json_extract_string(props, '$.k')"


def layout() -> Layout:
    return Layout.from_ddl(LAYOUT_DDL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc(zoneless: Column) -> Column:
    """A zoneless timestamp taken as UTC, in any session."""
    return F.concat(zoneless.cast("string"), F.lit("Z")).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table about to be parsed or cast, over all cores even if it is one file."""
    return spread(table(spark, sf_dir, name), stable_order=True)


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def _uri(name: Column, version: Column) -> Column:
    return F.concat(F.lit(f"sd:{VENDOR}/"), name, F.lit("/jsonschema/"), version)


def described(uri: Column, data: Column) -> Column:
    return F.concat(F.lit('{"schema":"'), uri, F.lit('","data":'), data, F.lit("}"))


def envelope(name: str, data: Column) -> Column:
    return described(F.lit(f"sd:{VENDOR}/{name}/jsonschema/1-0-0"), data)


def event_data() -> Column:
    """Data of the event's own schema: ``k``, and from version 1-0-1 a ``note``.

    ``k`` is a number, but a string for ``error`` from 1-0-1 on. A fault swaps the two.
    """
    newer = F.col("event_id") % 2 == 1
    as_text = ((F.col("event_type") == "error") & newer) != (F.col("event_id") % 41 == 3)
    k = F.when(as_text, F.concat(F.lit('"'), _k(), F.lit('"'))).otherwise(_k())
    note = F.concat(
        F.lit(',"note":"'), "event_type", F.lit("-"), F.col("user_id").cast("string"), F.lit('"')
    )
    return F.concat(
        F.lit('{"k":'), k, F.when(newer, note).otherwise(F.lit("")), F.lit("}")
    )


def own_event() -> Column:
    version = F.concat(F.lit("1-0-"), (F.col("event_id") % 2).cast("string"))
    return envelope("unstruct", described(_uri(F.col("event_type"), version), event_data()))


def own_contexts() -> Column:
    """None, a session, or a session and a meter reading."""
    session = described(
        _uri(F.lit("session"), F.lit("1-0-0")),
        F.concat(F.lit('{"user":'), F.col("user_id").cast("string"), F.lit("}")),
    )
    newer = F.col("event_id") % 2 == 1
    flag = F.concat(F.lit(',"flag":'), (F.col("value") > 20).cast("string"))
    meter = described(
        _uri(F.lit("meter"), F.concat(F.lit("2-0-"), (F.col("event_id") % 2).cast("string"))),
        F.concat(
            F.lit('{"reading":'),
            F.col("value").cast("string"),
            F.when(newer, flag).otherwise(F.lit("")),
            F.lit("}"),
        ),
    )
    count = F.col("event_id") % 3
    items = F.when(count == 1, session).when(count == 2, F.concat(session, F.lit(","), meter))
    listed = envelope("contexts", F.concat(F.lit("["), items, F.lit("]")))
    return F.coalesce(listed, F.lit(""))


def lines_of(
    source: DataFrame, unstruct: Column | None = None, contexts: Column | None = None
) -> DataFrame:
    """``value`` lines of the events, plus the time each was written."""
    line = F.concat_ws(
        "\t",
        F.col("event_id").cast("string"),
        F.col("ts").cast("string"),
        F.lit(""),
        F.col("event_type"),
        F.col("user_id").cast("string"),
        F.col("value").cast("string"),
        own_event() if unstruct is None else unstruct,
        own_contexts() if contexts is None else contexts,
    )
    malformed = F.concat(F.lit("nonsense"), F.col("event_id").cast("string"))
    value = F.when(F.col("event_id") % 47 == 7, malformed).otherwise(line)
    return source.select(value.alias("value"), utc(F.col("ts")).alias("written"))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(spread_table(spark, sf_dir, "events"))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lines(raw_lines(spark, sf_dir), layout())


_OBJECT = '{"type":"object","properties":{%s},"required":[%s]}'
_EVENT_BASE = _OBJECT % ('"k":{"type":"integer"}', '"k"')
_EVENT_NEXT = _OBJECT % ('"k":{"type":"integer"},"note":{"type":"string"}', '"k","note"')
_EVENT_BREAK = _OBJECT % ('"k":{"type":"string"},"note":{"type":"string"}', '"k","note"')
_SESSION = _OBJECT % ('"user":{"type":"integer","minimum":0,"maximum":2147483647}', '"user"')
_READING = '"reading":{"type":"number","multipleOf":0.01,"minimum":0,"maximum":1000000}'
_METER_BASE = _OBJECT % (_READING, '"reading"')
_METER_NEXT = _OBJECT % (f'{_READING},"flag":{{"type":"boolean"}}', '"reading"')


def registry_row(name: Column, version: tuple[int, int, int], schema_json: Column) -> Column:
    return F.struct(
        F.lit(VENDOR).alias("vendor"),
        name.alias("name"),
        *[
            F.lit(number).alias(part)
            for part, number in zip(("model", "revision", "addition"), version, strict=True)
        ],
        schema_json.alias("schema_json"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions for each event type that occurs, and the context schemas."""
    types = events(spark, sf_dir).select("event_type").distinct()
    name = F.col("event_type")
    newer = F.when(name == "error", F.lit(_EVENT_BREAK)).otherwise(F.lit(_EVENT_NEXT))
    rows = [
        registry_row(name, (1, 0, 0), F.lit(_EVENT_BASE)),
        registry_row(name, (1, 0, 1), newer),
    ]
    contexts = [
        registry_row(F.lit("session"), (1, 0, 0), F.lit(_SESSION)),
        registry_row(F.lit("meter"), (2, 0, 0), F.lit(_METER_BASE)),
        registry_row(F.lit("meter"), (2, 0, 1), F.lit(_METER_NEXT)),
    ]
    own = types.select(F.inline(F.array(*rows)))
    shared = types.agg(F.count("*")).select(F.inline(F.array(*contexts)))
    return own.union(shared)


def kept_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry as a small table: a load looks it up in every batch, which would scan all events each time."""
    path = scratch_folder(spark, "registry")
    registry(spark, sf_dir).coalesce(1).write.parquet(path)
    return spark.read.schema(REGISTRY_SCHEMA).parquet(path)
