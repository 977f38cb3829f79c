"""Lines, parsing, typed values, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import normalized
from landfall.functions.strict_json import read_parts, strict_error, strict_value
from landfall.operators.parse import failed_rows, good_rows
from landfall.options import Processor
from landfall.plans.field_types import planned_type
from landfall.queries import inputs
from landfall.queries.catalog import query
from landfall.queries.inputs import (
    SQL_ADDITION,
    SQL_CONTEXTS,
    SQL_GOOD_LINE,
    SQL_K,
    SQL_MALFORMED,
    SQL_WRONG_TYPE,
)

PROCESSOR = Processor("landfall-check", "1.2.3")

_SQL_QUOTED_K = (
    f"CASE WHEN (event_type = 'error' AND {SQL_ADDITION} = 1) <> ({SQL_WRONG_TYPE}) "
    f"THEN '\"' || {SQL_K} || '\"' ELSE {SQL_K} END"
)
_SQL_UNSTRUCT = f"""
  '{{"schema":"sd:acme.test/unstruct/jsonschema/1-0-0","data":{{"schema":"sd:acme.test/'
  || event_type || '/jsonschema/1-0-' || ({SQL_ADDITION}) || '","data":{{"k":' || {_SQL_QUOTED_K}
  || CASE WHEN {SQL_ADDITION} = 1 THEN ',"note":"' || event_type || '-' || user_id || '"' ELSE '' END
  || '}}}}}}'"""
_SQL_SESSION = """'{"schema":"sd:acme.test/session/jsonschema/1-0-0","data":{"user":' || user_id || '}}'"""
_SQL_METER = f"""'{{"schema":"sd:acme.test/meter/jsonschema/2-0-' || ({SQL_ADDITION})
  || '","data":{{"reading":' || value
  || CASE WHEN {SQL_ADDITION} = 1 THEN ',"flag":' || (value > 20) ELSE '' END || '}}}}'"""
_SQL_CONTEXTS_TEXT = f"""CASE {SQL_CONTEXTS} WHEN 0 THEN '' ELSE
  '{{"schema":"sd:acme.test/contexts/jsonschema/1-0-0","data":[' || {_SQL_SESSION}
  || CASE {SQL_CONTEXTS} WHEN 2 THEN ',' || {_SQL_METER} ELSE '' END || ']}}' END"""
SQL_LINE = f"""CASE WHEN {SQL_MALFORMED} THEN 'nonsense' || event_id ELSE
  event_id || chr(9) || ts || chr(9) || chr(9) || event_type || chr(9) || user_id || chr(9)
  || value || chr(9) || {_SQL_UNSTRUCT} || chr(9) || {_SQL_CONTEXTS_TEXT} END"""


@query("raw_lines", f"SELECT {SQL_LINE} AS line FROM events")
def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.raw_lines(spark, sf_dir).select(F.col("value").alias("line"))


@query(
    "parse_good",
    f"""SELECT event_id, (epoch_us(ts) // 1000) AS collector_millis, event_type AS event_name, user_id, value
    FROM events WHERE {SQL_GOOD_LINE}""",
)
def parse_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_rows(inputs.parsed_events(spark, sf_dir)).select(
        "event_id",
        F.unix_millis("collector_tstamp").alias("collector_millis"),
        "event_name",
        "user_id",
        "value",
    )


@query(
    "parse_failures",
    f"""SELECT 'landfall-check' AS processor_name, '1.2.3' AS processor_version,
    'expected 8 fields, found 1' AS failure, 'nonsense' || event_id AS payload
    FROM events WHERE {SQL_MALFORMED}""",
)
def parse_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_rows(inputs.parsed_events(spark, sf_dir), PROCESSOR)


@query(
    "parse_summary",
    """SELECT event_type AS event_name, count(*) AS events, min((epoch_us(ts) // 1000)) AS earliest_millis
    FROM events WHERE event_id % 47 <> 7 GROUP BY event_type""",
)
def parse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good events and the earliest of them by event name."""
    good = good_rows(inputs.parsed_events(spark, sf_dir))
    return good.groupBy("event_name").agg(
        F.count("*").alias("events"),
        F.unix_millis(F.min("collector_tstamp")).alias("earliest_millis"),
    )


_LINE_ITEM = """{"type":"object","properties":{
  "orderkey":{"type":"integer"},
  "linenumber":{"type":"integer","minimum":0,"maximum":1000},
  "quantity":{"type":"number"},
  "returnflag":{"type":"string"},
  "isOpen":{"type":"boolean"},
  "shipDate":{"type":"string","format":"date"},
  "tags":{"type":"array","items":{"type":"string"}}
 },"required":["orderkey","quantity"]}"""


def _cast(json: DataFrame, kind: T.DataType, name: str) -> DataFrame:
    """The typed value of column ``json`` as column ``name``, and why it does not fit."""
    read = json.selectExpr("*", f"{read_parts('json', kind)} AS parts")
    return read.selectExpr(
        *[c for c in json.columns if c != "json"],
        f"{strict_value('json', kind, parts='parts')} AS {name}",
        f"{strict_error('json', kind, name, parts='parts')} AS failure",
    )


@query(
    "cast_scalars",
    """SELECT l_orderkey AS orderkey, CAST(l_linenumber AS INTEGER) AS linenumber,
    CASE WHEN l_linenumber <> 7 THEN l_quantity END AS quantity, l_returnflag AS returnflag,
    l_linestatus = 'O' AS is_open, strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
    l_returnflag || ',' || l_linestatus AS tags,
    CASE WHEN l_linenumber = 7 THEN 'item.quantity: expected double' END AS failure
    FROM lineitem""",
)
def cast_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalars and arrays; line number 7 has its quantity as text, which must not pass."""
    items = inputs.spread_table(spark, sf_dir, "lineitem")
    is_open = F.col("l_linestatus") == "O"
    day = F.substr(F.col("l_shipdate").cast("string"), F.lit(1), F.lit(10))
    tags = F.array("l_returnflag", "l_linestatus")

    def document(quantity: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("l_orderkey").alias("orderkey"),
                F.col("l_linenumber").alias("linenumber"),
                quantity.alias("quantity"),
                F.col("l_returnflag").alias("returnflag"),
                is_open.alias("isOpen"),
                day.alias("shipDate"),
                tags.alias("tags"),
            )
        )

    quantity = F.col("l_quantity")
    text = F.when(F.col("l_linenumber") == 7, document(quantity.cast("string")))
    kind = planned_type(_LINE_ITEM)
    json = items.select(F.try_parse_json(F.coalesce(text, document(quantity))).alias("json"))
    cast = _cast(json, kind, "item")
    quantity_ok = F.when(F.col("failure").isNull(), F.col("item.quantity"))
    return cast.select(
        "item.orderkey",
        "item.linenumber",
        quantity_ok.alias("quantity"),
        "item.returnflag",
        "item.is_open",
        F.col("item.ship_date").cast("string").alias("ship_date"),
        F.array_join("item.tags", ",").alias("tags"),
        "failure",
    )


def _decimal_schema(name: str, maximum: str) -> str:
    return (
        f'"{name}":{{"type":"number","multipleOf":0.01,"minimum":-{maximum},"maximum":{maximum}}}'
    )


_DECIMALS = '{"type":"object","properties":{%s}}' % ",".join(
    [
        _decimal_schema("small", "9999999"),
        _decimal_schema("medium", "1e15"),
        _decimal_schema("large", "1e30"),
        '"coarse":{"type":"number","multipleOf":0.1,"minimum":0,"maximum":99999999}',
    ]
)


@query(
    "cast_decimals",
    """SELECT l_orderkey, l_linenumber,
    CAST(CAST(l_extendedprice AS DECIMAL(9,2)) AS VARCHAR) AS small,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS medium,
    CAST(CAST(-l_extendedprice AS DECIMAL(38,2)) AS VARCHAR) AS large,
    CASE WHEN CAST(round(l_extendedprice * 100) AS BIGINT) % 10 <> 0
      THEN 'price.coarse: expected decimal' END AS failure
    FROM lineitem""",
)
def cast_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three precisions; a price with two decimals does not fit the one-decimal field."""
    items = inputs.spread_table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    text = F.to_json(
        F.struct(
            price.alias("small"),
            price.alias("medium"),
            (-price).alias("large"),
            price.alias("coarse"),
        )
    )
    kind = planned_type(_DECIMALS)
    json = items.select("l_orderkey", "l_linenumber", F.try_parse_json(text).alias("json"))
    cast = _cast(json, kind, "price")
    return cast.select(
        "l_orderkey",
        "l_linenumber",
        *[F.col(f"price.{c}").cast("string").alias(c) for c in ("small", "medium", "large")],
        "failure",
    )


_TIMES = """{"type":"object","properties":{
  "placed":{"type":"string","format":"date-time"},
  "shifted":{"type":"string","format":"date-time"},
  "day":{"type":"string","format":"date"}}}"""


@query(
    "cast_timestamps",
    """SELECT o_orderkey, epoch_ms(o_orderdate) + 123 AS placed_millis,
    epoch_ms(o_orderdate) - 7200000 AS shifted_millis,
    strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def cast_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits below the millisecond are dropped; offsets count; days are days."""
    orders = inputs.spread_table(spark, sf_dir, "orders")
    day = F.substr(F.col("o_orderdate").cast("string"), F.lit(1), F.lit(10))
    text = F.to_json(
        F.struct(
            F.concat(day, F.lit("T00:00:00.123987Z")).alias("placed"),
            F.concat(day, F.lit("T00:00:00+02:00")).alias("shifted"),
            day.alias("day"),
        )
    )
    json = orders.select("o_orderkey", F.try_parse_json(text).alias("json"))
    return _cast(json, planned_type(_TIMES), "t").select(
        "o_orderkey",
        F.unix_millis("t.placed").alias("placed_millis"),
        F.unix_millis("t.shifted").alias("shifted_millis"),
        F.col("t.day").cast("string").alias("day"),
    )


def _sql_normalized(text: str) -> str:
    return (
        f"lower(regexp_replace(regexp_replace(regexp_replace({text}, '([a-z0-9])([A-Z])', "
        r"'\1_\2', 'g'), '([A-Z]+)([A-Z][a-z])', '\1_\2', 'g'), '[^A-Za-z0-9_]', '_', 'g'))"
    )


@query(
    "normalize_names",
    f"""SELECT p_partkey, {_sql_normalized("p_brand")} AS brand,
    {_sql_normalized("p_type || '.' || p_name")} AS full_name FROM part""",
)
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "part").select(
        "p_partkey",
        normalized(F.col("p_brand")).alias("brand"),
        normalized(F.concat_ws(".", "p_type", "p_name")).alias("full_name"),
    )
