"""Latencies, the period report, attempt classes, over logs derived from the events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators import metrics
from landfall.queries import inputs
from landfall.queries.catalog import query

# One batch per event type and hour, loaded 2.5 s after its last event. Events of type
# ``signup`` never parse, so their batches have no earliest time.
_SQL_LOG = """SELECT event_type, max((epoch_us(ts) // 1000)) + 2500 AS loaded_ms,
    count(*) FILTER (event_type <> 'signup') AS good,
    count(*) FILTER (event_type = 'signup') AS bad,
    min((epoch_us(ts) // 1000)) FILTER (event_type <> 'signup') AS earliest_ms
    FROM events GROUP BY event_type, (epoch_us(ts) // 1000) // 3600000"""

_SQL_LATENCY = "CAST(round(value * 1000) AS BIGINT)"

# Each event stands for a load attempt; ``k`` of its properties picks how it went.
_SQL_OUTCOME = "CAST(json_extract_string(props, '$.k') AS BIGINT) % 5"
_SQL_SETUP = f"({_SQL_OUTCOME} IN (2, 3))"
_SQL_TRANSIENT = f"({_SQL_OUTCOME} IN (1, 4))"


def _batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.events(spark, sf_dir).withColumn("ts", inputs.utc(F.col("ts")))
    hour = F.floor(F.unix_millis("ts") / F.lit(3_600_000)).alias("hour")
    good = F.col("event_type") != "signup"
    return events.groupBy("event_type", hour).agg(
        F.timestamp_millis(F.unix_millis(F.max("ts")) + 2500).alias("loaded_at"),
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("bad"),
        F.min(F.when(good, F.col("ts"))).alias("earliest"),
    )


def _received(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event is processed ``value`` seconds after it came in."""
    ingested = inputs.utc(F.col("ts"))
    wait = F.round(F.col("value") * 1000).cast("long")
    return inputs.events(spark, sf_dir).select(
        "event_type",
        ingested.alias("ingested_at"),
        F.timestamp_millis(F.unix_millis(ingested) + wait).alias("processed_at"),
    )


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = F.get_json_object("props", "$.k").cast("int") % 5
    chain = (
        F.when(outcome == 1, F.array(F.lit("Timeout")))
        .when(outcome == 2, F.array(F.lit("LoadFailed"), F.lit("Unauthenticated")))
        .when(outcome == 3, F.array(F.lit("NotFound")))
        .when(outcome == 4, F.array(F.lit("LoadFailed"), F.lit("ServerError")))
    )
    return inputs.events(spark, sf_dir).select(
        "event_type",
        inputs.utc(F.col("ts")).alias("attempted_at"),
        F.lit(0).alias("attempt"),
        chain.alias("error_chain"),
    )


@query(
    "e2e_latency",
    f"""SELECT event_type, max(loaded_ms - earliest_ms) AS e2e_latency_millis
    FROM ({_SQL_LOG}) WHERE earliest_ms IS NOT NULL GROUP BY event_type""",
)
def e2e_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.e2e_latency(_batch_log(spark, sf_dir), ("event_type",))


@query(
    "stream_latency",
    f"""SELECT event_type, greatest(max({_SQL_LATENCY}), 0) AS latency_millis
    FROM events GROUP BY event_type""",
)
def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.stream_latency(_received(spark, sf_dir), ("event_type",))


@query(
    "metrics_report",
    f"""WITH log AS (SELECT loaded_ms // 60000 * 60000 AS p, sum(good) AS good, sum(bad) AS bad,
        max(loaded_ms - earliest_ms) AS e2e FROM ({_SQL_LOG}) GROUP BY 1),
      received AS (SELECT ((epoch_us(ts) // 1000) + {_SQL_LATENCY}) // 60000 * 60000 AS p,
        max({_SQL_LATENCY}) AS latency FROM events GROUP BY 1),
      attempts AS (SELECT (epoch_us(ts) // 1000) // 60000 * 60000 AS p,
        count(*) FILTER ({_SQL_TRANSIENT}) AS transient, count(*) FILTER ({_SQL_SETUP}) AS setup
        FROM events GROUP BY 1),
      periods AS (SELECT p FROM log UNION SELECT p FROM received UNION SELECT p FROM attempts),
      wide AS (SELECT * FROM periods LEFT JOIN log USING (p) LEFT JOIN received USING (p)
        LEFT JOIN attempts USING (p))
    SELECT p AS period_millis, key, CAST(value AS BIGINT) AS value, type FROM (
      SELECT p, 'events_good' AS key, coalesce(good, 0) AS value, 'count' AS type FROM wide
      UNION ALL SELECT p, 'events_bad', coalesce(bad, 0), 'count' FROM wide
      UNION ALL SELECT p, 'latency_millis', coalesce(latency, 0), 'gauge' FROM wide
      UNION ALL SELECT p, 'e2e_latency_millis', e2e, 'gauge' FROM wide WHERE e2e IS NOT NULL
      UNION ALL SELECT p, 'load_errors', transient, 'count' FROM wide WHERE transient > 0
      UNION ALL SELECT p, 'setup_errors', setup, 'count' FROM wide WHERE setup > 0)""",
)
def metrics_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.metrics_report(
        _batch_log(spark, sf_dir), _received(spark, sf_dir), _attempts(spark, sf_dir)
    )
    return report.select(
        F.unix_millis("period_start").alias("period_millis"), "key", "value", "type"
    )


@query(
    "metrics_idle_periods",
    f"""WITH log AS (SELECT loaded_ms // 3600000 * 3600000 AS p, sum(good) AS good, sum(bad) AS bad,
        max(loaded_ms - earliest_ms) AS e2e FROM ({_SQL_LOG}) WHERE event_type = 'purchase' GROUP BY 1),
      spine AS (SELECT unnest(generate_series(min(p), max(p), 3600000)) AS p FROM log),
      wide AS (SELECT * FROM spine LEFT JOIN log USING (p))
    SELECT p AS period_millis, key, CAST(value AS BIGINT) AS value, type FROM (
      SELECT p, 'events_good' AS key, coalesce(good, 0) AS value, 'count' AS type FROM wide
      UNION ALL SELECT p, 'events_bad', coalesce(bad, 0), 'count' FROM wide
      UNION ALL SELECT p, 'latency_millis', 0, 'gauge' FROM wide
      UNION ALL SELECT p, 'e2e_latency_millis', e2e, 'gauge' FROM wide WHERE e2e IS NOT NULL)""",
)
def metrics_idle_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of one event type's loads by the hour, with the hours that had none."""
    log = _batch_log(spark, sf_dir).where("event_type = 'purchase'")
    none = F.lit(False)
    received, attempts = _received(spark, sf_dir).where(none), _attempts(spark, sf_dir).where(none)
    report = metrics.metrics_report(log, received, attempts, "1 hour", idle=True)
    return report.select(F.unix_millis("period_start").alias("period_millis"), "key", "value", "type")


@query(
    "attempt_classes",
    f"""SELECT event_type, CASE WHEN {_SQL_SETUP} THEN 'setup' ELSE 'transient' END AS error_class,
    count(*) AS attempts FROM events WHERE {_SQL_OUTCOME} > 0 GROUP BY 1, 2""",
)
def attempt_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.attempt_classes(_attempts(spark, sf_dir), ("event_type",))
