"""Batches closed by size or delay, and their sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.batching import BATCH, assign_batches, combine_batches, earliest_parsed
from landfall.operators.closing import assign_batches_exact
from landfall.operators.metrics import batches_to_write
from landfall.operators.parse import parse_lines
from landfall.queries import inputs
from landfall.queries.catalog import query
from landfall.queries.entities import options, transformed
from landfall.queries.inputs import SQL_ADDITION, SQL_CONTEXTS, SQL_GOOD, SQL_GOOD_LINE
from landfall.queries.lines import SQL_LINE

_MAX_BYTES = 64
_DELAY_SECONDS = 6 * 3600

_SQL_BUCKET = f"CAST(floor(epoch_us(ts) / {_DELAY_SECONDS}000000) AS BIGINT)"
_SQL_ASSIGNED = f"""SELECT event_id, event_type AS source, {_SQL_BUCKET} AS delay_bucket,
  CAST(floor((sum(strlen(props)) OVER (PARTITION BY event_type, {_SQL_BUCKET}
    ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - strlen(props)) / {_MAX_BYTES}) AS BIGINT)
    AS batch_seq FROM events"""


#: The sequential fold, one chunk of each source a step.
_SQL_FOLDED = f"""WITH RECURSIVE chunks AS (
  SELECT event_id, event_type AS source, epoch_us(ts) AS instant, strlen(props) AS weight,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS place FROM events),
folded AS (
  SELECT event_id, source, place, instant AS since, weight AS held, CAST(0 AS BIGINT) AS batch_seq
  FROM chunks WHERE place = 1
  UNION ALL
  SELECT c.event_id, c.source, c.place,
    CASE WHEN held >= {_MAX_BYTES} OR c.instant - since >= {_DELAY_SECONDS}000000 THEN c.instant ELSE since END,
    CASE WHEN held >= {_MAX_BYTES} OR c.instant - since >= {_DELAY_SECONDS}000000 THEN 0 ELSE held END + c.weight,
    batch_seq + CASE WHEN held >= {_MAX_BYTES} OR c.instant - since >= {_DELAY_SECONDS}000000 THEN 1 ELSE 0 END
  FROM folded f JOIN chunks c ON c.source = f.source AND c.place = f.place + 1)
SELECT event_id, source, batch_seq FROM folded"""


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.events(spark, sf_dir).select(
        "event_id",
        "event_type",
        inputs.utc(F.col("ts")).alias("ts"),
        F.octet_length("props").alias("weight"),
    )


def _assigned(spark: SparkSession, sf_dir: str, **limits) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    return assign_batches(
        chunks, "event_type", "ts", "event_id", "weight", _MAX_BYTES, _DELAY_SECONDS, **limits
    ).select("event_id", *BATCH)


@query("batch_assign_exact", _SQL_FOLDED)
def batch_assign_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch counts anew from the chunk that opens it."""
    assigned = assign_batches_exact(
        _chunks(spark, sf_dir), "event_type", "ts", "event_id", "weight", _MAX_BYTES, _DELAY_SECONDS
    )
    return assigned.select("event_id", "source", "batch_seq")


@query("batch_assign", _SQL_ASSIGNED)
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir)


@query("batch_assign_split", _SQL_ASSIGNED)
def batch_assign_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with groups too large for one task: summed range by range."""
    return _assigned(spark, sf_dir, pieces=16)


def _bucketed(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    """Parsed events with the time bucket they arrived in; every line has one."""
    lines = inputs.raw_lines(spark, sf_dir)
    bucket = F.floor(F.unix_micros("written") / F.lit(seconds * 1_000_000)).cast("long")
    return parse_lines(lines.withColumn("bucket", bucket), inputs.layout(), keep=("bucket",))


@query(
    "batch_bytes",
    f"""SELECT CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS bucket, count(*) AS lines,
    CAST(sum(strlen({SQL_LINE})) AS BIGINT) AS bytes FROM events GROUP BY 1""",
)
def batch_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte weight of the lines of each hour."""
    parsed = _bucketed(spark, sf_dir, 3600)
    return parsed.groupBy("bucket").agg(
        F.count("*").alias("lines"), F.sum("_bytes").alias("bytes")
    )


@query(
    "batch_combine",
    f"""SELECT CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS bucket,
    count(*) FILTER ({SQL_GOOD_LINE}) AS parsed, count(*) FILTER (NOT ({SQL_GOOD_LINE})) AS failed,
    CAST(sum(strlen({SQL_LINE})) AS BIGINT) AS bytes,
    min((epoch_us(ts) // 1000)) FILTER ({SQL_GOOD_LINE}) AS earliest_millis,
    CAST(count(DISTINCT CASE WHEN {SQL_GOOD_LINE} THEN event_type || ({SQL_ADDITION}) END)
      + count(DISTINCT CASE WHEN {SQL_GOOD_LINE} AND {SQL_CONTEXTS} > 0 THEN 1 END)
      + count(DISTINCT CASE WHEN {SQL_GOOD_LINE} AND {SQL_CONTEXTS} = 2 THEN {SQL_ADDITION} END)
      AS BIGINT) AS versions
    FROM events GROUP BY 1""",
)
def batch_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    combined = combine_batches(_bucketed(spark, sf_dir, 3600), ["bucket"], "collector_tstamp")
    return combined.select(
        "bucket",
        "parsed",
        "failed",
        "bytes",
        F.unix_millis("earliest").alias("earliest_millis"),
        F.size("entities").cast("long").alias("versions"),
    )


@query(
    "batch_earliest",
    f"""SELECT CAST(floor(epoch_us(ts) / 600000000) AS BIGINT) AS bucket,
    min((epoch_us(ts) // 1000)) FILTER ({SQL_GOOD_LINE}) AS earliest_millis FROM events GROUP BY 1""",
)
def batch_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL for a bucket in which nothing parsed."""
    earliest = earliest_parsed(_bucketed(spark, sf_dir, 600), ["bucket"], "collector_tstamp")
    return earliest.select("bucket", F.unix_millis("earliest").alias("earliest_millis"))


@query(
    "skip_empty_batches",
    f"""SELECT CAST(floor(epoch_us(ts) / 600000000) AS BIGINT) AS bucket,
    count(*) FILTER ({SQL_GOOD}) AS events_good, count(*) FILTER (NOT ({SQL_GOOD})) AS events_bad,
    count(*) FILTER ({SQL_GOOD}) > 0 AS written FROM events GROUP BY 1""",
)
def skip_empty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _bucketed(spark, sf_dir, 600)
    events, _ = transformed(parsed, inputs.registry(spark, sf_dir), options(), keep=("bucket",))
    return batches_to_write(events, ["bucket"])
