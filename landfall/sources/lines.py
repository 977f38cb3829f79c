"""Event lines from any installed Spark source, with the start position and batch limits."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Line sources are read as one column; message brokers call it ``value`` as well.
LINE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])

EARLIEST, LATEST = "earliest", "latest"
_PLACE = "_place"
_FILE_FORMATS = {"text", "parquet", "orc", "json", "csv"}
# Splits for each core from which a source is left as it is.
_SPLITS_PER_CORE = 4


def stream_lines(
    spark: SparkSession,
    kind: str,
    options: dict[str, str],
    path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """A stream of lines. File formats need a path, and all but text need a schema."""
    reader = spark.readStream.format(kind).options(**options)
    if kind in _FILE_FORMATS and kind != "text":
        reader = reader.schema(schema or LINE_SCHEMA)
    return reader.load(path) if path else reader.load()


def kafka_source(
    topic: str,
    servers: str,
    start: str | datetime = LATEST,
    consumer: dict[str, str] | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source. ``start`` holds for the first run only."""
    options = {"subscribe": topic, "kafka.bootstrap.servers": servers, **start_position(start)}
    options |= {f"kafka.{key}": value for key, value in (consumer or {}).items()}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def kafka_sink(topic: str, servers: str, producer: dict[str, str] | None = None) -> dict[str, str]:
    options = {"topic": topic, "kafka.bootstrap.servers": servers}
    return options | {f"kafka.{key}": value for key, value in (producer or {}).items()}


def start_position(start: str | datetime) -> dict[str, str]:
    """Earliest, latest, or a point in time. A checkpoint takes precedence on later runs."""
    if isinstance(start, datetime):
        if start.tzinfo is None:
            raise ValueError("the start time needs a time zone")
        return {
            "startingTimestamp": str(int(start.timestamp() * 1000)),
            "startingOffsetsByTimestampStrategy": LATEST,
        }
    if start not in (EARLIEST, LATEST):
        raise ValueError(f"start must be {EARLIEST}, {LATEST} or a time, not {start}")
    return {"startingOffsets": start}


def start_at(lines: DataFrame, written: str, start: Column) -> DataFrame:
    """Lines written at or after a time, for sources without a start option of their own."""
    return lines.where(F.col(written) >= start)


def batch_limits(max_bytes: int = 16_000_000, mean_line_bytes: int | None = None) -> dict[str, str]:
    """Source options that close a batch by size: bytes for files, offsets for Kafka."""
    if mean_line_bytes is None:
        return {"maxBytesPerTrigger": str(max_bytes)}
    return {"maxOffsetsPerTrigger": str(max(1, max_bytes // mean_line_bytes))}


def delay_trigger(max_delay_seconds: float = 1.0) -> dict[str, str]:
    """Trigger arguments that close a batch by time."""
    return {"processingTime": f"{int(max_delay_seconds * 1000)} milliseconds"}


def spread(rows: DataFrame, stable_order: bool = False) -> DataFrame:
    """Deal the rows of a source with few splits out over all cores.

    Parsing is the costly step, and a batch that arrives in one file would run on one
    core. Spark cuts a file into a split for each core, whether or not it can be cut: a row group
    is read whole by one of them, and the others find nothing. So a split for each core says little,
    and such a source is dealt out as well, into several shares for each core. Only a source
    with that many splits is left as it is, without a shuffle; give the source before any
    shuffle of its own, since counting its splits would run that.

    Rows are dealt in turn, so equal rows spread as well as others. Spark sorts them first,
    lest a retried task deal them differently; ``stable_order`` says that a re-read gives
    the same rows in the same order, as a bare file scan does, and spares the sort.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    splits = rows.rdd.getNumPartitions()
    if splits >= _SPLITS_PER_CORE * cores:
        return rows
    shares = cores if splits < cores else _SPLITS_PER_CORE * cores
    if not stable_order:
        return rows.repartition(shares)
    placed = rows.withColumn(_PLACE, F.monotonically_increasing_id())
    return placed.repartition(shares, _PLACE).drop(_PLACE)
