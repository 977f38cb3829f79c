"""The load as a stream: start position, resumption, same rows as a batch."""

from __future__ import annotations

from contextlib import suppress
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.functions.names import UNSTRUCT
from landfall.operators.metrics import attempt_class, stream_latency
from landfall.operators.table import CLUSTER_BY
from landfall.queries import inputs
from landfall.queries.catalog import query
from landfall.queries.inputs import SQL_ADDITION, SQL_CONTEXTS, SQL_GOOD, SQL_K
from landfall.queries.landing import load_options
from landfall.queries.lines import SQL_LINE
from landfall.sources.attempts import attempt_log
from landfall.sources.landing import LOAD_ATTEMPT, batch_folder, read_landing, write_batch
from landfall.sources.lines import LINE_SCHEMA, start_at, stream_lines
from landfall.sources.manifest import Manifest, read_committed, received_log
from landfall.sources.scratch import scratch_folder
from landfall.streaming.loader import Loader, MissingSchemas
from landfall.streaming.table import ingest, read_table

_START = datetime(2024, 1, 10, tzinfo=UTC)
_WRITTEN = T.StructType([*LINE_SCHEMA.fields, T.StructField("written", T.TimestampType())])


def _run(lines: DataFrame, folder: str, checkpoint: str) -> None:
    writer = lines.writeStream.format("parquet").option("path", folder)
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


@query("start_at_timestamp", f"SELECT {SQL_LINE} AS line FROM events WHERE ts >= '2024-01-10'")
def start_at_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run that starts at a point in time takes the lines written since."""
    base = scratch_folder(spark, "start-at")
    inputs.raw_lines(spark, sf_dir).write.parquet(f"{base}/source")
    lines = stream_lines(spark, "parquet", {}, f"{base}/source", _WRITTEN)
    start = F.timestamp_micros(F.lit(int(_START.timestamp() * 1_000_000)))
    _run(start_at(lines, "written", start).select("value"), f"{base}/out", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select(F.col("value").alias("line"))


@query("stream_resume", f"SELECT event_id, event_type AS event_name FROM events WHERE {SQL_GOOD}")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: each loads only what came since; the last finds nothing."""
    options = load_options(spark, "resume")
    base = scratch_folder(spark, "resume-source")
    registry = inputs.kept_registry(spark, sf_dir)
    source = inputs.events(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    arrivals = [source.where(early), source.where(~early), None]
    for i, arrival in enumerate(arrivals):
        if arrival is not None:
            inputs.lines_of(arrival).write.parquet(f"{base}/arrival={i}")
        lines = stream_lines(
            spark, "parquet", {"recursiveFileLookup": "true"}, base, LINE_SCHEMA
        )
        Loader(options, registry).run(lines, f"{base}-checkpoint").awaitTermination()
    return read_landing(spark, options.landing).select("event_id", "event_name")


@query(
    "stream_equals_batch",
    f"""SELECT event_id, (epoch_us(ts) // 1000) AS collector_millis, event_type AS event_name, user_id, value,
    CASE WHEN event_type = 'error' AND {SQL_ADDITION} = 1 THEN NULL
      ELSE CAST({SQL_K} AS BIGINT) END AS k,
    CASE WHEN event_type = 'error' AND {SQL_ADDITION} = 1 THEN {SQL_K} END AS recovered_k,
    CASE WHEN {SQL_CONTEXTS} = 2 THEN CAST(CAST(value AS DECIMAL(9,2)) AS VARCHAR) END AS reading
    FROM events WHERE {SQL_GOOD}""",
)
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole load as a stream of several micro-batches, each with its own columns."""
    options = load_options(spark, "stream")
    base = scratch_folder(spark, "stream-source")
    source = inputs.events(spark, sf_dir)
    # Separate arrivals by event type: no batch holds all schemas.
    errors = F.col("event_type") == "error"
    for i, part in enumerate((source.where(errors), source.where(~errors))):
        inputs.lines_of(part).select("value").write.parquet(f"{base}/arrival={i}")
    lines = stream_lines(
        spark,
        "parquet",
        {"recursiveFileLookup": "true", "maxFilesPerTrigger": "1"},
        base,
        LINE_SCHEMA,
    )
    loader = Loader(options, inputs.kept_registry(spark, sf_dir))
    loader.run(lines, f"{base}-checkpoint").awaitTermination()
    return flat_events(read_landing(spark, options.landing))


_ERRORS = "event_type = 'error'"


@query(
    "late_registration",
    f"""SELECT event_id, CASE WHEN {SQL_ADDITION} = 1 THEN {SQL_K} END AS k_text,
    CASE WHEN {SQL_ADDITION} = 0 THEN CAST({SQL_K} AS BIGINT) END AS k_number
    FROM events WHERE {SQL_GOOD} AND {_ERRORS}""",
)
def late_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older version is registered after a newer one has landed; the column keeps its type."""
    options = load_options(spark, "late")
    source = inputs.events(spark, sf_dir).where(_ERRORS)
    first = (F.col("event_id") % 2 == 1) & (F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz"))
    every = inputs.registry(spark, sf_dir)
    newer = every.where("NOT (name = 'error' AND addition = 0)")
    for i, (registry, part) in enumerate(((newer, first), (every, ~first))):
        Loader(options, registry).process(inputs.lines_of(source.where(part)), i)
    landed = read_committed(spark, options.manifest, options.landing)
    (main,) = [c for c in landed.columns if c.startswith(UNSTRUCT) and "_recovered_" not in c]
    (recovered,) = [c for c in landed.columns if c.startswith(f"{main}_recovered_1_0_0_")]
    return landed.select(
        "event_id", F.col(main).getField("k").alias("k_text"), F.col(recovered).getField("k").alias("k_number")
    )


@query(
    "committed_attempts",
    f"SELECT event_id, event_type AS event_name, 1 AS attempt FROM events WHERE {SQL_GOOD}",
)
def committed_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lost try left behind is neither overwritten by its retry nor seen by readers."""
    options = load_options(spark, "attempts")
    loader = Loader(options, inputs.kept_registry(spark, sf_dir))
    lost = Manifest(spark, options.manifest, loader.name).start(0)
    folder = batch_folder(options.landing, lost.load_tstamp, f"{loader.name}-0", lost.number)
    write_batch(inputs.events(spark, sf_dir).select("event_id"), folder)
    loader.process(inputs.raw_lines(spark, sf_dir), 0)
    landed = read_committed(spark, options.manifest, options.landing, partition_columns=True)
    return landed.select("event_id", "event_name", F.col(LOAD_ATTEMPT).cast("int").alias("attempt"))


@query(
    "table_of_committed",
    f"SELECT event_id, event_type AS event_name, 1 AS loads FROM events WHERE {SQL_GOOD}",
)
def table_of_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to landing to table, both as running streams; the table follows the batch log."""
    options = load_options(spark, "follow")
    base = scratch_folder(spark, "follow-source")
    source = inputs.events(spark, sf_dir)
    loader = Loader(options, inputs.kept_registry(spark, sf_dir))
    newer = F.col("event_id") % 2 == 1
    for i, part in enumerate((source.where(~newer), source.where(newer))):
        inputs.lines_of(part).select("value").write.parquet(f"{base}/arrival={i}")
        lines = stream_lines(spark, "parquet", {"recursiveFileLookup": "true"}, base, LINE_SCHEMA)
        loader.run(lines, f"{base}-checkpoint").awaitTermination()
        ingest(
            spark, options.landing, f"{base}-table", f"{base}-table-checkpoint", manifest=options.manifest, cluster_by=CLUSTER_BY
        ).awaitTermination()
    table = read_table(spark, f"{base}-table")
    return table.groupBy("event_id", "event_name").agg(F.count("*").cast("int").alias("loads"))


@query(
    "load_metrics",
    """SELECT 0 AS attempt, 'transient' AS error_class, CAST(NULL AS BIGINT) AS oldest_micros, false AS waited
    UNION ALL SELECT 1, NULL, min(epoch_us(ts)), true FROM events""",
)
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs that a load wrote itself: its first try lacks schemas, its second loads.

    The lines' source time goes through the load, so the log knows when the oldest line of the
    batch came in; the broken try is classed by its chain of causes.
    """
    options = load_options(spark, "measured", source_time="written")
    registry = inputs.kept_registry(spark, sf_dir)
    lines = inputs.raw_lines(spark, sf_dir)
    with suppress(MissingSchemas):
        Loader(options, registry.where("name <> 'session'")).process(lines, 0)
    Loader(options, registry).process(lines, 0)
    batch = ["query_id", "batch_id"]
    received = received_log(spark, options.manifest)
    waits = stream_latency(received, tuple(batch)).join(received, batch)
    tried = attempt_log(spark, options.manifest).withColumn("error_class", attempt_class())
    good = F.col("error_class").isNull()
    return tried.join(waits, batch, "left").select(
        "attempt",
        "error_class",
        F.when(good, F.unix_micros("ingested_at")).alias("oldest_micros"),
        (good & (F.col("latency_millis") > 0)).alias("waited"),
    )


def flat_events(landed: DataFrame) -> DataFrame:
    own = [c for c in landed.columns if c.startswith(f"{UNSTRUCT}_event_")]
    k = [F.col(c).getField("k") for c in own if "_recovered_" not in c]
    recovered = [F.col(c).getField("k") for c in own if "_recovered_" in c]
    reading = F.get("contexts_acme_test_meter_2", F.lit(0)).getField("reading")
    return landed.select(
        "event_id",
        F.unix_millis("collector_tstamp").alias("collector_millis"),
        "event_name",
        "user_id",
        "value",
        F.coalesce(*k).alias("k"),
        F.coalesce(*recovered).alias("recovered_k"),
        reading.cast("string").alias("reading"),
    )
