"""The landing folder, failed events, the batch log, the table over them."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.operators.parse import failed_rows, parse_lines
from landfall.operators.table import cluster, file_stats, read_between, with_load_tstamp
from landfall.options import CODECS, LoadOptions
from landfall.queries import inputs
from landfall.queries.catalog import query
from landfall.queries.inputs import SQL_GOOD
from landfall.queries.lines import PROCESSOR, SQL_LINE
from landfall.sources.failed import failed_json, read_failed, write_failed
from landfall.sources.landing import (
    LOAD_BATCH,
    LOAD_DATE,
    batch_folder,
    read_landing,
    write_batch,
    write_partitioned,
)
from landfall.sources.manifest import batch_log
from landfall.sources.scratch import scratch_folder
from landfall.streaming.loader import Loader
from landfall.streaming.table import ingest, read_table

LOAD_TIME = datetime(2024, 2, 29, 23, 59, 59, tzinfo=UTC)

_SQL_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


def _cents(price: str):
    return F.round(F.col(price) * 100).cast("long")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", inputs.utc(F.col("o_orderdate")))


def load_options(spark: SparkSession, purpose: str, **changes) -> LoadOptions:
    """Options that write below a new folder of the shared scratch space."""
    base = scratch_folder(spark, purpose)
    return LoadOptions(
        f"{base}/landing", f"{base}/failed", f"{base}/log", layout=inputs.layout(), **changes
    )


@query(
    "landing_roundtrip",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, {_SQL_CENTS} AS cents,
    epoch_us(o_orderdate) AS order_micros, o_orderpriority FROM orders""",
)
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_folder(spark, "roundtrip")
    write_batch(_orders(spark, sf_dir), batch_folder(landing, LOAD_TIME, "all"))
    return read_landing(spark, landing).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        _cents("o_totalprice").alias("cents"),
        F.unix_micros("o_orderdate").alias("order_micros"),
        "o_orderpriority",
    )


@query(
    "landing_codecs",
    f"""SELECT codec, count(*) AS orders, CAST(sum({_SQL_CENTS}) AS BIGINT) AS cents
    FROM orders, (VALUES ('snappy'), ('gzip'), ('zstd'), ('lz4_raw'), ('uncompressed')) AS c(codec)
    GROUP BY codec""",
)
def landing_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codec of each written file is read back from its name."""
    landing = scratch_folder(spark, "codecs")
    orders = _orders(spark, sf_dir)
    for codec in CODECS:
        write_batch(orders, batch_folder(landing, LOAD_TIME, codec), codec.upper())
    suffix = F.regexp_extract("_metadata.file_name", r"\.([a-z0-9_]+)\.parquet$", 1)
    # Spark names lz4_raw files with the shorter extension, and plain ones with none.
    codec = F.when(suffix.startswith("lz4"), "lz4_raw").when(suffix == "", "uncompressed")
    codec = codec.when(suffix == "gz", "gzip").otherwise(suffix)
    read = read_landing(spark, landing).select(codec.alias("codec"), _cents("o_totalprice").alias("c"))
    return read.groupBy("codec").agg(F.count("*").alias("orders"), F.sum("c").alias("cents"))


@query(
    "landing_partitions",
    """SELECT strftime(ts, '%Y-%m-%d') AS load_date, count(*) AS events,
    min(event_id) AS first_id, max(event_id) AS last_id FROM events GROUP BY 1""",
)
def landing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_folder(spark, "partitions")
    events = inputs.events(spark, sf_dir).withColumn("ts", inputs.utc(F.col("ts")))
    write_partitioned(events, landing, F.col("ts"))
    days = read_landing(spark, landing, partition_columns=True)
    return days.groupBy(F.col(LOAD_DATE).cast("string").alias("load_date")).agg(
        F.count("*").alias("events"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


@query(
    "landing_manifest",
    f"""SELECT event_id % 2 AS batch_id, CAST(0 AS INTEGER) AS attempt,
    count(*) FILTER ({SQL_GOOD}) AS good, count(*) FILTER (NOT ({SQL_GOOD})) AS bad,
    CAST(sum(strlen({SQL_LINE})) AS BIGINT) AS bytes,
    min((epoch_us(ts) // 1000)) FILTER (event_id % 47 <> 7) AS earliest_millis,
    count(*) FILTER ({SQL_GOOD}) AS landed FROM events GROUP BY event_id % 2""",
)
def landing_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, one of them delivered twice; the second delivery changes nothing."""
    options = load_options(spark, "manifest")
    loader = Loader(options, inputs.kept_registry(spark, sf_dir))
    source = inputs.events(spark, sf_dir)
    for batch_id in (0, 1, 0):
        loader.process(inputs.lines_of(source.where(F.col("event_id") % 2 == batch_id)), batch_id)
    rows = read_landing(spark, options.landing, partition_columns=True)
    landed = rows.groupBy(LOAD_BATCH).agg(F.count("*").alias("landed"))
    log = batch_log(spark, options.manifest).select(
        "batch_id",
        "attempt",
        "good",
        "bad",
        "bytes",
        F.unix_millis("earliest").alias("earliest_millis"),
        F.concat_ws("-", "query_id", "batch_id").alias(LOAD_BATCH),
    )
    return log.join(landed, LOAD_BATCH, "left").drop(LOAD_BATCH)


@query(
    "seed_empty",
    f"""SELECT event_id, (epoch_us(ts) // 1000) AS collector_millis, CAST(NULL AS BIGINT) AS etl_millis,
    event_type AS event_name FROM events WHERE {SQL_GOOD}""",
)
def seed_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty first file gives the table its fixed columns and adds no rows."""
    options = load_options(spark, "seed")
    loader = Loader(options, inputs.registry(spark, sf_dir))
    loader.seed(LOAD_TIME)
    loader.process(inputs.raw_lines(spark, sf_dir), 0)
    return read_landing(spark, options.landing).select(
        "event_id",
        F.unix_millis("collector_tstamp").alias("collector_millis"),
        F.unix_millis("etl_tstamp").alias("etl_millis"),
        "event_name",
    )


@query(
    "failed_events",
    f"""SELECT 'landfall' AS processor_name,
    CASE WHEN event_id % 47 = 7 THEN 'expected 8 fields, found 1' ELSE 'wrong type' END AS failure,
    {SQL_LINE} AS payload FROM events WHERE NOT ({SQL_GOOD})""",
)
def failed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of failure reach the failed sink with their whole line."""
    options = load_options(spark, "failed")
    Loader(options, inputs.registry(spark, sf_dir)).process(inputs.raw_lines(spark, sf_dir), 0)
    failure = F.when(F.col("failure").contains(": expected"), "wrong type")
    return read_failed(spark, options.failed).select(
        "processor_name", F.coalesce(failure, "failure").alias("failure"), "payload"
    )


_CAP = 2000
_SQL_FAILURE = (
    "'expected 8 fields, found ' || (length(text) - length(replace(text, chr(9), '')) + 1)"
)
# Size of the failed event: its text as JSON, the reason, and the fixed parts around them.
_SQL_SIZE = (
    f"(strlen(CAST(to_json(text) AS VARCHAR)) + strlen({_SQL_FAILURE})"
    " + strlen('{\"processor_name\":\"landfall-check\",\"processor_version\":\"1.2.3\",\"failure\":\"\",\"payload\":}'))"
)


@query(
    "failed_documents",
    f"""SELECT {_SQL_FAILURE} AS failure, md5(text) AS payload_md5, length(text) AS payload_chars
    FROM documents""",
)
def failed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as lines: none is an event, and each survives as a payload."""
    failed = _failed_documents(spark, sf_dir, 9_000_000)
    return failed.select(
        "failure",
        F.md5("payload").alias("payload_md5"),
        F.length("payload").cast("long").alias("payload_chars"),
    )


@query(
    "failed_size_cap",
    f"""SELECT CASE WHEN {_SQL_SIZE} > {_CAP}
      THEN 'size violation: ' || {_SQL_SIZE} || ' bytes exceed {_CAP}' ELSE {_SQL_FAILURE} END AS failure,
    md5(CASE WHEN {_SQL_SIZE} > {_CAP} THEN substr(text, 1, {_CAP // 10}) ELSE text END) AS payload_md5
    FROM documents""",
)
def failed_size_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _failed_documents(spark, sf_dir, _CAP)
    return failed.select("failure", F.md5("payload").alias("payload_md5"))


def _failed_documents(spark: SparkSession, sf_dir: str, max_bytes: int) -> DataFrame:
    folder = scratch_folder(spark, "failed-documents")
    documents = inputs.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    failed = failed_rows(parse_lines(documents, inputs.layout()), PROCESSOR)
    write_failed(failed_json(failed, max_bytes), folder, "documents")
    return read_failed(spark, folder)


def _two_schemas(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Finished orders under an older schema without priority, the others under a newer one."""
    orders = _orders(spark, sf_dir)
    finished = F.col("o_orderstatus") == "F"
    return [orders.where(finished).drop("o_orderpriority"), orders.where(~finished)]


_SQL_EVOLVED = """SELECT o_orderkey, o_orderstatus,
    CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders"""


@query("evolved_table", _SQL_EVOLVED)
def evolved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_folder(spark, "evolved")
    for i, batch in enumerate(_two_schemas(spark, sf_dir)):
        write_batch(batch, batch_folder(landing, LOAD_TIME, str(i)))
    return read_landing(spark, landing).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("ingested_table", _SQL_EVOLVED)
def ingested_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running table stream takes up a column that appears in a later file, and no file twice."""
    base = scratch_folder(spark, "ingested")
    landing = f"{base}/landing"
    older, newer = _two_schemas(spark, sf_dir)
    write_batch(older, batch_folder(landing, LOAD_TIME, "0"))
    stream = ingest(spark, landing, f"{base}/table", f"{base}/checkpoint", processingTime="0 seconds")
    try:
        stream.processAllAvailable()
        write_batch(newer, batch_folder(landing, LOAD_TIME, "1"))
        stream.processAllAvailable()
    finally:
        stream.stop()
    return read_table(spark, f"{base}/table").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )


@query(
    "with_load_tstamp",
    "SELECT o_orderkey, o_custkey, 1700000000000 AS load_millis FROM orders",
)
def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.timestamp_millis(F.lit(1700000000000))
    orders = with_load_tstamp(_orders(spark, sf_dir), now)
    return orders.select("o_orderkey", "o_custkey", F.unix_millis("load_tstamp").alias("load_millis"))


@query(
    "file_stats",
    """SELECT l_returnflag AS event_name, count(*) AS rows, min(epoch_ms(l_shipdate)) AS min_millis,
    max(epoch_ms(l_shipdate)) AS max_millis FROM lineitem GROUP BY l_returnflag""",
)
def clustered_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clustered by load time and flag, files hold (nearly) one flag; their statistics add up.

    Files are written per flag, so that the statistics of the files of a flag sum to it.
    """
    base = scratch_folder(spark, "stats")
    items = inputs.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event_id"),
        F.col("l_returnflag").alias("event_name"),
        inputs.utc(F.col("l_shipdate")).alias("collector_tstamp"),
    )
    items = with_load_tstamp(items, F.timestamp_millis(F.lit(1700000000000)))
    clustered = cluster(items)
    clustered.withColumn("flag", F.col("event_name")).write.partitionBy("flag").parquet(base)
    stats = file_stats(spark.read.parquet(base), ("event_name", "collector_tstamp"))
    return stats.groupBy(F.col("min_event_name").alias("event_name")).agg(
        F.sum("rows").alias("rows"),
        F.unix_millis(F.min("min_collector_tstamp")).alias("min_millis"),
        F.unix_millis(F.max("max_collector_tstamp")).alias("max_millis"),
    )


@query(
    "clustered_reads",
    """SELECT count(*) AS items, CAST(sum(l_linenumber) AS BIGINT) AS numbers, true AS few_files
    FROM lineitem WHERE epoch_ms(l_shipdate) BETWEEN
      (SELECT min(epoch_ms(l_shipdate)) FROM lineitem)
      AND (SELECT min(epoch_ms(l_shipdate)) + 2592000000 FROM lineitem)""",
)
def clustered_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of a table clustered by time: the file index leaves most files out of the scan."""
    base = scratch_folder(spark, "clustered")
    items = inputs.table(spark, sf_dir, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber").alias("event_id"),
        "l_linenumber",
        inputs.utc(F.col("l_shipdate")).alias("collector_tstamp"),
    )
    cluster(items, ("collector_tstamp",), partitions=24).write.parquet(base)
    table = spark.read.schema(items.schema).parquet(base)
    index = file_stats(table, ("collector_tstamp",))
    index.write.parquet(f"{base}-index")
    index = spark.read.schema(index.schema).parquet(f"{base}-index")
    first = index.agg(F.unix_micros(F.min("min_collector_tstamp")).alias("at")).first()["at"]
    low, high = (F.timestamp_micros(F.lit(first + days * 86_400_000_000)) for days in (0, 30))
    rows, files = read_between(index, items.schema, "collector_tstamp", low, high)
    return rows.agg(
        F.count("*").alias("items"), F.sum("l_linenumber").alias("numbers")
    ).withColumn("few_files", F.lit(4 * files <= index.count()))
