"""Landing folder to table: new files only, columns added as they appear.

The table stream follows files, not rows. Each micro-batch learns which files are new, reads them under their
own united columns, and unites these with the table's before anything is written. So a column that
appears while the stream runs is taken up with the first file that has it, and files whose columns can't
share the table's types stop the stream before they count as read.

A micro-batch is a try with a folder of its own below the table, and counts once it is in the table's batch
log, so a batch that is tried again is neither doubled nor seen in part.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from threading import Event

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from landfall.operators.table import LOAD_TSTAMP, cluster, with_load_tstamp
from landfall.plans.field_types import merge_types
from landfall.sources.landing import batch_folder, landing_schema, write_batch
from landfall.sources.manifest import LOG_SCHEMA, COMMITTED, Manifest, batch_log, committed_folders

#: Files of a micro-batch at most, and so paths that the driver holds.
FILES_PER_BATCH = 1_000
_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
#: Hidden from readers that take the table's folder as it is.
_LOG = "_batches"


def stream_landing(
    spark: SparkSession,
    landing: str,
    landed_after: Column | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Stream of landed rows under the columns known when it starts; ``ingest`` has no such limit.

    ``landed_after`` leaves out files that were there before a time. ``schema`` spares the
    reading of all footers, see ``sources.manifest.logged_schema``.
    """
    rows = (
        spark.readStream.schema(schema or landing_schema(spark, landing))
        .option("recursiveFileLookup", True)
        .parquet(landing)
    )
    if landed_after is None:
        return rows
    return rows.where(F.col("_metadata.file_modification_time") > landed_after)


def new_files(
    spark: SparkSession, landing: str, landed_after: Column | None = None, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream of the paths of landed files, one row each; what is in them is not read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
    )
    if landed_after is not None:
        files = files.where(F.col("modificationTime") > landed_after)
    return files.select("path")


def committed_batches(spark: SparkSession, manifest: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream of the folders of committed batches, from the batch log of a load."""
    log = (
        spark.readStream.schema(LOG_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(manifest)
    )
    return log.where((F.col("state") == COMMITTED) & F.col("folder").isNotNull()).select(F.col("folder").alias("path"))


def _united(older: T.StructType, newer: T.StructType) -> T.StructType:
    """Columns of both; one that both have must merge."""
    merged = {f.name: f.dataType for f in older.fields}
    for f in newer.fields:
        merged[f.name] = merge_types(merged[f.name], f.dataType) if f.name in merged else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in merged.items()])


def _column_text(field: T.StructField) -> str:
    return T.StructType([T.StructField(field.name, field.dataType)]).json()


def _schema_of(columns: Iterable[dict[str, str]]) -> T.StructType:
    """United columns, in the order in which they appeared."""
    schema = T.StructType([])
    for batch in columns:
        fields = [T.StructType.fromJson(json.loads(text)).fields[0] for text in batch.values()]
        schema = _united(schema, T.StructType(fields))
    return schema


def _log(table: str) -> str:
    return f"{table.rstrip('/')}/{_LOG}"


def ingest(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    landed_after: Column | None = None,
    load_tstamp: Column | None = None,
    manifest: str | None = None,
    cluster_by: tuple[str, ...] = (),
    files_per_batch: int = FILES_PER_BATCH,
    **trigger,
) -> StreamingQuery:
    """Append landed rows with their load time to a Parquet table; ``read_table`` reads it.

    Files that are there at the first start are taken too, unless ``landed_after`` leaves
    them out. With the ``manifest`` of the load only committed batches are taken, and the
    landing folder is never listed; give it wherever a load may be tried again. Rows of a
    micro-batch are clustered by ``cluster_by``.
    """
    if manifest is None:
        paths = new_files(spark, landing, landed_after, files_per_batch)
    else:
        paths = committed_batches(spark, manifest, files_per_batch)
    started, ids = Event(), []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        found = sorted(row["path"] for row in batch.distinct().collect())
        if found:
            _append(batch.sparkSession, table, ids[0], batch_id, found, load_tstamp, cluster_by)

    writer = paths.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    query = writer.trigger(**(trigger or {"availableNow": True})).start()
    ids.append(str(query.id))
    started.set()
    return query


def _append(
    spark: SparkSession,
    table: str,
    query_id: str,
    batch_id: int,
    paths: list[str],
    load_tstamp: Column | None,
    cluster_by: tuple[str, ...],
) -> None:
    log = Manifest(spark, _log(table), query_id)
    attempt = log.start(batch_id)
    if attempt.committed:
        return
    rows = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*paths)
    now = F.timestamp_micros(F.lit(int(attempt.load_tstamp.timestamp() * 1_000_000)))
    rows = with_load_tstamp(rows, now if load_tstamp is None else load_tstamp)
    _united(table_schema(spark, table), rows.schema)  # raises before anything is written or committed
    if cluster_by:
        rows = cluster(rows, tuple(c for c in cluster_by if c in rows.columns), spread=_spread(rows))
    folder = batch_folder(table, attempt.load_tstamp, f"{query_id}-{batch_id}", attempt.number)
    write_batch(rows, folder, mode="errorifexists")
    log.commit(batch_id, attempt, columns={f.name: _column_text(f) for f in rows.schema.fields}, folder=folder)


def _spread(rows: DataFrame) -> str:
    """The column whose hash cuts a hot key: the event's id, else the first one."""
    return "event_id" if "event_id" in rows.columns else next(c for c in rows.columns if c != LOAD_TSTAMP)


def table_schema(spark: SparkSession, table: str) -> T.StructType:
    """The table's columns in the order in which they appeared, from its batch log alone."""
    log = Manifest(spark, _log(table), "").all_rows()
    if log is None:
        return T.StructType([])
    rows = log.where(F.col("state") == COMMITTED).groupBy(F.to_json("columns").alias("columns")).agg(F.min("loaded_at").alias("first"))
    return _schema_of(json.loads(r["columns"]) for r in rows.orderBy("first", "columns").collect() if r["columns"])


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """The committed rows under all columns of the table."""
    schema = table_schema(spark, table)
    folders = committed_folders(batch_log(spark, _log(table)))
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*folders)
