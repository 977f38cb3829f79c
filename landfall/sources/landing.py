"""The landing folder: date-partitioned Parquet, one folder per batch, evolving columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime
from math import ceil
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.layout import Layout
from landfall.options import codec_name

LOAD_DATE = "load_tstamp_date"
LOAD_BATCH = "load_batch"
LOAD_ATTEMPT = "load_attempt"

# Parquet INT64 microseconds, the type table readers expect, instead of INT96.
_WRITE_CONF = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}


@contextmanager
def session_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session options for a while; the session belongs to the caller."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def load_date(load_time: datetime) -> str:
    """UTC day of a load."""
    return load_time.astimezone(UTC).strftime("%Y-%m-%d")


def load_date_of(load_time: Column) -> Column:
    """UTC day of a load, over a column and whatever the session's zone."""
    micros = F.unix_micros(load_time)
    days = F.floor(micros / F.lit(86_400_000_000)).cast("int")
    return F.date_from_unix_date(days).cast("string")


def folder_name(text: str) -> str:
    """A text as one part of a path, escaped so that Spark reads it back as it was."""
    return quote(text, safe="")


def batch_folder(landing: str, load_time: datetime, batch: str, attempt: int | None = None) -> str:
    """Folder of a batch, or of one try of it."""
    folder = f"{landing.rstrip('/')}/{LOAD_DATE}={load_date(load_time)}/{LOAD_BATCH}={folder_name(batch)}"
    return folder if attempt is None else f"{folder}/{LOAD_ATTEMPT}={attempt}"


def write_batch(
    events: DataFrame,
    folder: str,
    codec: str = "snappy",
    files: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Write one batch to its own folder, in so many files.

    Fewer files than cores make a small batch: its finished columns are dealt out, so that all cores compute them.
    More files are merged from neighbouring splits, without a shuffle.
    """
    with session_conf(events.sparkSession, _WRITE_CONF):
        cores = events.sparkSession.sparkContext.defaultParallelism
        out = events if files is None else events.repartition(files) if files < cores else events.coalesce(files)
        out.write.mode(mode).option("compression", codec_name(codec)).parquet(folder)


# A small batch is still worth several writers, down to files of this many bytes of input.
_SMALLEST_SHARE = 16_000_000


def file_count(batch_bytes: int, target_file_bytes: int, cores: int) -> int:
    """Files, and so writers, of a batch: by target size, or one per core for a small batch.

    A few more files than cores become a whole number for each core, lest most cores wait for the last ones.
    """
    wanted = ceil(batch_bytes / target_file_bytes)
    if cores < wanted < 4 * cores:
        wanted = cores * ceil(wanted / cores)
    shares = ceil(batch_bytes / min(_SMALLEST_SHARE, target_file_bytes))
    return max(1, wanted, min(cores, shares))


def write_partitioned(
    events: DataFrame,
    landing: str,
    load_time: Column,
    spread: str = "event_id",
    codec: str = "snappy",
) -> None:
    """Append rows whose load times differ, each under its own UTC day.

    Rows are ranged by day first, so that a task writes few days and a day few files; the
    range also runs over a hash of ``spread``, so that a day that holds most rows is
    written by many tasks.
    """
    dated = events.withColumn(LOAD_DATE, load_date_of(load_time))
    ranged = dated.repartitionByRange(F.col(LOAD_DATE), F.xxhash64(spread))
    with session_conf(events.sparkSession, _WRITE_CONF):
        (
            ranged.write.mode("append")
            .partitionBy(LOAD_DATE)
            .option("compression", codec_name(codec))
            .parquet(landing)
        )


def seed(spark: SparkSession, layout: Layout, landing: str, load_time: datetime) -> str:
    """Land an empty file with the fixed columns, so that a table can be made before events."""
    folder = batch_folder(landing, load_time, "seed")
    write_batch(spark.createDataFrame([], layout.base_schema), folder)
    return folder


def read_landing(
    spark: SparkSession,
    landing: str,
    schema: T.StructType | None = None,
    modified_after: str | None = None,
    partition_columns: bool = False,
) -> DataFrame:
    """All landed rows under the union of their columns; older rows have NULL in newer ones.

    This reads every file of the folder, those of failed tries too. Where loads may be
    tried again, ``sources.manifest.read_committed`` reads the committed ones alone.

    Without a ``schema`` the footers of all files are read to unite their columns. The
    batch log knows them as well (``sources.manifest.logged_schema``), which is quicker
    on a large folder. ``partition_columns`` keeps the folder names as columns, so that a
    filter on the load date skips whole days.
    """
    if schema is None and modified_after is not None:
        # The columns are those of all files, whichever are left out.
        schema = read_landing(spark, landing, partition_columns=partition_columns).schema
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    if not partition_columns:
        reader = reader.option("recursiveFileLookup", True)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.parquet(landing)


def landing_schema(spark: SparkSession, landing: str) -> T.StructType:
    """Merged schema of the files landed so far."""
    return read_landing(spark, landing).schema
