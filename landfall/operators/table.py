"""The table over the landing folder: load time, clustering, per-file statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_TSTAMP = "load_tstamp"
CLUSTER_BY = (LOAD_TSTAMP, "event_name")
# Rows of a split take several times its bytes once they are sorted.
_RANGES_PER_SPLIT = 4
STATS_COLUMNS = (
    LOAD_TSTAMP,
    "collector_tstamp",
    "derived_tstamp",
    "dvce_created_tstamp",
    "true_tstamp",
    "event_name",
)


def with_load_tstamp(events: DataFrame, now: Column | None = None) -> DataFrame:
    return events.withColumn(LOAD_TSTAMP, F.current_timestamp() if now is None else now)


def cluster(
    events: DataFrame,
    by: tuple[str, ...] = CLUSTER_BY,
    spread: str = "event_id",
    partitions: int | None = None,
) -> DataFrame:
    """Order rows so that each file covers a narrow range of the clustering columns.

    All rows of a load share one load time and one event name may fill a third of them,
    so the range also runs over a hash of ``spread``: a hot key is cut into several
    files instead of filling one task.

    Without ``partitions`` there are as many as the session shuffles into, but more for a large input, so that
    a task never sorts more than a part of a split. Give rows without a shuffle of their own then, since
    counting the splits would run it.
    """
    ranges = [*[F.col(c) for c in by], F.xxhash64(spread)]
    if partitions is None:
        wanted = _RANGES_PER_SPLIT * events.rdd.getNumPartitions()
        if wanted <= int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            return events.repartitionByRange(*ranges).sortWithinPartitions(*by)
        partitions = wanted
    return events.repartitionByRange(partitions, *ranges).sortWithinPartitions(*by)


def file_stats(table: DataFrame, columns: tuple[str, ...] = STATS_COLUMNS) -> DataFrame:
    """Rows, minimum and maximum of the named columns in each file of a table.

    Spark sorts all rows by file for the least text of each, but hashes if texts are only grouped by. So
    the distinct texts of a file come first, with the statistics of the other columns.
    """
    present = [c for c in columns if c in table.columns]
    texts = [c for c in present if isinstance(table.schema[c].dataType, (T.StringType, T.BinaryType))]
    rows = table.select(F.col("_metadata.file_path").alias("file_path"), *present)
    first = [F.count("*").alias("rows")]
    for c in present:
        if c not in texts:
            first += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    stats = [F.sum("rows").alias("rows")]
    for c in present:
        low, high = (c, c) if c in texts else (f"min_{c}", f"max_{c}")
        stats += [F.min(low).alias(f"min_{c}"), F.max(high).alias(f"max_{c}")]
    return rows.groupBy("file_path", *texts).agg(*first).groupBy("file_path").agg(*stats)


def files_between(index: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """Files of a ``file_stats`` table that may hold values of a column from ``low`` to ``high``."""
    return index.where((F.col(f"max_{column}") >= low) & (F.col(f"min_{column}") <= high)).select("file_path")


def read_between(
    index: DataFrame, schema: T.StructType, column: str, low: Column, high: Column
) -> tuple[DataFrame, int]:
    """The rows with values from ``low`` to ``high``, and how many files are read for them.

    Files that cannot hold such a row are left out before the scan; of a clustered table
    few remain. Their paths go through the driver, as those of any scan do.
    """
    spark = index.sparkSession
    files = sorted(row["file_path"] for row in files_between(index, column, low, high).collect())
    if not files:
        return spark.createDataFrame([], schema), 0
    return spark.read.schema(schema).parquet(*files).where(F.col(column).between(low, high)), len(files)
