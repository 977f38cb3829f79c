"""The batch log: what each batch did, and whether it was already done.

Every try of a batch first records a ``started`` row and, when all is written, a
``committed`` row. A batch that comes again keeps the load time of its first try; one that
is committed is not loaded again. Rows are grouped by the hundred batches, so that looking
one up reads one small folder however long the log is.

Each try writes to a folder of its own, which nobody writes to again. The committed row
names the folder that counts; ``read_committed`` follows these rows, so a reader neither
sees a batch twice, nor half of one, nor files that vanish while it reads.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.layout import Layout
from landfall.plans.field_types import merge_types
from landfall.sources.landing import folder_name

STARTED, COMMITTED = "started", "committed"
_BATCHES_PER_FOLDER = 100

LOG_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("load_tstamp", T.TimestampType()),
        T.StructField("good", T.LongType()),
        T.StructField("bad", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("earliest", T.TimestampType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("columns", T.MapType(T.StringType(), T.StringType())),
        T.StructField("folder", T.StringType()),
        T.StructField("ingested", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class Attempt:
    number: int
    load_tstamp: datetime
    committed: bool


class Manifest:
    def __init__(self, spark: SparkSession, path: str, query_id: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.query_id = query_id

    def _folder(self, batch_id: int) -> str:
        group = batch_id // _BATCHES_PER_FOLDER
        return f"{self.path}/log_query={folder_name(self.query_id)}/log_group={group}"

    def start(self, batch_id: int) -> Attempt:
        """Record a try. Times are kept in UTC."""
        before = self._rows(batch_id)
        for row in before:
            if row["state"] == COMMITTED:
                return Attempt(row["attempt"], instant(row["micros"]), committed=True)
        first = min((r["micros"] for r in before), default=None)
        load_tstamp = datetime.now(UTC) if first is None else instant(first)
        attempt = Attempt(len(before), load_tstamp, committed=False)
        self._append(batch_id, attempt, STARTED)
        return attempt

    def commit(self, batch_id: int, attempt: Attempt, **counts) -> None:
        self._append(batch_id, attempt, COMMITTED, loaded_at=datetime.now(UTC), **counts)

    def all_rows(self) -> DataFrame | None:
        """The log of every query, or None before the first try."""
        return self._log(self.path)

    def _log(self, folder: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(folder)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _rows(self, batch_id: int) -> list:
        log = self._log(self._folder(batch_id))
        if log is None:
            return []
        mine = log.where(F.col("batch_id") == batch_id)
        return mine.select("attempt", "state", F.unix_micros("load_tstamp").alias("micros")).collect()

    def _append(self, batch_id: int, attempt: Attempt, state: str, **values) -> None:
        row = {
            "query_id": self.query_id,
            "batch_id": batch_id,
            "attempt": attempt.number,
            "state": state,
            "load_tstamp": attempt.load_tstamp,
            **values,
        }
        cells = [literal(row.get(f.name), f) for f in LOG_SCHEMA.fields]
        one = self.spark.range(1).coalesce(1).select(*cells)
        one.write.mode("append").parquet(self._folder(batch_id))


def literal(value, field: T.StructField) -> Column:
    """A log value as a column; instants by their microseconds, whatever the session's zone."""
    if isinstance(value, list):
        return F.array(*[F.lit(x) for x in value]).cast(field.dataType).alias(field.name)
    if isinstance(value, datetime):
        column = F.timestamp_micros(F.lit(_micros(value)))
    elif isinstance(value, dict) and value:
        column = F.create_map(*[F.lit(x) for pair in value.items() for x in pair])
    else:
        column = F.lit(None if isinstance(value, dict) else value)
    return column.cast(field.dataType).alias(field.name)


def _micros(time: datetime) -> int:
    return (time - datetime(1970, 1, 1, tzinfo=UTC)) // timedelta(microseconds=1)


def instant(micros: int) -> datetime:
    return datetime.fromtimestamp(micros / 1_000_000, UTC)


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """Committed batches of every query."""
    log = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).parquet(path)
    return log.where(F.col("state") == COMMITTED).drop("state")


def received_log(spark: SparkSession, path: str) -> DataFrame:
    """When the oldest line of each committed batch came to the source, and when the batch was taken up.

    It has the batches whose load knows the source's time, see ``LoadOptions.source_time``.
    """
    log = batch_log(spark, path).where(F.col("ingested").isNotNull())
    return log.select("query_id", "batch_id", F.col("ingested").alias("ingested_at"), F.col("load_tstamp").alias("processed_at"))


def committed_folders(log: DataFrame) -> list[str]:
    """The folder of each committed batch that landed rows; of two commits the first counts.

    One short text per batch goes to the driver, as it does for any folder that is listed.
    """
    first = F.min_by("folder", F.struct("loaded_at", "attempt")).alias("folder")
    rows = log.where(F.col("folder").isNotNull()).groupBy("query_id", "batch_id").agg(first)
    return sorted(row["folder"] for row in rows.select("folder").collect())


def read_committed(
    spark: SparkSession, path: str, landing: str, schema: T.StructType | None = None, partition_columns: bool = False
) -> DataFrame:
    """The landed rows of committed batches, and of no other try.

    Without a ``schema`` the footers of the files are read to unite their columns, see
    ``logged_schema``.
    """
    folders = committed_folders(batch_log(spark, path))
    if not folders:
        return spark.createDataFrame([], schema or T.StructType([]))
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    if partition_columns:
        reader = reader.option("basePath", landing)
    else:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(*folders)


def logged_schema(spark: SparkSession, path: str, layout: Layout) -> T.StructType:
    """Merged schema of the landing folder, from the columns each batch recorded.

    Batches differ in their columns in countless ways, but there are few distinct columns:
    only those reach the driver.
    """
    recorded = batch_log(spark, path).select(F.explode("columns").alias("name", "type")).distinct()
    merged: dict[str, T.DataType] = {}
    for row in sorted(recorded.collect()):
        kind = T.StructType.fromJson(json.loads(row["type"])).fields[0].dataType
        known = merged.get(row["name"])
        merged[row["name"]] = kind if known is None else merge_types(known, kind)
    entities = [T.StructField(name, merged[name]) for name in sorted(merged)]
    return T.StructType([*layout.base_schema.fields, *entities])
