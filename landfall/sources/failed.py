"""Failed events as JSON text, with a size limit, to files or any batch sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from landfall.sources.landing import LOAD_BATCH, folder_name

FAILED_FIELDS = ("processor_name", "processor_version", "failure", "payload")


def failed_json(failed: DataFrame, max_bytes: int) -> DataFrame:
    """``value`` column of JSON texts. One over the limit becomes a size violation.

    The violation names both sizes and keeps the start of the payload, a tenth of the
    limit, for the reader to recognise the event by.
    """
    whole = _json(F.col("failure"), F.col("payload"))
    sized = failed.select(*FAILED_FIELDS, whole.alias("_whole"))
    size = F.octet_length("_whole")
    reason = F.concat(
        F.lit("size violation: "), size.cast("string"), F.lit(f" bytes exceed {max_bytes}")
    )
    start = F.substr("payload", F.lit(1), F.lit(max_bytes // 10))
    violation = _json(reason, start)
    return sized.select(F.when(size > max_bytes, violation).otherwise(F.col("_whole")).alias("value"))


def _json(failure: Column, payload: Column) -> Column:
    return F.to_json(
        F.struct(
            "processor_name",
            "processor_version",
            failure.alias("failure"),
            payload.alias("payload"),
        )
    )


def _counted(rows: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """The rows, and how many there were once they are written: the write itself counts them.

    Spark takes a task's count once, with the try of it that succeeds.
    """
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n")), lambda: seen.get["n"]


def write_failed(texts: DataFrame, root: str, batch: str) -> int:
    """JSON lines in a batch's own folder; returns how many.

    A retry replaces the folder as a whole, also when it has no failed rows, so the count
    is always that of this try.
    """
    counted, count = _counted(texts)
    counted.write.mode("overwrite").text(f"{root.rstrip('/')}/{LOAD_BATCH}={folder_name(batch)}")
    return count()


def send_failed(texts: DataFrame, kind: str, options: dict[str, str]) -> int:
    """To any installed batch sink that takes a ``value`` column; returns how many."""
    counted, count = _counted(texts)
    counted.write.format(kind).options(**options).mode("append").save()
    return count()


def read_failed(spark: SparkSession, folder: str) -> DataFrame:
    fields = ", ".join(f"{name} string" for name in FAILED_FIELDS)
    lines = spark.read.option("recursiveFileLookup", True).text(folder)
    return lines.select(F.from_json("value", fields).alias("event")).select("event.*")
