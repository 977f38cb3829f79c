"""What the operators share: table reads, intermediate tables, files in the shared folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from landfall.sources.scratch import scratch_folder

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: it cuts lineage and survives executors."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, purpose)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs that are made inside go when their job ends, not when the driver collects its garbage.

    For jobs that run once: another run of the same frame would shuffle again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder in the shared place, and the path in it."""
    if urlparse(uri).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(uri).path
    return fs.FileSystem.from_uri(uri)


def new_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex}"


def arrow_map(
    frame: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with a worker that is built once per task."""

    def run(batches: Batches) -> Batches:
        work = make()
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return frame.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; a null is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def let_workers_import(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did.

    That is enough on one machine or a shared folder; elsewhere ship it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
