"""The attempt log: what went wrong with each try of a batch, as a chain of causes.

Only failed tries are written, when they fail; a try that went well is known from the batch log, so a
healthy load has no extra work.
"""

from __future__ import annotations

import socket
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landfall.sources.manifest import batch_log, literal

ATTEMPT_SCHEMA = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("attempted_at", T.TimestampType()),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("error_chain", T.ArrayType(T.StringType())),
    ]
)

#: What an error is called in the log, by the class that shows it; others keep their class name.
_JAVA_KINDS = {
    "AccessControlException": "PermissionDenied",
    "AccessDeniedException": "PermissionDenied",
    "FileNotFoundException": "NotFound",
    "NoSuchFileException": "NotFound",
    "NoSuchBucketException": "NotFound",
    "UnknownHostException": "UnknownHost",
    "LoginException": "Unauthenticated",
    "AuthenticationException": "Unauthenticated",
    "SocketTimeoutException": "Timeout",
    "TimeoutException": "Timeout",
}
_PYTHON_KINDS = (
    (PermissionError, "PermissionDenied"),
    (FileNotFoundError, "NotFound"),
    (socket.gaierror, "UnknownHost"),
    (TimeoutError, "Timeout"),
)
_NOT_FOUND = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND"}
_LONGEST = 50


def error_chain(error: BaseException) -> list[str]:
    """Kinds of an error and its causes, from the outside in, through Python and Java alike."""
    chain: list[str] = []
    seen: set[int] = set()
    while error is not None and id(error) not in seen and len(chain) < _LONGEST:
        seen.add(id(error))
        chain.append(_python_kind(error))
        origin = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
        if origin is not None:
            chain += _java_chain(origin)
        error = error.__cause__ or (None if error.__suppress_context__ else error.__context__)
    return chain[:_LONGEST]


def _python_kind(error: BaseException) -> str:
    condition = error.getCondition() if hasattr(error, "getCondition") else None
    if condition in _NOT_FOUND:
        return "NotFound"
    return next((name for kind, name in _PYTHON_KINDS if isinstance(error, kind)), type(error).__name__)


def _java_chain(error) -> list[str]:
    chain: list[str] = []
    while error is not None and len(chain) < _LONGEST:
        name = error.getClass().getSimpleName()
        chain.append(_JAVA_KINDS.get(name, name))
        error = error.getCause()
    return chain


def record_failure(
    spark: SparkSession, path: str, query_id: str, batch_id: int, attempt: int, at: datetime, error: BaseException
) -> None:
    """Adds a failed try. The error stays the one to be raised, even if it can't be recorded."""
    values = {
        "query_id": query_id,
        "batch_id": batch_id,
        "attempted_at": at,
        "attempt": attempt,
        "error_chain": error_chain(error),
    }
    try:
        row = spark.range(1).coalesce(1).select(*[literal(values[f.name], f) for f in ATTEMPT_SCHEMA.fields])
        row.write.mode("append").parquet(path)
    except Exception as e:
        error.add_note(f"this try is missing from the attempt log {path}: {e}")


def attempt_log(spark: SparkSession, manifest: str) -> DataFrame:
    """Every finished try of the loads of a batch log: failed ones with their causes, the others without."""
    good = batch_log(spark, manifest).select(
        "query_id",
        "batch_id",
        F.col("loaded_at").alias("attempted_at"),
        "attempt",
        F.array().cast("array<string>").alias("error_chain"),
    )
    try:
        failed = spark.read.schema(ATTEMPT_SCHEMA).parquet(failures_path(manifest))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return good
        raise
    return good.unionByName(failed)


def failures_path(manifest: str) -> str:
    return f"{manifest.rstrip('/')}-failures"
