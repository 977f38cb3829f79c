"""Load metrics as tables: counts, latencies, the period report, attempt classes.

Batch log columns: ``loaded_at, good, bad, earliest``. Attempt log columns:
``attempted_at, attempt, error_chain array<string>`` (an empty or NULL chain is a
success; the chain runs from the error to its innermost cause).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.operators.parse import FAILURE

# Error kinds that need the operator to change the setup.
SETUP_ERRORS = ("Unauthenticated", "PermissionDenied", "NotFound", "UnknownHost")

COUNT, GAUGE = "count", "gauge"


def good_bad_counts(transformed: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``events_good`` and ``events_bad``; a zero count is reported too."""
    good = F.col(FAILURE).isNull()
    return transformed.groupBy(*keys).agg(
        F.count_if(good).alias("events_good"), F.count_if(~good).alias("events_bad")
    )


def batches_to_write(transformed: DataFrame, batch: list[str]) -> DataFrame:
    """Which batches land data: those with at least one good row."""
    counts = good_bad_counts(transformed, tuple(batch))
    return counts.withColumn("written", F.col("events_good") > 0)


def _millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)


def e2e_latency(batch_log: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Longest time from the earliest event of a batch to its load; none if never set."""
    latency = _millis_between(F.col("earliest"), F.col("loaded_at"))
    measured = batch_log.where(F.col("earliest").isNotNull())
    return measured.groupBy(*keys).agg(F.max(latency).alias("e2e_latency_millis"))


def stream_latency(received: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Longest time from ``ingested_at`` to ``processed_at``; 0 when nothing came."""
    latency = _millis_between(F.col("ingested_at"), F.col("processed_at"))
    return received.groupBy(*keys).agg(
        F.greatest(F.coalesce(F.max(latency), F.lit(0)), F.lit(0)).alias("latency_millis")
    )


def attempt_class(setup_errors: tuple[str, ...] = SETUP_ERRORS) -> Column:
    """``setup``, ``transient``, or NULL for a success. A setup cause anywhere counts."""
    chain = F.col("error_chain")
    failed = F.size(F.coalesce(chain, F.array().cast("array<string>"))) > 0
    is_setup = F.exists(chain, lambda error: error.isin(*setup_errors))
    return F.when(failed & is_setup, "setup").when(failed, "transient")


def attempt_classes(attempts: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Failed attempts per class, one count for each attempt."""
    failed = attempts.withColumn("error_class", attempt_class())
    failed = failed.where(F.col("error_class").isNotNull())
    return failed.groupBy(*keys, "error_class").agg(F.count("*").alias("attempts"))


def period_spine(periods: DataFrame, period: str = "1 minute") -> DataFrame:
    """Every ``period_start`` from the first to the last one of a table, also those in between."""
    ends = periods.agg(F.min("period_start").alias("first"), F.max("period_start").alias("last"))
    ends = ends.where(F.col("first").isNotNull())
    every = F.sequence("first", "last", F.expr(f"INTERVAL {period}"))
    return ends.select(F.explode(every).alias("period_start"))


def metrics_report(
    batch_log: DataFrame,
    received: DataFrame,
    attempts: DataFrame,
    period: str = "1 minute",
    idle: bool = False,
) -> DataFrame:
    """``period_start, key, value, type`` per reporting period.

    Counts are summed and gauges take their maximum within a period. The end-to-end
    latency is left out of periods that never set it, and error counts that are zero.
    With ``idle``, periods in which nothing happened report their zeros too.
    """

    def start(time: str) -> Column:
        return F.window(time, period).getField("start").alias("period_start")

    zero = F.lit(0).cast("long")
    batches = batch_log.groupBy(start("loaded_at")).agg(
        F.sum("good").alias("good"),
        F.sum("bad").alias("bad"),
        F.max(_millis_between(F.col("earliest"), F.col("loaded_at"))).alias("e2e"),
    )
    streams = received.groupBy(start("processed_at")).agg(
        F.max(_millis_between(F.col("ingested_at"), F.col("processed_at"))).alias("latency")
    )
    kind = attempt_class()
    errors = attempts.groupBy(start("attempted_at")).agg(
        F.count_if(kind == "transient").alias("transient"),
        F.count_if(kind == "setup").alias("setup"),
    )
    periods = batches.join(streams, "period_start", "full").join(errors, "period_start", "full")
    if idle:
        periods = period_spine(periods, period).join(periods, "period_start", "left")
    lines = F.array(
        _metric("events_good", F.coalesce("good", zero), COUNT),
        _metric("events_bad", F.coalesce("bad", zero), COUNT),
        _metric("latency_millis", F.greatest(F.coalesce("latency", zero), zero), GAUGE),
        _metric("e2e_latency_millis", F.col("e2e"), GAUGE),
        _metric("load_errors", F.when(F.col("transient") > 0, F.col("transient")), COUNT),
        _metric("setup_errors", F.when(F.col("setup") > 0, F.col("setup")), COUNT),
    )
    report = periods.select("period_start", F.inline(lines))
    return report.where(F.col("value").isNotNull())


def _metric(key: str, value: Column, kind: str) -> Column:
    return F.struct(F.lit(key).alias("key"), value.alias("value"), F.lit(kind).alias("type"))
