"""Closing batches by size or delay, and summing them up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landfall.operators.entities import SEEN_KEY, spread_items
from landfall.operators.parse import BYTES, FAILURE
from landfall.sources.scratch import ensure_checkpoint_dir

BATCH = ("source", "delay_bucket", "batch_seq")


def assign_batches(
    chunks: DataFrame,
    source: str,
    time: str,
    order: str,
    weight: str,
    max_bytes: int = 16_000_000,
    max_delay_seconds: float = 1.0,
    pieces: int | None = None,
) -> DataFrame:
    """Number the batches of a table of chunks: ``source``, ``delay_bucket``, ``batch_seq``.

    A batch closes after ``max_delay_seconds`` or when the bytes before a chunk have
    reached ``max_bytes``. Chunks run in the order of (``time``, ``order``), each source
    on its own. ``batch_seq`` is the running weight before the chunk divided by the
    limit, so a batch may begin a little over a multiple of it; a live stream gets its
    limits from the source and trigger instead (see ``sources.lines``).

    Rows are cut into ``pieces`` ranges (by default one per shuffle partition) that tasks sum
    separately on top of the ranges before, so no task ever holds a whole hot source.
    """
    micros = int(max_delay_seconds * 1_000_000)
    keyed = chunks.withColumns(
        {
            "source": F.col(source),
            "delay_bucket": F.floor(F.unix_micros(F.col(time)) / F.lit(micros)).cast("long"),
        }
    )
    keyed, before = _split_running(keyed, time, order, weight, pieces)
    sequence = F.floor(before / F.lit(max_bytes)).cast("long")
    return keyed.withColumn("batch_seq", sequence).drop("_piece", "_offset")


def _running(keys: list[str], time: str, order: str, weight: str) -> Column:
    """Weight of the rows before this one in its group."""
    rows = (
        Window.partitionBy(*keys)
        .orderBy(time, order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.sum(weight).over(rows) - F.col(weight)


def cut_into_pieces(keyed: DataFrame, time: str, order: str, pieces: int | None = None) -> DataFrame:
    """Rows in ranges of their source, bucket and place, with the number of their range as ``_piece``."""
    width = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = keyed.repartitionByRange(pieces or width, "source", "delay_bucket", time, order)
    return ranged.withColumn("_piece", F.spark_partition_id())


def _split_running(
    keyed: DataFrame, time: str, order: str, weight: str, pieces: int | None
) -> tuple[DataFrame, Column]:
    """Running weight by ranges: each piece sums its own rows, on top of the pieces before.

    The checkpoint fixes which rows are in which piece, because range bounds are sampled
    again every time the plan is run.
    """
    ensure_checkpoint_dir(keyed.sparkSession)
    cut = cut_into_pieces(keyed, time, order, pieces).checkpoint()
    group = ["source", "delay_bucket"]
    # At most one row per group and piece: small whatever the skew of the rows.
    weights = cut.groupBy(*group, "_piece").agg(F.sum(weight).alias("_weight"))
    earlier = Window.partitionBy(*group).orderBy("_piece")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = weights.select(
        *group, "_piece", F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_offset")
    )
    joined = cut.join(offsets, [*group, "_piece"])
    return joined, F.col("_offset") + _running([*group, "_piece"], time, order, weight)


def combine_batches(parsed: DataFrame, batch: list[str], event_time: str) -> DataFrame:
    """One row per batch: counts, bytes, earliest parsed event, schema versions seen.

    Rows meet their batch only as partial aggregates, and a batch's set of versions is
    bounded by the schemas in use.
    """
    good = F.col(FAILURE).isNull()
    spread = spread_items(parsed, *batch, event_time, BYTES, good.alias("_good"))
    first = F.col("position") == 0
    seen = F.when(F.col("key").isNotNull(), F.concat_ws(" ", *SEEN_KEY))
    return spread.groupBy(*batch).agg(
        F.count_if(first & F.col("_good")).alias("parsed"),
        F.count_if(first & ~F.col("_good")).alias("failed"),
        F.sum(F.when(first, F.col(BYTES))).alias("bytes"),
        F.min(F.when(F.col("_good"), F.col(event_time))).alias("earliest"),
        F.sort_array(F.collect_set(seen)).alias("entities"),
    )


def earliest_parsed(parsed: DataFrame, batch: list[str], event_time: str) -> DataFrame:
    """Earliest event time per batch among rows that parsed; NULL when none did."""
    time = F.when(F.col(FAILURE).isNull(), F.col(event_time))
    return parsed.groupBy(*batch).agg(F.min(time).alias("earliest"))
