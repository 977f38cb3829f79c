"""Closing batches one after the other, as a live loader does, without a task that sees a whole source.

A batch takes chunks until the bytes it holds have reached the limit or the delay since its first
chunk has passed; the next chunk opens a batch with counts from nothing. Where a batch begins so
depends on all batches before it. Running sums break this chain up:

1. Chunks are cut into ranges of their source and place. Sums by range give each chunk the bytes
   before it, so the first chunk of the *next* batch can be found from any chunk that might open
   one: the first that lies the limit or the delay further on.
2. Only chunks whose next batch begins in a later range lead out of a range: those of its last
   batch's length. For each, a look into the range it leads to finds the chunk that leads on from
   there. These edges are doubled until they span all ranges, and marked from the first chunk on.
3. Every range then knows where its first batch begins and closes its own batches.

The driver holds the bounds of the ranges of sources that lie in several, at most two for each range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.sources.scratch import ensure_checkpoint_dir

_SOURCE, _AT, _ORDER = "_cut_source", "_cut_at", "_cut_order"
_RANGE = [_SOURCE, "_piece"]
#: Instant of a chunk without a time: before all others, with room for any delay.
_EARLIEST = -(2**62)
_NO_SOURCE = "\0"
#: Range before the first one of a source: its only row leads to the first chunk.
_BEFORE = -1


def assign_batches_exact(
    chunks: DataFrame,
    source: str,
    time: str,
    order: str,
    weight: str,
    max_bytes: int = 16_000_000,
    max_delay_seconds: float = 1.0,
    pieces: int | None = None,
) -> DataFrame:
    """The columns of ``chunks`` with ``source`` and ``batch_seq``, the number of its batch in its source.

    Chunks run in the order of (``time``, ``order``). Those in the same place, repeated rows among them,
    share a batch, as one chunk of their summed weight. A chunk without a time comes first, one
    without a weight weighs nothing, one without a source belongs to a source of its own. A column
    named like one that is added is replaced.

    ``pieces`` ranges (by default one per shuffle partition) should each hold many batches.
    Only places and weights are cut and kept; the other columns are joined at the end.
    """
    if max_bytes < 1 or max_delay_seconds < 1e-6:
        raise ValueError("a batch needs room for a byte and a microsecond")
    placed = chunks.withColumns(
        {
            _SOURCE: F.coalesce(F.col(source).cast("string"), F.lit(_NO_SOURCE)),
            _AT: F.coalesce(F.unix_micros(F.col(time)), F.lit(_EARLIEST)),
            _ORDER: F.col(order),
        }
    )
    held = F.greatest(F.coalesce(F.sum(weight), F.lit(0)), F.lit(0)).cast("long")
    places = placed.groupBy(_SOURCE, _AT, _ORDER).agg(held.alias("_weight"))
    numbered = _numbered(places, max_bytes, round(max_delay_seconds * 1_000_000), pieces).alias("n")
    rows = placed.alias("p")
    same = (
        (F.col(f"p.{_SOURCE}") == F.col(f"n.{_SOURCE}"))
        & (F.col(f"p.{_AT}") == F.col(f"n.{_AT}"))
        & F.col(f"p.{_ORDER}").eqNullSafe(F.col(f"n.{_ORDER}"))
    )
    own = [F.col(f"p.`{c}`") for c in chunks.columns if c not in ("source", "batch_seq")]
    return rows.join(numbered, same).select(
        *own, F.nullif(F.col(f"p.{_SOURCE}"), F.lit(_NO_SOURCE)).alias("source"), F.col("n.batch_seq")
    )


def _numbered(places: DataFrame, limit: int, delay: int, pieces: int | None) -> DataFrame:
    spark = places.sparkSession
    ensure_checkpoint_dir(spark)
    width = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = places.repartitionByRange(width, _SOURCE, _AT, _ORDER).withColumn("_piece", F.spark_partition_id())
    inside = Window.partitionBy(*_RANGE).orderBy(_AT, _ORDER)
    running = F.sum("_weight").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_weight")
    row = (F.row_number().over(inside) - 1).cast("long")
    # The checkpoint fixes the ranges, whose bounds are sampled again every time the plan is run.
    runs = cut.withColumns({"_row": row, "_within": running}).checkpoint()
    numbers = runs.select(*_RANGE, "_row", "_within", _AT)

    ends = _ends_of_spanning(runs)
    asked = _entries(numbers, ends, limit, delay)

    def starting(key: tuple, rows: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_row")
        following = _following(rows["_within"].to_numpy(), rows[_AT].to_numpy(), limit, delay).tolist()
        # A range without an entry lies within one batch, unless its source has no other range.
        at = int(entries["_entry"].iloc[0]) if len(entries) else (len(rows) if key[0] in ends else 0)
        starts = []
        while at < len(rows):
            starts.append(at)
            at = following[at]
        found = pd.DataFrame({"_row": np.array(starts, np.int64)})
        return found.assign(**dict(zip(_RANGE, key, strict=True)))[[*_RANGE, "_row"]]

    schema = f"{_SOURCE} string, _piece int, _row long"
    starts = numbers.groupBy(*_RANGE).cogroup(asked.groupBy(*_RANGE)).applyInPandas(starting, schema)
    opened = runs.join(starts.withColumn("_opens", F.lit(1)), [*_RANGE, "_row"], "left")
    here = F.sum(F.coalesce("_opens", F.lit(0))).over(
        Window.partitionBy(*_RANGE).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    )
    opened = opened.withColumn("_here", here)
    # One row for each range and source.
    earlier = Window.partitionBy(_SOURCE).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = opened.groupBy(*_RANGE).agg(F.max("_here").alias("_all"))
    totals = totals.select(*_RANGE, F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_earlier"))
    sequence = (F.col("_earlier") + F.col("_here") - 1).cast("long").alias("batch_seq")
    return opened.join(totals, _RANGE).select(_SOURCE, _AT, _ORDER, sequence)


def _following(before: np.ndarray, at: np.ndarray, limit: int, delay: int) -> np.ndarray:
    """For each chunk, the one that opens the next batch if it opens one; past the end if none here does."""
    return np.minimum(np.searchsorted(before, before + limit), np.searchsorted(at, at + delay))


def _ends_of_spanning(runs: DataFrame) -> dict[str, dict[str, np.ndarray]]:
    """Of the sources in several ranges: their ranges, and for each the bytes before it, and the bytes before and
    the instant of its last chunk."""
    sums = runs.groupBy(*_RANGE).agg(
        F.sum("_weight").alias("held"), F.max("_within").alias("last"), F.max(_AT).alias("at")
    )
    source = Window.partitionBy(_SOURCE)
    earlier = source.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    spanning = sums.withColumns(
        {"offset": F.coalesce(F.sum("held").over(earlier), F.lit(0)), "ranges": F.count("*").over(source)}
    ).where("ranges > 1")
    found: dict[str, list] = {}
    for r in spanning.orderBy(*_RANGE).collect():
        found.setdefault(r[_SOURCE], []).append((r["_piece"], r["offset"], r["offset"] + r["last"], r["at"]))
    names = ("piece", "offset", "last", "at")
    return {s: dict(zip(names, np.array(rows, np.int64).T, strict=True)) for s, rows in found.items()}


def _entries(numbers: DataFrame, ends: dict, limit: int, delay: int) -> DataFrame:
    """Where the first batch of a range begins: (source, piece, _entry), of sources in several ranges."""
    spark = numbers.sparkSession
    if not ends:
        return spark.createDataFrame([], f"{_SOURCE} string, _piece int, _entry long")
    # Ranges of one source alone never lead on. The names are bounded by the ranges, like ``ends``.
    spanning = numbers.where(F.col(_SOURCE).isin(list(ends)))

    def leaving(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, known = rows.sort_values("_row"), ends[key[0]]
        before, at = rows["_within"].to_numpy() + _offset(known, key[1]), rows[_AT].to_numpy()
        out = np.flatnonzero(_following(before, at, limit, delay) == len(rows))
        bytes_from, at_from = before[out] + limit, at[out] + delay
        to = np.minimum(np.searchsorted(known["last"], bytes_from), np.searchsorted(known["at"], at_from))
        led = to < len(known["piece"])
        return pd.DataFrame(
            {
                _SOURCE: key[0],
                "_from": np.int32(key[1]),
                "_out": out[led],
                "_piece": known["piece"][to[led]].astype(np.int32),
                "_bytes_from": bytes_from[led],
                "_at_from": at_from[led],
            }
        )

    schema = f"{_SOURCE} string, _from int, _out long, _piece int, _bytes_from long, _at_from long"
    first = [(s, _BEFORE, 0, int(known["piece"][0]), 0, _EARLIEST) for s, known in ends.items()]
    led = spanning.groupBy(*_RANGE).applyInPandas(leaving, schema).unionByName(spark.createDataFrame(first, schema))

    def entering(key: tuple, rows: pd.DataFrame, led: pd.DataFrame) -> pd.DataFrame:
        rows, n = rows.sort_values("_row"), len(rows)
        before, at = rows["_within"].to_numpy() + _offset(ends[key[0]], key[1]), rows[_AT].to_numpy()
        last = np.arange(n)  # the last batch of this range, if a batch begins at this chunk
        for i, j in reversed(list(enumerate(_following(before, at, limit, delay).tolist()))):
            if j < n:
                last[i] = last[j]
        entry = np.minimum(
            np.searchsorted(before, led["_bytes_from"].to_numpy()), np.searchsorted(at, led["_at_from"].to_numpy())
        )
        edges = led[[_SOURCE, "_from", "_out", "_piece"]]
        return edges.assign(_entry=entry.astype(np.int64), _to=last[entry].astype(np.int64))

    schema = f"{_SOURCE} string, _from int, _out long, _piece int, _entry long, _to long"
    edges = spanning.groupBy(*_RANGE).cogroup(led.groupBy(*_RANGE)).applyInPandas(entering, schema).checkpoint()
    return _reached(edges, max(len(known["piece"]) for known in ends.values())).select(*_RANGE, "_entry")


def _offset(known: dict[str, np.ndarray], piece: int) -> int:
    return int(known["offset"][np.searchsorted(known["piece"], piece)])


def _reached(edges: DataFrame, ranges: int) -> DataFrame:
    """The edges on the way from the first chunk of each source, by doubling."""
    node = [_SOURCE, "_from", "_out"]
    jump = edges.select(*node, F.col("_piece").alias("_far"), F.col("_to").alias("_far_out"))
    on_way = edges.where(F.col("_from") == _BEFORE).select(*node)
    far = [_SOURCE, F.col("_far").alias("_from"), F.col("_far_out").alias("_out")]
    for _ in range(ranges.bit_length()):
        on_way = on_way.unionByName(on_way.join(jump, node).select(*far)).checkpoint()
        left = jump.select(*node, F.col("_far").alias("_mid"), F.col("_far_out").alias("_mid_out"))
        right = jump.select(
            _SOURCE, F.col("_from").alias("_mid"), F.col("_out").alias("_mid_out"), "_far", "_far_out"
        )
        jump = left.join(right, [_SOURCE, "_mid", "_mid_out"]).select(*node, "_far", "_far_out").checkpoint()
    return edges.join(on_way, node)
