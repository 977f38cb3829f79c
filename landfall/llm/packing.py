"""Mixture-controlled packing of documents into sequences of fixed length.

Each source is a queue of its documents in order of their ids. Deficit round-robin serves the
queues in rounds (windows) of ``window`` tokens: a queue's quantum is its target share of the
window, a fraction of a token that it could not send stays as its deficit for the next round,
and documents are cut where the quantum ends. Served tokens form one stream, which is cut into
sequences of ``length`` tokens, so only the last sequence has padding. A queue that ends before
the others leaves the rest in their proportions.

With deficits carried, queue *i* has sent ``min(total_i, floor(r * quantum_i))`` tokens after
round *r*. Any task can therefore place its pieces from its queue positions alone, and the
deficit crosses windows and partitions without passing through one task.

Defined results: a null or empty text has the end id alone; a null source is a queue of its
own; repeated rows are packed each; an empty table gives no pieces; columns beyond the three
named are not read.
"""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.encoding import encoder
from landfall.llm.shared import Batches, written

SEQUENCE = 4096
WINDOW = 64 * SEQUENCE
#: Queues are named feeds; their totals and weights travel to every task.
MOST_QUEUES = 100_000

ENCODED = "part int, source string, doc_id long, n_tokens long, local_start long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, source string, window long"
)


class Rounds:
    """What each queue has sent after each round, in exact integers."""

    def __init__(self, totals: list[int], weights: list[Fraction], window: int):
        whole = sum(weights)
        self.totals = totals
        self.quanta = [Fraction(w) * window / whole for w in weights]
        self._parts = [(q.numerator, q.denominator) for q in self.quanta]
        self._memo: tuple = (None, 0, 0, 0)

    def sent(self, queue: int, rounds: int) -> int:
        a, b = self._parts[queue]
        return min(self.totals[queue], rounds * a // b)

    def window_of(self, queue: int, position: int) -> int:
        """The round, from 1, that sends the queue's token at this position."""
        a, b = self._parts[queue]
        return -(-(position + 1) * b // a)

    def turn(self, queue: int, window: int) -> tuple[int, int, int]:
        """Queue positions of one turn, from and to, and its place in the stream."""
        key, *turn = self._memo
        if key != (queue, window):
            before = sum(self.sent(j, window) for j in range(queue))
            after = sum(self.sent(j, window - 1) for j in range(queue, len(self.totals)))
            turn = [self.sent(queue, window - 1), self.sent(queue, window), before + after]
            self._memo = ((queue, window), *turn)
        return turn[0], turn[1], turn[2]


def encode_queues(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, source_col: str
) -> DataFrame:
    """Ids of each document, and its place within its task's share of its queue."""

    def run(batches: Batches) -> Batches:
        encode = encoder(tokenizer)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        part = TaskContext.get().partitionId()
        current, place, first = None, 0, True
        for batch in batches:
            ids = [encode.encode(t or "") + end for t in batch.column(2).to_pylist()]
            sources, starts = batch.column(0).to_pylist(), []
            lengths = [len(i) // len(end) for i in ids]
            for source, n in zip(sources, lengths, strict=True):
                if first or source != current:
                    current, place, first = source, 0, False
                starts.append(place)
                place += n
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(ids), pa.int32()),
                    batch.column(0),
                    batch.column(1),
                    pa.array(lengths, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["part", "source", "doc_id", "n_tokens", "local_start", "ids"],
            )

    return (
        docs.select(
            F.col(source_col).cast("string").alias("source"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(text_col).alias("text"),
        )
        .repartitionByRange("source", "doc_id")
        .sortWithinPartitions("source", "doc_id", "text")
        .mapInArrow(run, ENCODED)
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    targets: dict[str, float] | None = None,
    length: int = SEQUENCE,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per piece. ``targets``: shares of tokens by source; a source without one, or all
    of them by default, aims at its share of the corpus."""
    encoded = written(encode_queues(docs, tokenizer, end_id, id_col, text_col, source_col), "packing")
    shares = encoded.groupBy("source", "part").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per task and queue in it: tasks hold ranges, so tasks plus queues rows at most
    bases = shares.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).collect()
    queues = sorted({r["source"] for r in bases}, key=lambda s: (s is not None, s or ""))
    if len(queues) > MOST_QUEUES:
        raise ValueError(f"{len(queues)} sources: give a coarser column, at most {MOST_QUEUES} values")
    number = {s: i for i, s in enumerate(queues)}
    totals = [0] * len(queues)
    for r in bases:
        totals[number[r["source"]]] += r["n"]
    base_of = {(r["source"], r["part"]): r["base"] for r in bases}
    corpus = sum(totals)
    weights = [
        Fraction((targets or {})[s]) if s in (targets or {}) else Fraction(totals[i], corpus)
        for i, s in enumerate(queues)
    ]
    if any(w <= 0 for w in weights):
        raise ValueError("target shares must be above zero, for every document is packed")

    def run(batches: Batches) -> Batches:
        rounds = Rounds(totals, weights, window)
        item = encoder(tokenizer).dtype
        for batch in batches:
            rows: list[tuple] = []
            parts, sources, doc_ids, lengths, starts, texts = (c.to_pylist() for c in batch.columns)
            for part, source, doc, n, local, raw in zip(
                parts, sources, doc_ids, lengths, starts, texts, strict=True
            ):
                queue, at = number[source], base_of[source, part] + local
                ids = np.frombuffer(raw, item).astype("<u4").tobytes()
                done, turn = 0, rounds.window_of(queue, at)
                while done < n:
                    begin, until, stream = rounds.turn(queue, turn)
                    place = stream + at + done - begin
                    take = min(n - done, until - at - done, length - place % length)
                    crc = zlib.crc32(ids[4 * done : 4 * (done + take)])
                    rows.append((doc, done, take, crc, n, place // length, place % length, source, turn))
                    done += take
                    if at + done == until:
                        turn += 1
                        while done < n and rounds.sent(queue, turn) == until:
                            turn += 1
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 7 + [pa.string(), pa.int64()]
            names = [field.split()[0] for field in PIECES.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return encoded.mapInArrow(run, PIECES)
