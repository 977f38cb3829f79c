"""Approximate nearest neighbours by inner product: adaptive dimension scans of probed lists.

Vectors get one more coordinate that makes all norms equal, so the largest inner product is the
smallest distance, and are turned by a random rotation, so that the first ``d`` coordinates are a
fair sample of a distance. Lists are the cells of k-means centres fitted on a bounded sample
(``FITTED`` vectors; every vector is indexed). A list is stored in blocks of at most ``BLOCK``
vectors, each as columns of ``STEP`` coordinates. For a batch of queries, a block is read column
group by column group: a candidate whose partial distance, scaled up and less its error bound,
already exceeds the query's ``k``-th best so far fails the test and is abandoned. Survivors are
scored exactly on the original vectors in double precision.

Blocks and query batches are rows that meet by list, so a list of any size is many pairs of
bounded rows. Defined results: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part; repeated vectors are candidates each; ties go to the
smaller id; a null id takes no part; an empty table gives no rows. A query whose lists hold fewer
than ``k`` candidates probes further ones, so fewer come back only if there are no more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, written

NEIGHBOURS = 20
#: Bound of the sample that centres are fitted on.
FITTED = 20_000
#: Lists: the root of the number of vectors over ``ROOT_SHARE``, within these bounds.
ROOT_SHARE = 8
LEAST_LISTS, MOST_LISTS = 32, 4_096
#: Share of the lists that a query probes, and at least so many.
PROBED_SHARE = 0.8
LEAST_PROBED = 16
BLOCK = 2_048
STEP = 16
#: Width of the test: larger abandons later and errs less.
ERROR = 2.5
SEED = 7
_MOST_BOUNDS = 500_000

HITS = "query_id long, vec_id long, score double"


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Finite, non-zero vectors with an id, as doubles; the length is the most frequent one."""
    v = F.col("v")
    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return chosen.where(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _centres(sample: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from distinct sample points."""
    points = np.unique(sample, axis=0)
    centres = points[rng.permutation(len(points))[:lists]]
    for _ in range(8):
        cell = _nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        counts = np.bincount(cell, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` nearest centres of each point, nearest first."""
    apart = (centres**2).sum(1)[None, :] - 2 * points @ centres.T
    if n >= len(centres):
        return np.argsort(apart, axis=1, kind="stable")
    some = np.argpartition(apart, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(apart, some, 1), axis=1, kind="stable"), 1)


class Space:
    """Rotation, norm and centres: what a task needs to place a vector; its size is bounded."""

    def __init__(self, sample: np.ndarray, norm: float, lists: int, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.norm = norm
        self.rotation = np.linalg.qr(rng.standard_normal((sample.shape[1] + 1,) * 2))[0]
        self.centres = _centres(self.stored(sample), max(1, lists), rng)

    def stored(self, vectors: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(1), 0))
        return np.c_[vectors, more] @ self.rotation

    def asked(self, vectors: np.ndarray) -> np.ndarray:
        return np.c_[vectors, np.zeros(len(vectors))] @ self.rotation


def adaptive_scan(
    block: np.ndarray, query: np.ndarray, k: int, bound: float = np.inf, step: int = STEP, error: float = ERROR
) -> tuple[np.ndarray, float]:
    """Rows of the block that may be among the query's ``k`` nearest, by partial distances.

    ``bound`` is the ``k``-th best squared distance known so far; the better one comes back.
    """
    n, dims = block.shape
    seed = min(n, 4 * k)
    if seed >= k:
        first = np.partition(((block[:seed] - query) ** 2).sum(1), k - 1)[k - 1]
        bound = min(bound, first * (1 + 1e-9) + 1e-12)  # sums in another order may differ in their last bits
    alive, partial = np.arange(n), np.zeros(n)
    for d in range(0, dims, step):
        part = block[alive, d : d + step] - query[d : d + step]
        partial = partial + np.einsum("ij,ij->i", part, part)
        seen = min(d + step, dims)
        # the scaled partial distance must stay within its error of the k-th best
        limit = bound * (seen / dims) * (1 + error / np.sqrt(seen)) ** 2 if seen < dims else bound
        keep = partial <= limit
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    if len(alive) >= k:
        bound = min(bound, np.partition(partial, k - 1)[k - 1] * (1 + 1e-9) + 1e-12)
        alive = alive[partial <= bound]
    return alive, bound


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    probed_share: float = PROBED_SHARE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest found, itself left out."""
    spark = vectors.sparkSession
    usable = _usable(vectors, id_col, vector_col)
    facts = usable.groupBy(F.size("v").alias("dims")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")
    )
    common = facts.orderBy(F.desc("n"), "dims").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, count = common["dims"], common["n"]
    usable = usable.where(F.size("v") == dims)
    lists = int(min(MOST_LISTS, max(LEAST_LISTS, count**0.5 // ROOT_SHARE)))
    drawn = usable.orderBy(F.xxhash64("id"), "id").limit(FITTED).select("v")
    sample = np.array([r["v"] for r in drawn.collect()])
    space = Space(sample, float(np.sqrt(common["square"])), lists)
    probes = int(min(len(space.centres), max(LEAST_PROBED, round(probed_share * len(space.centres)))))

    def place(batches: Batches) -> Batches:
        for batch in batches:
            cell = _nearest(space.stored(_matrix(batch.column(1))), space.centres, 1)[:, 0]
            names = ["cell", "id", "v"]
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), batch.column(0), batch.column(1)], names=names)

    def probe(batches: Batches) -> Batches:
        for batch in batches:
            turned = space.asked(_matrix(batch.column(1)))
            cells = _nearest(turned, space.centres, probes)
            rows, cells = np.repeat(np.arange(batch.num_rows), cells.shape[1]), cells.ravel()
            few = np.flatnonzero(np.bincount(rows, held[cells], batch.num_rows) < k + 1)
            if len(few) and probes < len(space.centres):  # one more than asked for: the query itself may be among them
                order = _nearest(turned[few], space.centres, len(space.centres))
                before = np.cumsum(held[order], axis=1) - held[order]
                more = (before < k + 1) & (np.arange(order.shape[1]) >= probes)
                rows, cells = np.r_[rows, few[np.nonzero(more)[0]]], np.r_[cells, order[more]]
            rows = pa.array(rows)
            columns = [pa.array(cells, pa.int32()), batch.column(0).take(rows), batch.column(1).take(rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["cell", "id", "v"])

    def blocks(most: int):
        """Rows sorted by cell to rows of up to ``most`` vectors of one cell."""

        def run(batches: Batches) -> Batches:
            held: pa.Table | None = None

            def packed(rows: pa.Table) -> pa.RecordBatch:
                ids = rows.column("id").combine_chunks().to_numpy().astype("<i8")
                flat = rows.column("v").combine_chunks().flatten().to_numpy().astype("<f8")
                columns = [pa.array([rows.column("cell")[0].as_py()], pa.int32())]
                columns += [pa.array([ids.tobytes()], pa.binary()), pa.array([flat.tobytes()], pa.binary())]
                return pa.RecordBatch.from_arrays(columns, names=["cell", "ids", "flat"])

            for batch in batches:
                now = pa.Table.from_batches([batch])
                held = now if held is None else pa.concat_tables([held, now])
                cells = held.column("cell").to_numpy()
                starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
                for start, end in zip(starts, np.r_[starts[1:], len(cells)], strict=True):
                    at = start
                    while end - at > most or (end < len(cells) and at < end):
                        n = min(most, end - at)
                        yield packed(held.slice(at, n))
                        at += n
                held = held.slice(at)
            if held is not None and held.num_rows:
                yield packed(held)

        return run

    row = "cell int, ids binary, flat binary"
    # lists of the usual size are some blocks of one task; larger ones are cut further as blocks
    spread = F.pmod(F.xxhash64("id"), F.lit(1 + count // (lists * 8 * BLOCK)))
    placed = usable.mapInArrow(place, "cell int, id long, v array<double>")
    stored = placed.repartition("cell", spread).sortWithinPartitions("cell", "id").mapInArrow(blocks(BLOCK), row)
    stored = written(stored, "vector-blocks")
    held = np.zeros(len(space.centres), np.int64)  # vectors of each list
    for r in stored.groupBy("cell").agg(F.sum(F.octet_length("ids")).alias("bytes")).collect():
        held[r["cell"]] = r["bytes"] // 8
    asked = _usable(queries, id_col, vector_col).where(F.size("v") == dims)
    asked = asked.mapInArrow(probe, "cell int, id long, v array<double>")
    asked = asked.repartition("cell", spread).sortWithinPartitions("cell", "id").mapInArrow(blocks(BLOCK // 4), row)
    asked = asked.select("cell", F.col("ids").alias("query_ids"), F.col("flat").alias("query_flat"))

    def scan(batches: Batches) -> Batches:
        bounds: dict[int, float] = {}  # what this task knows of its queries
        for batch in batches:
            for ids, flat, query_ids, query_flat in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, query_ids = np.frombuffer(ids, "<i8"), np.frombuffer(query_ids, "<i8")
                original = np.frombuffer(flat, "<f8").reshape(len(ids), dims)
                wanted = np.frombuffer(query_flat, "<f8").reshape(len(query_ids), dims)
                block, turned = space.stored(original), space.asked(wanted)
                if len(bounds) > _MOST_BOUNDS:
                    bounds = {}
                hits: list[list[np.ndarray]] = [[], [], []]
                for i, q in enumerate(query_ids):
                    # one more than asked for: the query itself may be among them
                    found, bounds[q] = adaptive_scan(block, turned[i], k + 1, bounds.get(q, np.inf))
                    found = found[ids[found] != q]
                    scores = (original[found] * wanted[i]).sum(1)
                    for column, values in zip(hits, (np.full(len(found), q), ids[found], scores), strict=True):
                        column.append(values)
                kinds = [pa.int64(), pa.int64(), pa.float64()]
                arrays = [pa.array(np.concatenate(c), t) for c, t in zip(hits, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])

    pairs = stored.join(asked, "cell").select("ids", "flat", "query_ids", "query_flat")
    hits = pairs.mapInArrow(scan, HITS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
