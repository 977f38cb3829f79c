"""The trie of conversation prefixes, through composable fingerprints of turns.

Each turn is an affine map ``x -> a x + b`` modulo the prime 2^61 - 1, taken from hashes of its role and text.
Maps compose associatively, do not commute, and have inverses: the product of a conversation's first turns
is the fingerprint of that prefix. A rebuilt conversation, the first ``h`` turns of a base conversation and
then its own turns after its first ``h``, needs no text: with the base's product ``H`` and the product ``K`` of
its own first ``h`` turns, its prefix that ends at its own turn ``i`` has the fingerprint ``H K^-1 P(i)``.

Turns are dealt by ranges of (base, conversation, turn), so one conversation may span tasks; each task
composes its own turns, and what a conversation has in earlier tasks is composed from one row per task. The
first ``NEAR`` turns of the few conversations on one base meet in one group; turns beyond join their
conversation's factor ``H K^-1``.

Nodes are groups of equal (depth, fingerprint). Equality is verified, not assumed: all members of a node
must refer to the same turn content and to the same parent node, and all turns of one content must have the
same role and text. That proves every prefix by induction over its depth. If any group fails, all
fingerprints are taken anew with another seed.

Subtree sums need no walk. A node belongs to its smallest member, so each conversation owns the end of its
path from some depth on; what a subtree holds is what its members own in it, one sum per node.

Rows of equal turn are in the order of their role, the first 64 characters of their text, and its hash.
Defined results: null turns come first; a null role or text is empty; rows with a null conversation are left
out; repeated rows are turns of their own; long texts are hashed whole; a base that is absent gives no
turns; an empty table gives no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import and_
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, written

#: Conversations of a block of so many ids share the first one as base.
SHARED = 5
#: A head has fewer turns than this.
HEADS = 9
#: Own turns that are rebuilt together with their conversation's neighbours.
NEAR = 32
_PRIME = (1 << 61) - 1
#: Ids in one piece of the text that a node's ends are hashed from.
_PIECE = 2_000
_TRIES = 5

Map = tuple[int, int]
ONE: Map = (1, 0)


def then(first: Map, second: Map) -> Map:
    """The map that applies ``second`` inside ``first``: the product of two runs of turns."""
    return first[0] * second[0] % _PRIME, (first[0] * second[1] + first[1]) % _PRIME


def inverse(m: Map) -> Map:
    a = pow(m[0], -1, _PRIME)
    return a, -a * m[1] % _PRIME


def turn_map(one: int, two: int) -> Map:
    return one % (_PRIME - 1) + 1, two % _PRIME


def head_length(conv_id: int) -> int:
    return crc32(str(conv_id).encode()) % HEADS


def _base(conv: Column) -> Column:
    return conv - conv % SHARED


#: ``n`` counts a conversation's turns from 1; (a, b) is the product of its turns before this one.
_PLACED = "part int, base long, conv long, n long, a long, b long, one long, two long, size long, before long, last boolean"
_PLACED_NAMES = [f.split()[0] for f in _PLACED.split(", ")]
_PLACED_KINDS = [pa.int32()] + [pa.int64()] * 9 + [pa.bool_()]


def _batch(schema_names: list[str], kinds: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema_names)


def _place(batches: Batches) -> Batches:
    """Sorted turns with what comes before them in their conversation, as far as this task has it."""
    current, n, product, size = None, 0, ONE, 0
    held: tuple | None = None
    for batch in batches:
        rows = []
        for part, base, conv, one, two, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held is not None:
                rows.append((*held, conv != current))
            if conv != current:
                current, n, product, size = conv, 0, ONE, 0
            n += 1
            held = (part, base, conv, n, *product, one, two, length, size)
            product, size = then(product, turn_map(one, two)), size + length
        yield _batch(_PLACED_NAMES, _PLACED_KINDS, rows)
    if held is not None:
        yield _batch(_PLACED_NAMES, _PLACED_KINDS, [(*held, True)])


def _contents(turns: DataFrame, seed: int, bits: int) -> DataFrame:
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = turns.select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), text.alias("text"))

    def hashed(k: int) -> Column:
        h = F.xxhash64(F.lit(f"{seed}-{k}"), "role", "text")
        return F.shiftrightunsigned(h, 64 - bits) if bits < 64 else h

    return turns.where("conv IS NOT NULL").withColumns({"one": hashed(1), "two": hashed(2)})


def _placed(contents: DataFrame) -> DataFrame:
    """Every turn with its place in its conversation and the product of the turns before it."""
    ordered = contents.select(
        _base(F.col("conv")).alias("base"),
        "conv",
        "turn",
        "role",
        F.substring("text", 1, 64).alias("begin"),
        "one",
        "two",
        F.octet_length("text").cast("long").alias("size"),
    )
    keys = ["base", "conv", F.asc_nulls_first("turn"), "role", "begin", "one", "two"]
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select(F.spark_partition_id().alias("part"), "base", "conv", "one", "two", "size")
    local = written(ordered.mapInArrow(_place, _PLACED), "turns")

    # Only the conversation at a task's end goes on in the next: one row per task and end.
    ends = local.groupBy("part").agg(F.min(F.struct("base", "conv")).alias("low"), F.max(F.struct("base", "conv")).alias("high"))
    rims = ends.select("part", F.explode(F.array_distinct(F.array("low.conv", "high.conv"))).alias("conv"))
    rims = local.join(rims, ["part", "conv"], "left_semi").where("last")
    carried, going_on = _carries(sorted(tuple(r) for r in rims.select(*_PLACED_NAMES[:-1]).collect()))
    if not carried:
        return local

    def shift(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part, base, conv, n, a, b, one, two, size, before, last = row
                m, product, sizes = carried.get((part, conv), (0, ONE, 0))
                last = last and (part, conv) not in going_on
                rows.append((part, base, conv, n + m, *then(product, (a, b)), one, two, size, before + sizes, last))
            yield _batch(_PLACED_NAMES, _PLACED_KINDS, rows)

    return local.mapInArrow(shift, _PLACED)


def _carries(rims: list[tuple]):
    """What conversations bring from earlier tasks, and which (task, conversation) go on in a later one."""
    carried, going_on = {}, set()
    sums: dict[int, tuple] = {}
    for part, _, conv, n, a, b, one, two, size, before in rims:
        total = (n, then((a, b), turn_map(one, two)), size + before, part)
        if conv in sums:
            m, product, sizes, last_part = sums[conv]
            carried[part, conv] = (m, product, sizes)
            going_on.add((last_part, conv))
            total = (m + n, then(product, total[1]), sizes + total[2], part)
        sums[conv] = total
    return carried, going_on


#: A prefix of a rebuilt conversation: a row at its node. ``whole`` are all bytes of the rebuilt conversation.
_PREFIXES = (
    "conv long, depth long, a long, b long, parent_a long, parent_b long, one long, two long, "
    "size long, before long, whole long, ends boolean"
)
_PREFIX_NAMES = [f.split()[0] for f in _PREFIXES.split(", ")]
_PREFIX_KINDS = [pa.int64()] * 11 + [pa.bool_()]
#: What a conversation's turns beyond the first ones need: the factor before their products, and shifts.
_FACTOR = "factor_a long, factor_b long, deeper long, earlier long"
_FACTOR_NAMES = [f.split()[0] for f in _FACTOR.split(", ")]
_FACTOR_KINDS = [pa.int64()] * 4


def _rebuilt(near: int):
    """Groups of one base to prefixes, and a factor on the root row of each conversation."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows: list[tuple] = []
            for base, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own: dict[int, list[dict]] = {}
                for t in sorted(turns, key=lambda t: t["n"]):
                    own.setdefault(t["conv"], []).append(t)
                for conv, mine in own.items():
                    rows += _one(conv, mine, own.get(base, []), near)
            yield _batch(_PREFIX_NAMES + _FACTOR_NAMES, _PREFIX_KINDS + _FACTOR_KINDS, rows)

    return run


def _after(t: dict) -> Map:
    return then((t["a"], t["b"]), turn_map(t["one"], t["two"]))


def _one(conv: int, mine: list[dict], base: list[dict], near: int) -> list[tuple]:
    """Prefixes of one conversation from its first turns and its last, and those of its base."""
    h = head_length(conv)
    head = base[: min(h, base[-1]["n"] if base else 0)]
    length = mine[-1]["n"]
    skipped = min(h, length)
    brought = _after(head[-1]) if head else ONE
    left = _after(mine[skipped - 1]) if skipped else ONE
    factor = then(brought, inverse(left))
    head_size = head[-1]["before"] + head[-1]["size"] if head else 0
    left_size = mine[skipped - 1]["before"] + mine[skipped - 1]["size"] if skipped else 0
    whole = head_size + mine[-1]["before"] + mine[-1]["size"] - left_size
    deepest = len(head) + length - skipped
    extra = (*factor, len(head) - skipped, head_size - left_size)
    rows = [(conv, 0, *ONE, *ONE, 0, 0, 0, 0, whole, deepest == 0, *extra)]
    for t in head:
        rows.append((conv, t["n"], *_after(t), t["a"], t["b"], t["one"], t["two"], t["size"], t["before"], whole, t["n"] == deepest, *extra))
    for t in mine[skipped:]:
        if t["n"] <= near:
            depth, parent = t["n"] + extra[2], then(factor, (t["a"], t["b"]))
            node = then(parent, turn_map(t["one"], t["two"]))
            rows.append((conv, depth, *node, *parent, t["one"], t["two"], t["size"], t["before"] + extra[3], whole, depth == deepest, *extra))
    return rows


def _beyond(batches: Batches) -> Batches:
    """Turns beyond the first ones, with their conversation's factor, to prefixes."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            parent = then((r["factor_a"], r["factor_b"]), (r["a"], r["b"]))
            node = then(parent, turn_map(r["one"], r["two"]))
            depth, before = r["n"] + r["deeper"], r["before"] + r["earlier"]
            rows.append((r["conv"], depth, *node, *parent, r["one"], r["two"], r["size"], before, r["whole"], r["last"]))
        yield _batch(_PREFIX_NAMES, _PREFIX_KINDS, rows)


def _prefixes(contents: DataFrame, near: int) -> DataFrame:
    placed = _placed(contents)
    entry = F.struct("conv", "n", "a", "b", "one", "two", "size", "before")
    groups = placed.where((F.col("n") <= near) | F.col("last")).groupBy("base").agg(F.collect_list(entry).alias("turns"))
    first = written(groups.mapInArrow(_rebuilt(near), f"{_PREFIXES}, {_FACTOR}"), "first-prefixes")
    late = placed.where(F.col("n") > near)
    factors = first.where("depth = 0").select("conv", "whole", *_FACTOR_NAMES)
    rest = late.join(factors, "conv").select("conv", "n", "a", "b", "one", "two", "size", "before", "last", "whole", *_FACTOR_NAMES)
    return first.select(*_PREFIX_NAMES).unionByName(written(rest.mapInArrow(_beyond, _PREFIXES), "later-prefixes"))


_NODE = ["depth", "a", "b"]
_CONTENT = ["parent_a", "parent_b", "one", "two"]


def _nodes(prefixes: DataFrame) -> DataFrame:
    """One row per node, with its smallest member, and whether its members agree."""
    agree = reduce(and_, [F.min(c) == F.max(c) for c in _CONTENT])
    return prefixes.groupBy(*_NODE).agg(
        F.min("conv").alias("conv"),
        F.count("*").alias("n_convs"),
        F.count_if("ends").alias("n_ends"),
        F.sum("whole").alias("whole"),
        F.min("before").alias("before"),
        F.min("size").alias("size"),
        *[F.min(c).alias(c) for c in ("parent_a", "parent_b")],
        agree.alias("agree"),
    )


def _verified(turns: DataFrame, near: int, bits: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
    """Prefixes and nodes whose equal fingerprints are proven to stand for equal turns."""
    for seed in range(_TRIES):
        contents = _contents(turns, seed, bits[min(seed, len(bits) - 1)])
        text = F.struct("role", "text")
        mixed = contents.groupBy("one", "two").agg(F.min(text).alias("low"), F.max(text).alias("high")).where("low != high")
        if not mixed.isEmpty():
            continue
        prefixes = _prefixes(contents, near)
        nodes = written(_nodes(prefixes), "nodes")
        if nodes.where("NOT agree").isEmpty():
            return prefixes, nodes
    raise RuntimeError(f"fingerprints of different prefixes are equal under {_TRIES} seeds")


def _end_digests(prefixes: DataFrame) -> DataFrame:
    """Per node the digest of its members that end there, from pieces of their sorted ids."""
    names = [*_NODE, "low", "piece"]
    kinds = [pa.int64()] * 4 + [pa.string()]

    def pieces(batches: Batches) -> Batches:
        for batch in batches:
            rows, node, ids = [], None, []
            for depth, a, b, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, a, b) != node or len(ids) == _PIECE:
                    if ids:
                        rows.append((*node, ids[0], ",".join(map(str, ids))))
                    node, ids = (depth, a, b), []
                ids.append(conv)
            if ids:
                rows.append((*node, ids[0], ",".join(map(str, ids))))
            yield _batch(names, kinds, rows)

    def digest(batches: Batches) -> Batches:
        node = found = None
        for batch in batches:
            rows = []
            for depth, a, b, _, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, a, b) == node:
                    found.update(b"," + piece.encode())
                    continue
                if node is not None:
                    rows.append((*node, found.hexdigest()))
                node, found = (depth, a, b), hashlib.sha256(piece.encode())
            yield _batch([*_NODE, "ends_sha256"], [pa.int64()] * 3 + [pa.string()], rows)
        if node is not None:
            yield _batch([*_NODE, "ends_sha256"], [pa.int64()] * 3 + [pa.string()], [(*node, found.hexdigest())])

    ended = prefixes.where("ends").select(*_NODE, "conv")
    ranged = ended.repartitionByRange(*_NODE, "conv").sortWithinPartitions(*_NODE, "conv")
    cut = ranged.mapInArrow(pieces, "depth long, a long, b long, low long, piece string")
    return cut.repartition(*_NODE).sortWithinPartitions(*_NODE, "low").mapInArrow(
        digest, "depth long, a long, b long, ends_sha256 string"
    )


def trie(turns: DataFrame, near: int = NEAR, bits: tuple[int, ...] = (64,)) -> DataFrame:
    """One row per node. ``bits`` narrows the hashes of a try, for tests."""
    prefixes, nodes = _verified(turns, near, bits)
    # what each conversation owns: the end of its path, from the depth where it is the smallest member
    owners = written(
        nodes.groupBy("conv").agg(
            F.min("depth").alias("from_depth"),
            F.max("depth").alias("deepest"),
            F.sum("size").alias("own_size"),
            F.min("before").alias("own_before"),
            F.max(F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"),
        ),
        "owners",
    )
    # what it brings to nodes above, which belong to others; its own nodes' parent is the last of them
    above = prefixes.join(owners.where("from_depth > 0"), "conv").where("depth < from_depth")
    last = F.col("depth") == F.col("from_depth") - 1
    brought = above.groupBy(*_NODE).agg(
        F.count_if(last).alias("attached"), F.sum("own_size").alias("brought_size"), F.sum("leaf").alias("brought_leaves")
    )
    entries = above.where(last).select(*_NODE, F.col("conv").alias("child"))
    parents = entries.join(nodes.select(*_NODE, "conv"), _NODE).select(
        F.col("child").alias("conv"), F.col("conv").alias("parent_conv_id")
    )
    full = nodes.join(brought, _NODE, "left").join(_end_digests(prefixes), _NODE, "left")
    full = full.join(owners.join(parents, "conv", "left"), "conv")
    none = F.lit(0)
    own_below = F.col("own_size") - (F.col("before") - F.col("own_before"))
    texts_once = own_below + F.coalesce("brought_size", none)
    texts_each = F.col("whole") - F.col("n_convs") * F.col("before")
    first = F.col("depth") == F.col("from_depth")
    return full.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(first, F.col("parent_conv_id")).otherwise(F.col("conv")).alias("parent_conv_id"),
        "n_convs",
        ((F.col("deepest") > F.col("depth")).cast("long") + F.coalesce("attached", none)).alias("n_children"),
        (F.col("leaf") + F.coalesce("brought_leaves", none)).alias("n_leaves"),
        (texts_each - texts_once).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
