"""N-gram Jaccard join under several global token orders, to the components of its links.

A document's tokens are its distinct word n-grams, as 64-bit hashes. In any order of all tokens,
two sets that are similar enough share a token among the first few of each (their prefixes), and
the places of the first shared token bound their overlap. Candidates come from the first order's
prefixes and places; they stay only if the prefixes under every further order meet as well (parity sketches, which
bound the difference of two sets from below, spare most of them that step); what is left is verified
on the whole sets. All orders put frequent tokens last (the counts cover all
documents; ``MOST_FREQUENT`` of them travel to every task, the rest is ordered by hash alone), so
a passage that many documents share is in few prefixes.

Equal sets are one class from the start, so copies cost nothing. A group of a prefix token with up
to ``ALL_PAIRS`` classes yields its candidates directly. A larger group, such as the near copies of
one document, yields for each class a pair with the class that has the fewest rare tokens and one
with its neighbour by size; after these are verified and joined to components, only pairs that still
lie in different components are candidates of the group, so no group's pairs are all made.

Defined results: a null or empty text, or one without words, has the empty set, is linked with
nothing and is its own component; fewer words than ``n`` make one token; repeated rows are one
class; a null id is never the name of a component; an empty table gives no rows. Sets and tokens
are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.encoding import Memo
from landfall.llm.shared import Batches, shuffle_width, written

WORDS = 4
PERCENT = 85
ORDERS = 3
ALL_PAIRS = 24
MOST_FREQUENT = 200_000
#: Tokens a task counts before it passes the frequent ones on, and what counts as frequent there.
_COUNTED = 4_000_000
_LOCALLY_FREQUENT = 3
_MEMO_WORDS = 500_000

_ONE = np.uint64(0x9E3779B97F4A7C15)
_TWO = np.uint64(0xBF58476D1CE4E5B9)
_THREE = np.uint64(0x94D049BB133111EB)
#: Odd factors that make the hash orders.
_ORDERS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _TWO
    h = (h ^ (h >> np.uint64(27))) * _THREE
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _word_hashes() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest, _MEMO_WORDS)


def token_set(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams, A-Z lower-cased, words cut at ASCII blanks."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    hashes = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    grams = hashes[: len(hashes) - n + 1]
    for i in range(1, n):
        grams = _mixed(grams * _ONE + hashes[i : len(hashes) - n + 1 + i])
    return np.unique(grams)


def set_id(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def least_overlap(sizes, percent: int = PERCENT):
    """Tokens that sets of these summed sizes must share: the smallest o with 100 o >= p (sizes - o)."""
    return -(-percent * sizes // (100 + percent))


def _rows(names: list[str], kinds: list[pa.DataType], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


_SCANNED = "kind int, doc_id long, text_key long, set_id long, n long"
_SCANNED_NAMES = ["kind", "doc_id", "text_key", "set_id", "n"]
_SCANNED_KINDS = [pa.int32()] + [pa.int64()] * 4


def _scan(words: int) -> Callable[[Batches], Batches]:
    """Kind 0: a document's class. Kind 1: a token (in set_id) and how often the task counted it (n)."""

    def run(batches: Batches) -> Batches:
        pending: list[np.ndarray] = []
        held = 0

        def counted() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(pending), return_counts=True)
            often = counts >= _LOCALLY_FREQUENT
            m = int(often.sum())
            empty = [None] * m
            found = [[1] * m, empty, empty, values[often].view(np.int64), counts[often].astype(np.int64)]
            return _rows(_SCANNED_NAMES, _SCANNED_KINDS, found)

        for batch in batches:
            ids, sizes = [], []
            for text in batch.column(2).to_pylist():
                tokens = token_set(text or "", words)
                ids.append(set_id(tokens))
                sizes.append(len(tokens))
                pending.append(tokens)
                held += len(tokens)
                if held >= _COUNTED:
                    yield counted()
                    pending, held = [], 0
            yield _rows(
                _SCANNED_NAMES,
                _SCANNED_KINDS,
                [[0] * len(ids), batch.column(0), batch.column(1), ids, sizes],
            )
        if pending:
            yield counted()

    return run


class Orders:
    """The global orders: by how frequent a token is (to the power of two), then by one hash each."""

    def __init__(self, frequent: list[tuple[int, int]]):
        tokens = np.array([t for t, _ in frequent], np.int64).view(np.uint64)
        levels = np.array([int(c).bit_length() for _, c in frequent], np.uint64)
        by = np.argsort(tokens)
        self.tokens, self.levels = tokens[by], levels[by]

    def prefixes(self, tokens: np.ndarray, length: int, orders: int) -> list[np.ndarray]:
        """The first ``length`` tokens under each order, in order."""
        level = np.zeros(len(tokens), np.uint64)
        if len(self.tokens):
            at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
            level = np.where(self.tokens[at] == tokens, self.levels[at], np.uint64(0))
        high = level << np.uint64(57)
        found = []
        for factor in _ORDERS[:orders]:
            keys = high | (_mixed(tokens * np.uint64(factor)) >> np.uint64(7))
            first = np.argpartition(keys, length - 1)[:length] if length < len(keys) else np.arange(len(keys))
            found.append(tokens[first[np.argsort(keys[first])]])
        return found


#: Bits of the sketch of a set: each the parity of how many of its tokens hash there.
_SKETCH_BITS = 512
_PREFIXES = "set_id long, n long, tokens array<long>, others binary, sketch binary"


def sketch(tokens: np.ndarray) -> bytes:
    """The size of the set and its parity bits. Sets differ in at least as many tokens as bits."""
    bit = (_mixed(tokens * np.uint64(_ORDERS[-1])) & np.uint64(_SKETCH_BITS - 1)).astype(np.int64)
    odd = np.bincount(bit, minlength=_SKETCH_BITS) & 1
    return np.uint64(len(tokens)).astype("<u8").tobytes() + np.packbits(odd.astype(np.uint8)).tobytes()


def _sketches_fit(percent: int):
    """Keeps candidates whose parity bits differ in few enough places for the overlap."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, 8 + _SKETCH_BITS // 8)
                for i in (2, 3)
            )
            sizes = sum(np.ascontiguousarray(v[:, :8]).view("<u8").ravel().astype(np.int64) for v in (x, y))
            apart = np.bitwise_count(x[:, 8:] ^ y[:, 8:]).sum(axis=1).astype(np.int64)
            keep = (100 + percent) * (sizes - apart) >= 2 * percent * sizes
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _prefix_rows(frequent: list[tuple[int, int]], words: int, percent: int, orders: int):
    """Per class met in a batch: its first prefix, and those of the other orders as 16-bit hashes."""

    def run(batches: Batches) -> Batches:
        order = Orders(frequent)
        for batch in batches:
            seen: set[int] = set()
            ids, sizes, firsts, others, sketches = [], [], [], [], []
            for text in batch.column(0).to_pylist():
                tokens = token_set(text or "", words)
                key = set_id(tokens)
                if not len(tokens) or key in seen:
                    continue
                seen.add(key)
                first, *rest = order.prefixes(tokens, prefix_length(len(tokens), percent), orders)
                ids.append(key)
                sizes.append(len(tokens))
                firsts.append(first.view(np.int64))
                sketches.append(sketch(tokens))
                others.append(b"".join((_mixed(r) >> np.uint64(48)).astype("<u2").tobytes() for r in rest))
            yield _rows(
                ["set_id", "n", "tokens", "others", "sketch"],
                [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary()],
                [ids, sizes, firsts, others, sketches],
            )

    return run


_GROUPED = "kind int, a long, b long, token long, n long, place long"
_GROUPED_NAMES = ["kind", "a", "b", "token", "n", "place"]
_GROUPED_KINDS = [pa.int32()] + [pa.int64()] * 5
#: A candidate; a row of a large group; the hub of a part of a large group.
_PAIR, _MEMBER, _HUB = range(3)
#: A large group is looked at in parts of so many rows, so its size is no matter for memory.
_PART = 20_000
#: Groups of a token that more than this share of the documents holds are dealt over all tasks.
_HOT_SHARE = 0.05
#: Size and place travel in one number.
_PLACE_BITS = 32
#: Up to so many keys of candidates (8 bytes each) are broadcast; more are joined by a shuffle.
_MOST_BROADCAST = 1_000_000


def _fits(n_a, n_b, at_a, at_b, percent: int):
    """Whether sizes and the places of a shared token leave room for the overlap; n_a <= n_b."""
    room = 1 + np.minimum(n_a - at_a - 1, n_b - at_b - 1)
    return (100 * n_a >= percent * n_b) & (room >= least_overlap(n_a + n_b, percent))


def _group_pairs(percent: int, all_pairs: int, hot: list[int], salts: int):
    """Rows sorted by (token, salt, n, place, set_id) to candidates, rows of large groups and their hubs."""

    def pairs_of(t, salt, s, n, p, cut_first: bool, cut_last: bool) -> list[pa.RecordBatch]:
        """Of whole groups, or parts of large ones: the first or last group may be cut."""
        new = (t[1:] != t[:-1]) | (salt[1:] != salt[:-1])
        keep = np.r_[True, new | (s[1:] != s[:-1])]  # a repeated class counts once
        t, salt, s, n, p = t[keep], salt[keep], s[keep], n[keep], p[keep]
        starts = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (salt[1:] != salt[:-1])])
        lengths = np.diff(np.r_[starts, len(t)])
        group = np.repeat(np.arange(len(starts)), lengths)
        # the parts of a salted or cut group count as large however few their rows are
        part = salt[starts] >= 0
        part[0] |= cut_first
        part[-1] |= cut_last
        large = np.repeat((lengths > all_pairs) | part, lengths)
        made = []

        def rows(kind: int, a, b, i):
            kinds = np.full(len(i), kind, np.int32)
            made.append(_rows(_GROUPED_NAMES, _GROUPED_KINDS, [kinds, a, b, t[i], n[i], p[i]]))

        def emit(i, j):
            ok = _fits(n[i], n[j], p[i], p[j], percent)
            i, j = i[ok], j[ok]
            rows(_PAIR, np.minimum(s[i], s[j]), np.maximum(s[i], s[j]), i)

        small = np.flatnonzero(~large)
        of = group[small]
        for d in range(1, all_pairs):
            same = np.flatnonzero(of[d:] == of[:-d]) if len(of) > d else of[:0]
            if not len(same):
                break
            emit(small[same], small[same + d])
        at = np.flatnonzero(large)
        if len(at):
            rows(_MEMBER, s[at], s[at], at)
            follow = np.flatnonzero(group[at[1:]] == group[at[:-1]])
            emit(at[follow], at[follow + 1])
            by = at[np.lexsort((s[at], p[at], group[at]))]
            first = np.r_[True, group[by[1:]] != group[by[:-1]]]
            hub = by[first][np.cumsum(np.r_[True, group[at[1:]] != group[at[:-1]]]) - 1]
            other = at != hub
            i, j = at[other], hub[other]
            emit(np.where(n[i] <= n[j], i, j), np.where(n[i] <= n[j], j, i))
            rows(_HUB, s[by[first]], s[by[first]], by[first])
        return made

    def run(batches: Batches) -> Batches:
        rest: list[np.ndarray] | None = None
        cut_before = False  # the first group of the rest had a part before
        dealt = np.array(sorted(hot), np.int64)
        for batch in batches:
            t, s, size_place = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            salt = np.where(np.isin(t, dealt), np.mod(s, salts), -1)
            now = [t, salt, s, size_place >> _PLACE_BITS, size_place & ((1 << _PLACE_BITS) - 1)]
            now = now if rest is None else [np.concatenate(x) for x in zip(rest, now, strict=True)]
            t, salt = now[:2]
            cut = int(np.flatnonzero((t != t[-1]) | (salt != salt[-1]))[-1]) + 1 if (t[0], salt[0]) != (t[-1], salt[-1]) else 0
            inside = cut == 0 and len(t) > _PART
            if inside:
                cut = len(t) - 1  # a part of a large group; its last row begins the next part
            if cut:
                yield from pairs_of(*(c[:cut] for c in now), cut_before, inside)
                cut_before = inside
            rest = [c[cut:] for c in now]
        if rest is not None and len(rest[0]):
            yield from pairs_of(*rest, cut_before, False)

    return run


def _orders_agree(percent: int, orders: int):
    """Keeps candidates whose prefixes meet under every further order."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p = np.frombuffer(x, "<u2").reshape(orders - 1, -1).tolist()
                q = np.frombuffer(y, "<u2").reshape(orders - 1, -1).tolist()
                keep.append(not any(set(f).isdisjoint(g) for f, g in zip(p, q, strict=True)))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _verify(percent: int, words: int):
    def run(batches: Batches) -> Batches:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = token_set(x, words), token_set(y, words)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def _with_both(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """(a, b, x, y): a column of the table for either member."""
    left = table.select(F.col("set_id").alias("a"), F.col(column).alias("x"))
    right = table.select(F.col("set_id").alias("b"), F.col(column).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")


def components(links: DataFrame) -> DataFrame:
    """(set_id, component) of the linked classes: least labels by neighbours, then by jumps."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both, "links")
    now = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")).select(F.col("a").alias("v"), "c")
    now = written(now, "components")
    while True:
        heard = both.join(now.select(F.col("v").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("m"))
        nearer = now.join(heard, F.col("v") == F.col("a")).select("v", "c", F.least("c", "m").alias("m"))
        onward = now.select(F.col("v").alias("m"), F.col("c").alias("j"))
        step = nearer.join(onward, "m").select("v", F.col("c").alias("was"), F.least("m", "j").alias("c"))
        step = written(step, "components")
        if step.where("c <> was").isEmpty():
            return step.select(F.col("v").alias("set_id"), F.col("c").alias("component"))
        now = step.select("v", "c")


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def classes_and_links(
    docs: DataFrame, words: int, percent: int, orders: int, id_col: str, text_col: str
) -> tuple[DataFrame, DataFrame]:
    """Documents with their classes (doc_id, text_key, set_id, n), and classes with their components."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"), F.col(text_col).alias("text")
    )
    scanned = written(texts.mapInArrow(_scan(words), _SCANNED), "jaccard-scan")
    members = scanned.where("kind = 0").drop("kind")
    counts = scanned.where("kind = 1").groupBy("set_id").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "set_id").limit(MOST_FREQUENT).collect()
    frequent = [(r["set_id"], r["n"]) for r in top]

    prefixes = texts.select("text").mapInArrow(_prefix_rows(frequent, words, percent, orders), _PREFIXES)
    prefixes = written(prefixes, "jaccard-prefixes")
    rows = prefixes.select("set_id", "n", F.posexplode("tokens").alias("place", "token"))
    # at most tokens per document / _HOT_SHARE of them
    least_hot = max(_PART, _HOT_SHARE * members.count())
    hot = [t for t, c in frequent if c > least_hot]
    salts = shuffle_width(docs.sparkSession)
    salt = F.when(F.col("token").isin(hot), F.pmod("set_id", F.lit(salts))).otherwise(-1) if hot else F.lit(-1)
    size_place = F.shiftleft("n", _PLACE_BITS) + F.col("place")
    rows = rows.select("token", "set_id", size_place.alias("size_place"))
    by = ["token", salt] if hot else ["token"]
    sorted_rows = rows.repartition(*by).sortWithinPartitions(*by, "size_place", "set_id")
    grouped = sorted_rows.mapInArrow(_group_pairs(percent, ALL_PAIRS, hot, salts), _GROUPED)
    grouped = written(grouped, "jaccard-groups")
    hubs = grouped.where(F.col("kind") == _HUB).select("token", "a", "place")
    best = hubs.groupBy("token").agg(F.min(F.struct("place", "a")).alias("best")).select("token", "best.a")
    over = hubs.join(best.withColumnRenamed("a", "b"), "token").where("a <> b")
    over = over.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    others = prefixes.groupBy("set_id").agg(F.first("others").alias("others"))
    sketches = prefixes.groupBy("set_id").agg(F.first("sketch").alias("sketch"))

    def agreed(pairs: DataFrame) -> DataFrame:
        near = _with_both(pairs, sketches, "sketch").mapInArrow(_sketches_fit(percent), "a long, b long")
        pairs = written(near, "jaccard-near")
        kept = _with_both(pairs, others, "others").mapInArrow(_orders_agree(percent, orders), "a long, b long")
        return written(kept, "jaccard-candidates") if orders > 1 else pairs

    def verified(pairs: DataFrame) -> DataFrame:
        ends = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "set_id")
        keys = members.join(ends, "set_id").groupBy("set_id").agg(F.min("text_key").alias("text_key"))
        keys = written(keys, "jaccard-keys")
        few = keys.count() <= _MOST_BROADCAST
        wanted = texts.join(F.broadcast(keys) if few else keys, "text_key").select("set_id", "text")
        wanted = written(wanted.dropDuplicates(["set_id"]), "jaccard-texts")
        checked = _with_both(pairs, wanted, "text").mapInArrow(_verify(percent, words), "a long, b long")
        return written(checked, "jaccard-links")

    tried = agreed(grouped.where(F.col("kind") == _PAIR).select("a", "b").unionByName(over).distinct())
    links = verified(tried)
    joined = components(links)

    large = grouped.where(F.col("kind") == _MEMBER).dropDuplicates(["token", "a"])
    large = large.select("token", F.col("a").alias("set_id"), "n", "place")
    large = large.join(joined, "set_id", "left")
    large = written(large.withColumn("component", F.coalesce("component", "set_id")), "jaccard-large")
    sizes = large.groupBy("token", "component").agg(F.count("*").alias("k"))
    main = sizes.groupBy("token").agg(F.max_by("component", F.struct("k", "component")).alias("main"))
    odd = large.join(main, "token").where("component <> main").drop("main")
    x, y = odd.alias("x"), large.alias("y")
    low, high = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    room = 1 + F.least(F.col("x.n") - F.col("x.place") - 1, F.col("y.n") - F.col("y.place") - 1)
    fits = (100 * low >= percent * high) & ((100 + percent) * room >= percent * (low + high))
    apart = (F.col("x.component") != F.col("y.component")) & fits
    late = x.join(y, (F.col("x.token") == F.col("y.token")) & apart)
    late = late.select(
        F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")
    ).distinct()
    late = agreed(late.join(tried, ["a", "b"], "left_anti"))
    if not late.isEmpty():
        joined = components(links.unionByName(verified(late)))
    return members, joined


def similar_documents(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    orders: int = ORDERS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id, text_key) of every row of ``docs``."""
    members, joined = classes_and_links(docs, words, percent, orders, id_col, text_col)
    named = members.join(joined, "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    names = named.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return named.join(names, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("set_id").alias("class_id"),
        "text_key",
    )


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps the row that names it.

    ``found`` is the result of :func:`similar_documents` over ``docs``. Texts without words stay;
    so does one row of a component without any id.
    """
    keyed = docs.withColumn("__key", _text_key(text_col)).withColumn("__id", F.col(id_col).cast("long"))
    empty = ~F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    chosen = (
        found.where("n_shingles > 0 AND doc_id <=> component_id")
        .groupBy(F.coalesce("component_id", "class_id").alias("g"), F.col("doc_id").isNull().alias("unnamed"))
        .agg(F.min(F.struct("doc_id", "text_key")).alias("row"))
        .select(F.col("row.doc_id").alias("__chosen"), F.col("row.text_key").alias("__key"))
    )
    match = (keyed["__key"] == chosen["__key"]) & keyed["__id"].eqNullSafe(chosen["__chosen"])
    stay = keyed.where(~empty).join(chosen, match, "left_semi").dropDuplicates(["__key", "__id"])
    return stay.unionByName(keyed.where(empty)).select(*docs.columns)
