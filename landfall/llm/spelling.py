"""Spelling variants: words one edit apart, found through blocked Gram matrices of letter counts.

Words that differ by one inserted, deleted or replaced character have letter counts at a squared
distance of at most two, which for a block of words is ``|x|^2 + |y|^2 - 2 X Y'``, one NumPy product.
A word of length ``l`` belongs to the length blocks ``l`` (with words of its length and of the next)
and ``l - 1``. Each length block is cut further: of the three thirds of a word, an edit touches one, so
two near words agree in the rest; the blocks are (length, third, rest) and lose no pair. Blocks of
more than ``TILE`` words are dealt into parts whose pairs are tiles of their own, so a frequent stem
is spread over tasks. Candidates at most two apart are verified by their letters. A tile reports per
word the number of its near words and the best of them, never the pairs.

Words are runs of ``[A-Za-z\\u00C0-\\u00FF]``, lower-cased in A-Z only, all of one byte in Latin-1. Forms
have at least ten times the occurrences of their words, so a chain of them has no circle and grows
with the logarithm of the corpus; roots are found by pointer doubling over the distinct forms.

Defined results: a null or empty text has no words, a very long one is scanned whole; a null id
counts as the text ``None`` in the hash; repeated rows count each time; equal counts of near words are
told apart by code points; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, written

LEAST_LETTERS = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as its word.
MORE_FREQUENT = 10
#: One in so many (document, word) pairs loses a character.
DAMAGED = 31
#: Words of a block that one product takes whole; more are dealt into parts.
TILE = 1024
_THIRDS = 3
#: Small blocks are multiplied together, up to so many words.
_TOGETHER = 256
#: Different words that a task counts before it hands them on.
_HELD = 400_000

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_COUNTED = "word string, n long"
_FOUND = "word string, n_near long, form_n long, form string"


def damaged_runs(doc_id, text: str | None, least: int = LEAST_LETTERS) -> Counter:
    """The words of one text with their occurrences, after the stated deletions."""
    found: Counter = Counter()
    runs = re.findall(f"[A-Za-zÀ-ÿ]{{{least},}}", text or "")
    for run, n in Counter(r.translate(_LOWER) for r in runs).items():
        h = crc32(f"{doc_id}:{run}".encode())
        if h % DAMAGED == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= least:
            found[run] += n
    return found


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words that occur often enough."""

    def run(batches: Batches) -> Batches:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for doc_id, text in zip(ids, texts, strict=True):
                held.update(damaged_runs(doc_id, text.as_py()))
                if len(held) >= _HELD:
                    yield rows()
                    held.clear()
        if held:
            yield rows()

    counted = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, _COUNTED)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _blocks(words: DataFrame) -> DataFrame:
    """Each word in its length blocks, once for each third: (block, shorter, third, word, n)."""
    length = F.length("word")
    placed = words.select(
        "word", "n", length.alias("length"), F.explode(F.array(length, length - 1)).alias("shorter")
    ).select("*", F.explode(F.array(*[F.lit(q) for q in range(_THIRDS)])).alias("third"))
    begin = F.expr(f"shorter * third div {_THIRDS}")
    end = F.expr(f"shorter * (third + 1) div {_THIRDS} + length - shorter")
    before = F.substring("word", F.lit(1), begin.cast("int"))
    after = F.substring("word", (end + 1).cast("int"), F.col("length"))
    return placed.select(
        F.xxhash64("shorter", "third", before, F.lit("|"), after).alias("block"), "shorter", "third", "word", "n"
    )


def _tiles(blocks: DataFrame, tile: int) -> DataFrame:
    """Rows with their tile; words of a large block go to every pair of parts that holds theirs."""
    sizes = blocks.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > tile)
    sizes = written(sizes.select("block", F.ceil(F.col("size") / tile).cast("int").alias("parts")), "large-blocks")
    dealt = blocks.join(sizes, "block", "left")
    whole = dealt.where("parts IS NULL").select(
        *[F.col(c) for c in ("block", "shorter", "third", "word", "n")], F.lit(-1).alias("one"), F.lit(-1).alias("two"), F.lit(0).alias("part")
    )
    part = F.pmod(F.xxhash64("word", F.lit("part")), F.col("parts")).cast("int")
    cut = dealt.where("parts IS NOT NULL").withColumn("part", part)
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.select(
        "block", "shorter", "third", "word", "n", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"), "part"
    )
    return whole.unionByName(cut)


def _third_ends(shorter: np.ndarray, third: np.ndarray) -> np.ndarray:
    return shorter * (third + 1) // _THIRDS


def near_pairs(words: list[bytes], group: np.ndarray, shorter: np.ndarray, third: np.ndarray, apart: np.ndarray):
    """Index pairs (i < j) of near words of one group that belong to its third.

    ``apart`` is the part of a word in a tile of two parts; pairs within one part belong to
    that part's own tile, unless it is 0 for all of the group.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max()) + 1
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
    row = np.repeat(np.arange(len(words)), lengths)
    used, column = np.unique(letters[letters > 0], return_inverse=True)
    counts = np.bincount(row * len(used) + column, minlength=len(words) * len(used))
    counts = counts.reshape(len(words), len(used)).astype(np.float32)
    square = np.einsum("ij,ij->i", counts, counts)
    distance = counts @ counts.T
    distance *= -2
    distance += square[:, None]
    distance += square
    i, j = np.nonzero(np.triu(distance <= 2, 1))
    together = (group[i] == group[j]) & ((lengths[i] == shorter[i]) | (lengths[j] == shorter[j])) & (apart[i] != apart[j])
    i, j = i[together], j[together]

    same = lengths[i] == lengths[j]
    a, b = i[same], j[same]
    replaced = (letters[a] != letters[b]).sum(axis=1) == 1
    a, b = a[replaced], b[replaced]

    i, j = i[~same], j[~same]
    short = np.where(lengths[i] < lengths[j], i, j)
    long = np.where(lengths[i] < lengths[j], j, i)
    inside = np.arange(width - 1) < lengths[short][:, None]
    ahead = (letters[short, :-1] != letters[long, :-1]) & inside
    behind = (letters[short, :-1] != letters[long, 1:]) & inside
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), lengths[short])
    after = np.where(behind.any(axis=1), width - 1 - behind[:, ::-1].argmax(axis=1), 0)  # past the last difference
    # the added letter may stand from ``after`` to ``first``: the first third that reaches there has the pair
    at, q = shorter[short], third[short]
    mine = (after <= first) & (_third_ends(at, q) >= after) & ((q == 0) | (_third_ends(at, q - 1) < after))
    return np.r_[a, short[mine]], np.r_[b, long[mine]]


def _best(words: list[str], counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Per word its near words in the tile, and of these the most frequent one."""
    of, near = np.r_[i, j], np.r_[j, i]
    text = np.array(words, object)
    order = np.argsort(np.array(words), kind="stable") if len(words) else np.empty(0, np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    by = np.lexsort((rank[near], -counts[near], of))
    of, near = of[by], near[by]
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[starts, len(of)])
    columns = [
        pa.array(text[of[starts]], pa.string()),
        pa.array(sizes, pa.int64()),
        pa.array(counts[near[starts]], pa.int64()),
        pa.array(text[near[starts]], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "form_n", "form"])


def _multiply(batches: Batches) -> Batches:
    """Rows sorted by tile to what each tile says of its words."""
    held: pa.Table | None = None

    def found(rows: pa.Table) -> pa.RecordBatch:
        get = {name: rows.column(name).to_numpy() for name in rows.column_names if name != "word"}
        words = rows.column("word").to_pylist()
        tile = np.stack([get[c] for c in ("block", "one", "two", "shorter", "third")])
        group = np.r_[0, np.cumsum((tile[:, 1:] != tile[:, :-1]).any(axis=0))]
        # a tile of two parts pairs words of different parts; any other tile all its words
        crossed = get["one"] != get["two"]
        apart = np.where(crossed, get["part"], np.arange(len(words)))
        return _best(words, get["n"], *near_pairs(
            [w.encode("latin-1") for w in words], group, get["shorter"].astype(np.int64), get["third"].astype(np.int64), apart
        ))

    def cut(rows: pa.Table, last: bool):
        """Runs of whole tiles: many small ones, or one."""
        key = np.stack([rows.column(c).to_numpy() for c in ("block", "one", "two")])
        starts = np.flatnonzero(np.r_[True, (key[:, 1:] != key[:, :-1]).any(axis=0)])
        ends = np.r_[starts[1:], rows.num_rows] if last else starts[1:]
        begin = 0
        for i, end in enumerate(ends):
            following = ends[i + 1] if i + 1 < len(ends) else None
            if following is None or following - begin > _TOGETHER:
                if end - begin > 1:
                    yield rows.slice(begin, end - begin)
                begin = end
        return begin

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows])
        begin = yield from _drain(cut(held, False), found)
        held = held.slice(begin).combine_chunks()
    if held is not None and held.num_rows:
        yield from _drain(cut(held, True), found)


def _drain(parts, found):
    """Yields what ``found`` makes of each part; returns what the generator of parts returns."""
    while True:
        try:
            rows = next(parts)
        except StopIteration as end:
            return end.value
        made = found(rows)
        if made.num_rows:
            yield made


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, form_n, form) of words with a near word; ``form`` is the most frequent near word."""
    rows = _tiles(_blocks(words), tile).repartition("block", "one", "two").sortWithinPartitions("block", "one", "two")
    found = rows.mapInArrow(_multiply, _FOUND)
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(form, root) of every word that is a form, by pointer doubling along (word, form)."""
    ends = forms.select(F.col("form").alias("word")).distinct()
    steps = written(ends.join(forms, "word", "left").select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = written(steps.join(ahead, "root").select("word", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")), "roots")
        if steps.where("moved").isEmpty():
            return steps.select(F.col("word").alias("form"), "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """One row per word: its near words, its form and the root of its chain of forms."""
    words = written(count_words(docs, id_col, text_col), "words")
    near = words.join(near_words(words, tile), "word", "left")
    is_form = F.col("form_n") >= MORE_FREQUENT * F.col("n")
    near = written(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, F.col("form")).alias("form"),
            F.when(is_form, F.col("form_n")).alias("form_n"),
        ),
        "near-words",
    )
    roots = _roots(near.where("form IS NOT NULL").select("word", "form"))
    return near.join(roots, "form", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
