"""Benchmark passages in training text, found through suffix arrays of the training words.

Documents stay where they are. A task gathers some of its documents into a shard of about
``SHARD_WORDS`` words and sorts the shard's suffixes, word by word. Every suffix of every benchmark item
is then looked up in it by binary search: its longest verbatim match lies beside the place where the
suffix would be, and the places that begin with the same window are one range of the array. Words that
no item has end a match, so suffixes that begin in front of one soon are left out of the sort. Nothing
is shuffled, and a document's verdict is known where the document is.

The items lie in a table in the shared folder, in files of ``BLOCK_CHARS`` characters of text at most
(one item at least). Each task reads them file by file and searches its shard for one block after the
other, so memory has a bound however many items there are.

A window is ``window`` consecutive words of an item, or all words of a shorter one. Words are runs of
digits, letters a to z (after lower-casing A-Z) and everything beyond ASCII.

Defined results: a null or empty text has no words and no hits; a very long text is a shard of its own and
searched whole; repeated documents are judged row by row, repeated items are one; an item without words
matches nothing, and one without an id marks words but is neither counted nor listed; an empty table on
either side gives no hits; other columns are not read, or returned as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, filesystem
from landfall.sources.scratch import scratch_folder

WINDOW = 10
SHARD_WORDS = 1_000_000
#: Characters of items that one file, and so one round of searches, takes.
BLOCK_CHARS = 4_000_000
#: Bits of a word's number in a block; three fit a sort key.
_BITS = 21

_TO_WORDS = bytes(
    c + 32 if ord("A") <= c <= ord("Z") else c if c >= 128 or chr(c) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


@dataclass
class Block:
    """Items of one file: their words as numbers from 1, and what is to be searched."""

    items: list[str | None]
    numbers: dict[bytes, int]
    words: np.ndarray  # of all items, each followed by zeros
    places: np.ndarray  # where a test suffix begins
    ends: np.ndarray  # where its item ends
    item: np.ndarray
    windows: np.ndarray  # words of the window at that place, 0 if none begins there
    depth: int  # words of the longest item

    @property
    def shortest(self) -> int:
        return int(self.windows[self.windows > 0].min())


def block_of(rows: list[tuple[str | None, str | None]], window: int) -> Block | None:
    """Items (id as text, text) ready for the search; none if no item has a word."""
    texts = [(i, words) for i, words in ((i, words_of(t)) for i, t in dict.fromkeys(rows)) if words]
    if not texts:
        return None
    numbers: dict[bytes, int] = {}
    depth = max(len(w) for _, w in texts)
    words, places, ends, item, windows = [], [], [], [], []
    at = 0
    for k, (_, found) in enumerate(texts):
        n = len(found)
        words += [numbers.setdefault(w, len(numbers) + 1) for w in found]
        places.append(np.arange(at, at + n))
        ends.append(np.full(n, at + n))
        item.append(np.full(n, k))
        size = min(window, n)
        windows.append(np.where(np.arange(n) + size <= n, size, 0))
        words.append(0)
        at += n + 1
    if len(numbers) >= 1 << _BITS:
        raise ValueError(f"a block of items has {len(numbers)} different words; write smaller blocks")
    padded = np.array(words + [0] * depth, np.int64)
    return Block([i for i, _ in texts], numbers, padded, *map(np.concatenate, (places, ends, item, windows)), depth)


# --- the suffix array of a shard -----------------------------------------------------------------


def _key(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[at] << (2 * _BITS)) | (words[at + 1] << _BITS) | words[at + 2]


def suffix_array(words: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The places in the order of their next ``depth`` words, three at a time, only ties going on."""
    keys = _key(words, places)
    by = np.argsort(keys, kind="stable")
    order, keys = places[by], keys[by]
    start = np.r_[True, keys[1:] != keys[:-1]]
    open_end = (keys & ((1 << _BITS) - 1)) == 0  # a text has ended: what follows is another text's
    offset = 3
    while offset < depth:
        run = np.cumsum(start) - 1
        tied = np.flatnonzero((np.bincount(run)[run] > 1) & ~open_end)
        if not len(tied):
            break
        keys = _key(words, order[tied] + offset)
        by = np.lexsort((keys, run[tied]))
        order[tied] = order[tied][by]
        keys, runs = keys[by], run[tied]
        open_end[tied] = (keys & ((1 << _BITS) - 1)) == 0
        start[tied[1:]] |= (keys[1:] != keys[:-1]) & (runs[1:] == runs[:-1])
        offset += 3
    return order


def _compared(words: np.ndarray, at: np.ndarray, test: np.ndarray, places: np.ndarray, lengths: np.ndarray):
    """(common words, -1, 0 or 1) of the shard's suffixes against the first ``lengths`` words of test suffixes."""
    common = np.zeros(len(at), np.int64)
    sign = np.zeros(len(at), np.int64)
    going = np.flatnonzero(lengths > 0)
    k = 0
    while len(going):
        a, b = words[at[going] + k], test[places[going] + k]
        same = a == b
        stop = going[~same]
        sign[stop] = np.sign(a[~same] - b[~same])
        going = going[same]
        k += 1
        common[going] = k
        going = going[lengths[going] > k]
    return common, sign


def lower_bounds(
    words: np.ndarray, order: np.ndarray, test: np.ndarray, places: np.ndarray, lengths: np.ndarray, above: bool = False
) -> np.ndarray:
    """Binary search: suffixes below each test suffix, or not above it, by its first ``lengths`` words."""
    low = np.zeros(len(places), np.int64)
    high = np.full(len(places), len(order), np.int64)
    while True:
        going = np.flatnonzero(low < high)
        if not len(going):
            return low
        middle = (low[going] + high[going]) // 2
        _, sign = _compared(words, order[middle], test, places[going], lengths[going])
        up = sign <= 0 if above else sign < 0
        low[going] = np.where(up, middle + 1, low[going])
        high[going] = np.where(up, high[going], middle)


class Shard:
    """Words of some documents."""

    def __init__(self, texts: list[str | None]):
        self.texts = [words_of(t) for t in texts]
        self.lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        # a zero after each document, so that no match leaves it
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1

    def sorted_for(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The words as the block's numbers, and the suffix array of places where a window may begin."""
        total = int(self.lengths.sum()) + len(self.texts)
        words = np.zeros(total + block.depth + 3, np.int64)
        get = block.numbers.get
        for at, text, n in zip(self.starts.tolist(), self.texts, self.lengths.tolist(), strict=True):
            words[at : at + n] = np.fromiter(map(get, text, repeat(0)), np.int64, n)
        stops = np.flatnonzero(words == 0)
        run = stops[np.searchsorted(stops, np.arange(total))] - np.arange(total)
        return words, suffix_array(words, np.flatnonzero(run >= block.shortest), block.depth)

    def longest(self, block: Block, words: np.ndarray, order: np.ndarray):
        """(length, place) of the longest verbatim match of each test suffix; length 0 if there is none."""
        most = block.ends - block.places
        at = lower_bounds(words, order, block.words, block.places, most)
        length, place = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        if len(order):
            for beside in (np.minimum(at, len(order) - 1), np.maximum(at - 1, 0)):
                common, _ = _compared(words, order[beside], block.words, block.places, most)
                better = common > length
                length, place = np.where(better, common, length), np.where(better, order[beside], place)
        return length, place

    def windows(self, block: Block, words: np.ndarray, order: np.ndarray, length: np.ndarray):
        """(place, words, item) of every occurrence of a window, from the test suffixes that match so far."""
        wanted = np.flatnonzero((block.windows > 0) & (length >= block.windows))
        places, sizes = block.places[wanted], block.windows[wanted]
        low = lower_bounds(words, order, block.words, places, sizes)
        high = lower_bounds(words, order, block.words, places, sizes, above=True)
        found = high - low
        at = np.repeat(low - (np.cumsum(found) - found), found) + np.arange(found.sum())
        return order[at], np.repeat(sizes, found), np.repeat(block.item[wanted], found)


# --- items in the shared folder ------------------------------------------------------------------


def write_items(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> str:
    """Writes the items for the tasks to read; returns the folder. A file holds one block."""
    rows = items.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text"))
    rows = rows.where("text IS NOT NULL").dropDuplicates()
    folder = scratch_folder(items.sparkSession, "benchmark-items")
    chars = rows.agg(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
    rows.repartition(max(1, -(-chars // (BLOCK_CHARS // 2))), "item_id", "text").write.parquet(folder)
    return folder


def _blocks(folder: str, window: int) -> Iterator[Block]:
    store, path = filesystem(folder)
    files = [f for f in store.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("part-")]
    for file in sorted(files, key=lambda f: f.path):
        rows: list[tuple] = []
        chars = 0
        with store.open_input_file(file.path) as opened:
            for batch in pq.ParquetFile(opened).iter_batches(1000):
                for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if rows and chars + len(row[1]) > BLOCK_CHARS:
                        if block := block_of(rows, window):
                            yield block
                        rows, chars = [], 0
                    rows.append(row)
                    chars += len(row[1])
        if rows and (block := block_of(rows, window)):
            yield block


class Items:
    """Blocks of the items; a lone block is kept between the shards of a task."""

    def __init__(self, folder: str, window: int):
        self.folder, self.window = folder, window
        self.only: list[Block] | None = None

    def __iter__(self) -> Iterator[Block]:
        if self.only is not None:
            yield from self.only
            return
        seen = 0
        first: Block | None = None
        for block in _blocks(self.folder, self.window):
            seen += 1
            first = block if seen == 1 else None
            yield block
        if seen < 2:
            self.only = [first] if first else []


def _shards(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents with about ``most`` words each, by their bytes."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or "") // 6 + 1
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


@dataclass
class Verdict:
    n_words: int
    n_hit: int
    items: list[str]


def judge(texts: list[str | None], items: Items, shard_words: int = SHARD_WORDS) -> list[Verdict]:
    """What each text has of the items."""
    out: list[Verdict] = []
    for begin, end in _shards(texts, shard_words):
        shard = Shard(texts[begin:end])
        edges = np.zeros(int(shard.lengths.sum()) + len(shard.texts) + 1, np.int64)
        named: list[set[str]] = [set() for _ in shard.texts]
        for block in items:
            words, order = shard.sorted_for(block)
            length, _ = shard.longest(block, words, order)
            place, size, item = shard.windows(block, words, order, length)
            np.add.at(edges, place, 1)
            np.add.at(edges, place + size, -1)
            doc = np.searchsorted(shard.starts, place, side="right") - 1
            for d, i in set(zip(doc.tolist(), item.tolist(), strict=True)):
                if block.items[i] is not None:
                    named[d].add(block.items[i])
        hit = np.r_[0, np.cumsum(np.cumsum(edges) > 0)]
        hits = hit[shard.starts + shard.lengths] - hit[shard.starts]
        out += [Verdict(n, h, sorted(names)) for n, h, names in zip(shard.lengths.tolist(), hits.tolist(), named, strict=True)]
    return out


DIGESTS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: its words, those inside a window of an item, and these items."""
    folder = write_items(items)

    def run(batches: Batches) -> Batches:
        known = Items(folder, window)
        for batch in batches:
            found = judge(batch.column(1).to_pylist(), known, shard_words)
            columns = [
                batch.column(0),
                pa.array([v.n_words for v in found], pa.int64()),
                pa.array([v.n_hit for v in found], pa.int64()),
                pa.array([len(v.items) for v in found], pa.int64()),
                pa.array([hashlib.sha256(",".join(v.items).encode()).hexdigest() for v in found], pa.string()),
                pa.array([v.n_hit > 0 for v in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in DIGESTS.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, DIGESTS)


def without_contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS, text_col: str = "text"
) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    folder = write_items(items)
    at = docs.columns.index(text_col)

    def run(batches: Batches) -> Batches:
        known = Items(folder, window)
        for batch in batches:
            found = judge(batch.column(at).to_pylist(), known, shard_words)
            yield batch.filter(pa.array([v.n_hit == 0 for v in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


MATCHES = "item_id string, item_start int, length int, doc_id long, doc_start int"


def longest_matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """For each suffix of each item its longest verbatim match and where, in words.

    Of matches of one length, that of the smallest document and the first place there is kept, among those that
    the shards report. Matches shorter than the least window of their block are left out.
    """
    folder = write_items(items)

    def run(batches: Batches) -> Batches:
        known = Items(folder, window)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for begin, end in _shards(texts, shard_words):
                shard = Shard(texts[begin:end])
                for block in known:
                    words, order = shard.sorted_for(block)
                    length, place = shard.longest(block, words, order)
                    found = np.flatnonzero(length >= block.shortest)
                    first = np.r_[0, np.flatnonzero(np.diff(block.item)) + 1]
                    start = block.places[found] - block.places[first[block.item[found]]]
                    doc = np.searchsorted(shard.starts, place[found], side="right") - 1
                    columns = [
                        pa.array([block.items[i] for i in block.item[found]], pa.string()),
                        pa.array(start, pa.int32()),
                        pa.array(length[found], pa.int32()),
                        ids.take(pa.array(begin + doc)),
                        pa.array(place[found] - shard.starts[doc], pa.int32()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in MATCHES.split(", ")])

    found = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, MATCHES)
    best = F.min(F.struct((-F.col("length")).alias("less"), "doc_id", "doc_start"))
    return found.groupBy("item_id", "item_start").agg(best.alias("best")).select(
        "item_id", "item_start", (-F.col("best.less")).alias("length"), "best.doc_id", "best.doc_start"
    )
