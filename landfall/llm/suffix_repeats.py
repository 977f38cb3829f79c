"""Removal of long repeated byte strings by suffix sorting.

Every window of ``window`` bytes belongs to the smallest hash among its ``gram``-byte strings, its
anchor; equal windows have equal anchors wherever they are. Neighbouring windows with one anchor
form a segment. Anchors met once need no more work. Segments that occur twice or more as a whole
are repeated throughout. Of the rest, one copy of each segment goes to the shard of its anchor,
where the suffixes of the shard's text are sorted in two stages: those smaller than their successor
directly, all others induced from these by scanning the buckets of first bytes. Common prefixes of
adjacent suffixes then tell which windows repeat.

An anchor with more than ``MOST_SEGMENTS`` different segments (a passage in very many documents, at its
rims) gets further anchors. Equal windows hold their least gram at the same offset, so the windows of a
segment are cut into ranges of offsets, and those of one range go by all the bytes that every window
of that range holds around the gram. Ranges that are still crowded are cut again, four times finer, down to
single windows, where the bytes are the window and different segments can't meet. A rim has one crowded range
at each step, so rows stay near the number of segments and no group to be sorted grows with the corpus.

Rows are told apart by (id, hash of the text); equal rows are copies of each other. Defined
results: a null or empty text has no bytes and none removed; texts shorter than the window keep
all; repeated rows remove each other's text; a null id is kept as null; an empty table gives no
rows. Matches never cross documents, and all are judged on the input.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, written

WINDOW = 200
GRAM = 48
MOST_SEGMENTS = 2_000
#: Windows per segment at most: very long runs of one anchor are cut.
_LONGEST = 4_096
#: Bytes of segments that one suffix sort takes; a shard of more is sorted anchor group by group.
_SORTED = 4_000_000

_POWER = 0x9E3779B97F4A7C15 | 1
_TWO = np.uint64(0xBF58476D1CE4E5B9)
_THREE = np.uint64(0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _TWO
    h = (h ^ (h >> np.uint64(27))) * _THREE
    return h ^ (h >> np.uint64(31))


def _byte_values(seed: int) -> np.ndarray:
    return _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))


_VALUES = _byte_values(1)
_INVERSE = pow(_POWER, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


class Hasher:
    """Hashes of all strings of one length in a text, through sums of scaled byte values."""

    def __init__(self):
        self.up = _powers(_POWER, 1 << 12)
        self.down = _powers(_INVERSE, 1 << 12)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.up):
            size = 2 * len(data)
            self.up, self.down = _powers(_POWER, size), _powers(_INVERSE, size)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.down[start])

    def grams(self, sums: np.ndarray, n: int) -> np.ndarray:
        return _mixed((sums[n:] - sums[:-n]) * self.down[: len(sums) - n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


_PLACE_BITS = np.uint64(24)
_PLACES = (1 << 24) - 1


def least_grams(grams: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Leftmost and rightmost place of each window's least gram.

    The least gram is found by the high bits of its hash, then by place.
    """
    high = grams >> _PLACE_BITS << _PLACE_BITS
    width = window - gram + 1
    places = np.arange(len(grams), dtype=np.uint64) & np.uint64(_PLACES)
    base = np.arange(len(grams) - width + 1) & ~_PLACES  # texts beyond the bits: by the window's own part
    left = (sliding_least(high | places, width) & np.uint64(_PLACES)).astype(np.int64)
    right = _PLACES - (sliding_least(high | (np.uint64(_PLACES) - places), width) & np.uint64(_PLACES)).astype(np.int64)
    window_at = np.arange(len(left))
    left = left + base + np.where(left + base < window_at, _PLACES + 1, 0)
    right = right + base + np.where(right + base < window_at, _PLACES + 1, 0)
    return left, right


def segments(data: np.ndarray, hasher: Hasher, window: int, gram: int):
    """(anchor, hash, start, windows, whether the anchor recurs) of each segment of one text.

    The leftmost least gram is the anchor; the rightmost one shows whether the segment holds it
    more than once. Windows may then repeat within the segment.
    """
    if len(data) < window:
        empty = np.empty(0, np.uint64)
        return empty, empty, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    sums = hasher.sums(data)
    grams = hasher.grams(sums, gram)
    left, right = least_grams(grams, window, gram)
    anchors = grams[left]
    starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    lengths = np.diff(np.r_[starts, len(anchors)])
    recurs = left[starts] != right[starts + lengths - 1]
    if lengths.max() > _LONGEST:
        parts = -(-lengths // _LONGEST)
        first = np.repeat(starts, parts)
        place = np.arange(len(first)) - np.repeat(np.cumsum(parts) - parts, parts)
        ends, recurs = np.repeat(starts + lengths, parts), np.repeat(recurs, parts)
        starts = first + place * _LONGEST
        lengths = np.minimum(ends - starts, _LONGEST)
    return anchors[starts], hasher.spans(sums, starts, starts + lengths + window - 1), starts, lengths, recurs


#: Offsets in a range, step by step. At single offsets all segments of an anchor are equal.
_RANGES = (64, 16, 4, 1)
_ANY = 1 << 62


def offset_ranges(data: np.ndarray, hasher: Hasher, window: int, gram: int, width: int):
    """(anchor, hash, start, windows, whether the gram recurs) of runs of windows of one anchor.

    The anchor is the hash of a range of offsets, in which the window's least gram lies, and of the bytes
    that all windows of that range hold around the gram: windows that are equal have equal anchors.
    """
    sums = hasher.sums(data)
    left, _ = least_grams(hasher.grams(sums, gram), window, gram)
    nearest = (left - np.arange(len(left))) // width * width
    farthest = np.minimum(nearest + width, window - gram + 1) - 1
    common = hasher.spans(sums, left - nearest, left - farthest + window)
    anchors = _mixed(common ^ _mixed((nearest * (window + 1) + width).astype(np.uint64)))
    starts = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    lengths = np.diff(np.r_[starts, len(left)])
    recurs = left[starts] != left[starts + lengths - 1]
    return anchors[starts], hasher.spans(sums, starts, starts + lengths + window - 1), starts, lengths, recurs


def _batch(names: list[str], kinds: list[pa.DataType], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


#: ``known``: 0 a segment; 1 a segment with copies elsewhere; 2 a copy whose span is settled.
_SEGMENTS = (
    "anchor long, segment long, doc_id long, text_key long, start int, windows int, recurs boolean, known int"
)
_SEGMENT_NAMES = [f.split()[0] for f in _SEGMENTS.split(", ")]
_SEGMENT_KINDS = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.bool_(), pa.int32()]
_SETTLED = 2


def _settled(anchor: np.ndarray, segment: np.ndarray, start: np.ndarray, known: np.ndarray):
    """Anchors and states after one row of each segment has been chosen to go on for its copies."""
    by = np.lexsort((segment, anchor))
    first = np.r_[True, (anchor[by[1:]] != anchor[by[:-1]]) | (segment[by[1:]] != segment[by[:-1]])]
    starts = np.flatnonzero(first)
    sizes = np.diff(np.r_[starts, len(by)])
    copied = (sizes > 1) | (np.maximum.reduceat(known[by], starts) == 1)
    states = np.empty(len(by), np.int32)
    states[by] = np.where(first, np.repeat(copied, sizes), _SETTLED)
    # settled rows need no company: any spread of them will do
    return np.where(states == _SETTLED, segment ^ _mixed(start.astype(np.uint64)), anchor), states


def _cut(window: int, gram: int):
    """Segments; of those that a batch holds several times, one goes on and the others are settled."""

    def run(batches: Batches) -> Batches:
        hasher = Hasher()
        for batch in batches:
            found, at = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                if text and len(text) * 4 >= window:
                    parts = segments(np.frombuffer(text.encode(), np.uint8), hasher, window, gram)
                    if len(parts[2]):
                        found.append(parts)
                        at.append(np.full(len(parts[2]), i))
            if not found:
                continue
            anchor, segment, start, windows, recurs = (np.concatenate(c) for c in zip(*found, strict=True))
            anchor, known = _settled(anchor, segment, start, np.zeros(len(anchor), np.int32))
            rows = pa.array(np.concatenate(at))
            ids = [batch.column(0).take(rows), batch.column(1).take(rows)]
            columns = [anchor.view(np.int64), segment.view(np.int64), *ids, start, windows, recurs, known]
            yield _batch(_SEGMENT_NAMES, _SEGMENT_KINDS, columns)

    return run


_CUT_PIECES = f"{_SEGMENTS}, piece binary"


def _cut_again(window: int, gram: int, width: int):
    """Segments of crowded anchors, with their bytes, to runs of one range of offsets."""

    def run(batches: Batches) -> Batches:
        hasher = Hasher()
        for batch in batches:
            found, at, states = [], [], []
            pieces = batch.column(4).to_pylist()
            begins, alone = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, piece in enumerate(pieces):
                parts = offset_ranges(np.frombuffer(piece, np.uint8), hasher, window, gram, width)
                found.append(parts)
                at.append(np.full(len(parts[2]), i))
                states.append(np.full(len(parts[2]), int(not alone[i]), np.int32))
            anchor, segment, start, windows, recurs = (np.concatenate(c) for c in zip(*found, strict=True))
            rows = np.concatenate(at)
            anchor, known = _settled(anchor, segment, start, np.concatenate(states))
            texts = [
                b"" if k == _SETTLED else pieces[i][s : s + n + window - 1]
                for i, s, n, k in zip(rows, start, windows, known, strict=True)
            ]
            ids = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))]
            start = start + np.array(begins, np.int64)[rows]
            columns = [anchor.view(np.int64), segment.view(np.int64), *ids, start, windows]
            columns += [recurs, known, texts]
            yield _batch([*_SEGMENT_NAMES, "piece"], [*_SEGMENT_KINDS, pa.binary()], columns)

    return run


_MARKS = "kind int, doc_id long, text_key long, start int, windows int, anchor long, alone boolean"
_MARK_NAMES = [f.split()[0] for f in _MARKS.split(", ")]
_MARK_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_()]
#: A repeated segment; a segment to be sorted; one to be cut again.
_COPY, _FEW, _MANY = range(3)
#: Columns of a batch that stay Arrow: row ids, and the bytes where there are any.
_AS_ARROW = (2, 3, 8)


def _mark(most_segments: int):
    """Rows sorted by (anchor, segment) to marks, holding at most a few thousand rows of one anchor."""

    def run(batches: Batches) -> Batches:
        held: list | None = None  # rows of the anchor that may go on
        crowded = None  # the anchor that has shown more than ``most_segments`` segments

        def marks(kind: int, columns: list, at: np.ndarray, alone) -> pa.RecordBatch:
            anchor, _, doc, key, start, windows, _, _, *piece = columns
            chosen = pa.array(at, pa.int64())
            rows = [np.full(len(at), kind, np.int32), doc.take(chosen), key.take(chosen), start[at], windows[at]]
            rows += [anchor[at], alone]
            if not piece:
                return _batch(_MARK_NAMES, _MARK_KINDS, rows)
            bytes_of = pa.nulls(len(at), pa.binary()) if kind == _COPY else piece[0].take(chosen)
            return _batch([*_MARK_NAMES, "piece"], [*_MARK_KINDS, pa.binary()], [*rows, bytes_of])

        def groups(columns: list):
            """Whether each row has copies, and the first row of each segment."""
            anchor, segment, known = columns[0], columns[1], columns[7]
            first = np.r_[True, (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])]
            starts = np.flatnonzero(first)
            sizes = np.diff(np.r_[starts, len(anchor)])
            copied = np.repeat((sizes > 1) | (np.maximum.reduceat(known, starts) == 1), sizes)
            copied |= known == _SETTLED
            return copied, starts

        for batch in batches:
            columns = [
                c if i in _AS_ARROW else c.to_numpy(zero_copy_only=False) for i, c in enumerate(batch.columns)
            ]
            if held is not None:
                columns = [
                    pa.concat_arrays([h, c]) if i in _AS_ARROW else np.concatenate([h, c])
                    for i, (h, c) in enumerate(zip(held, columns, strict=True))
                ]
            anchor = columns[0]
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut:
                done = [c.slice(0, cut) if i in _AS_ARROW else c[:cut] for i, c in enumerate(columns)]
                yield from finish(done, groups, marks, most_segments, crowded)
                crowded = None
            held = [c.slice(cut) if i in _AS_ARROW else c[cut:] for i, c in enumerate(columns)]
            if len(held[0]) > most_segments:
                # settle copies now; of each segment one row stays
                copied, starts = groups(held)
                at = np.flatnonzero(copied & (held[7] >= 0))
                yield marks(_COPY, held, at, np.zeros(len(at), bool))
                held = [c.take(pa.array(starts)) if i in _AS_ARROW else c[starts] for i, c in enumerate(held)]
                held[7] = np.where(copied[starts], -1, held[7])
                if len(starts) > most_segments:
                    crowded = held[0][0]
                    yield marks(_MANY, held, np.arange(len(starts) - 1), held[7][:-1] >= 0)
                    held = [c.slice(len(starts) - 1) if i in _AS_ARROW else c[-1:] for i, c in enumerate(held)]
        if held is not None and len(held[0]):
            yield from finish(held, groups, marks, most_segments, crowded)

    return run


def finish(columns: list, groups, marks, most_segments: int, crowded) -> Batches:
    """Marks of rows whose anchors are complete. ``known`` is -1 where a copy's mark is made already."""
    anchor, recurs, known = columns[0], columns[6], columns[7]
    copied, starts = groups(columns)
    copied |= known == -1
    at = np.flatnonzero(copied & (known != -1))
    yield marks(_COPY, columns, at, np.zeros(len(at), bool))
    heads = starts[known[starts] != _SETTLED]
    if not len(heads):
        return
    of = anchor[heads]
    first = np.r_[True, of[1:] != of[:-1]]
    sizes = np.diff(np.r_[np.flatnonzero(first), len(of)])
    kinds = np.repeat(sizes, sizes)
    # the anchor recurs in a segment, or has several segments
    again = np.repeat(np.logical_or.reduceat(recurs[heads], np.flatnonzero(first)), sizes)
    many = (kinds > most_segments) | (of == crowded if crowded is not None else False)
    few = ((kinds > 1) | again) & ~many
    yield marks(_FEW, columns, heads[few], ~copied[heads[few]])
    yield marks(_MANY, columns, heads[many], ~copied[heads[many]])


# --- the suffix array of a shard -----------------------------------------------------------------


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than its successor; the last one is not."""
    n = len(text)
    rises = np.zeros(n, bool)
    rises[:-1] = text[:-1] < text[1:]
    same = np.zeros(n, bool)
    same[:-1] = text[:-1] == text[1:]
    differ = np.where(same, n, np.arange(n))  # the next place that differs from its successor decides
    return rises[np.minimum.accumulate(differ[::-1])[::-1]]


def _direct(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """The places sorted by their first ``depth`` bytes, eight at a time, only ties going on."""
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)

    def key(at: np.ndarray, offset: int) -> np.ndarray:
        return words[at + offset].copy().view(">u8").ravel().astype(np.uint64)

    first = key(places, 0)
    by = np.argsort(first, kind="stable")
    order, first = places[by], first[by]
    start = np.r_[True, first[1:] != first[:-1]]  # where a run of ties begins
    offset = 8
    while offset < depth:
        run = np.cumsum(start) - 1
        tied = np.flatnonzero(np.bincount(run)[run] > 1)
        if not len(tied):
            break
        keys = key(order[tied], offset)
        by = np.lexsort((keys, run[tied]))
        order[tied] = order[tied][by]
        keys, runs = keys[by], run[tied]
        start[tied[1:]] |= (keys[1:] != keys[:-1]) & (runs[1:] == runs[:-1])
        offset += 8
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes in the order of (at least) their first ``depth`` bytes, in two stages."""
    n = len(text)
    small = _smaller_than_next(text)
    direct = _direct(text, np.flatnonzero(small), depth)
    split = np.searchsorted(text[direct], np.arange(257)) if len(direct) else np.zeros(257, np.int64)
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    # the last suffix is larger than its (empty) successor and comes first in its bucket
    induced[text[-1]].append(np.array([n - 1]))

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Deals the predecessors of scanned suffixes to their buckets; returns those of this one."""
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        heads = text[before]
        for head in np.unique(heads):
            if head != byte:
                induced[head].append(before[heads == head])
        return before[heads == byte]

    result = []
    for byte in range(256):
        wave = np.concatenate(induced[byte]) if induced[byte] else np.empty(0, np.int64)
        while len(wave):  # runs of one byte induce within the bucket, wave by wave
            result.append(wave)
            wave = induce(wave, byte)
        directly = direct[split[byte] : split[byte + 1]]
        result.append(directly)
        induce(directly, byte)
    return np.concatenate(result)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length, up to ``most``, of the common prefix of each suffix in the order with the next."""
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    found = np.zeros(max(len(order) - 1, 0), np.int64)
    going = np.arange(len(found))
    length = 0
    while len(going) and length < most:
        a, b = words[order[going] + length], words[order[going + 1] + length]
        equal = np.cumprod(a == b, axis=1, dtype=np.uint8).sum(axis=1).astype(np.int64)
        found[going] += equal
        going = going[equal == 8]
        length += 8
    return np.minimum(found, most)


def repeated_windows(pieces: list[bytes], window: int) -> list[np.ndarray]:
    """For each piece, whether the window at each of its starts also starts elsewhere in the pieces."""
    lengths = np.array([len(p) for p in pieces])
    starts = np.cumsum(lengths) - lengths
    text = np.frombuffer(b"".join(pieces), np.uint8)
    order = suffix_array(text, window)
    piece = np.repeat(np.arange(len(pieces)), lengths)
    whole = np.arange(len(text)) + window <= (starts + lengths)[piece]  # a window stays in its piece
    order = order[whole[order]]
    long = common_prefixes(text, order, window) >= window
    repeated = np.zeros(len(text), bool)
    repeated[order[:-1][long]] = True
    repeated[order[1:][long]] = True
    return [repeated[s : s + n - window + 1] for s, n in zip(starts, lengths, strict=True)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


_SPANS = "doc_id long, text_key long, begin int, until int"
_SPAN_NAMES = ["doc_id", "text_key", "begin", "until"]
_SPAN_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]


def _sort_shards(window: int):
    """Rows sorted by anchor, with the bytes of segments, to repeated spans."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        found: list[tuple] = []
        flags = repeated_windows([r[4] for r in rows], window)
        for (doc, key, start, alone, _), repeated in zip(rows, flags, strict=True):
            if alone:
                found += [(doc, key, start + a, start + b + window - 1) for a, b in _runs(repeated)]
        return _batch(_SPAN_NAMES, _SPAN_KINDS, list(zip(*found, strict=True)) or [[]] * 4)

    def run(batches: Batches) -> Batches:
        rows: list[tuple] = []
        held, last = 0, None
        for batch in batches:
            for anchor, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held >= _SORTED and anchor != last:  # groups of one anchor stay together
                    yield spans(rows)
                    rows, held = [], 0
                rows.append(tuple(row))
                held += len(row[4])
                last = anchor
        if rows:
            yield spans(rows)

    return run


_PIECES = "many boolean, anchor long, doc_id long, text_key long, start int, alone boolean, piece binary"


def _extract(window: int):
    """Bytes of the wanted segments."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows: list[tuple] = []
            for doc, key, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                for w in wanted:
                    at = w["start"]
                    piece = data[at : at + w["windows"] + window - 1]
                    rows.append((w["kind"] == _MANY, w["anchor"], doc, key, at, w["alone"], piece))
            kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
            yield _batch([f.split()[0] for f in _PIECES.split(", ")], kinds, list(zip(*rows, strict=True)) or [[]] * 7)

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"), F.col(text_col).alias("text")
    )


def _same_row(a: DataFrame, b: DataFrame):
    return (a["text_key"] == b["text_key"]) & a["doc_id"].eqNullSafe(b["doc_id"])


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, text_key, begin, until): byte spans that windows repeated elsewhere cover; they overlap."""
    texts = _keyed(docs, id_col, text_col)
    cut = texts.select("doc_id", "text_key", "text").mapInArrow(_cut(window, gram), _SEGMENTS)
    cut = cut.repartition("anchor").sortWithinPartitions("anchor", "segment")
    marks = written(cut.mapInArrow(_mark(MOST_SEGMENTS), _MARKS), "segment-marks")
    copied = _copied(marks, window)

    wanted = marks.where(F.col("kind") != _COPY).groupBy("doc_id", "text_key")
    listed = wanted.agg(F.collect_list(F.struct("kind", "start", "windows", "anchor", "alone")).alias("wanted"))
    both = texts.join(listed, _same_row(texts, listed)).select(texts["doc_id"], texts["text_key"], "text", "wanted")
    pieces = written(both.mapInArrow(_extract(window), _PIECES), "segment-pieces")

    columns = ["anchor", "doc_id", "text_key", "start", "alone", "piece"]
    found, few = [copied], [pieces.where("NOT many").select(*columns)]
    crowded = pieces.where("many").select(*columns[1:])
    for width in _RANGES:
        if crowded.isEmpty():
            break
        again = crowded.mapInArrow(_cut_again(window, gram, width), _CUT_PIECES)
        again = again.repartition("anchor").sortWithinPartitions("anchor", "segment")
        most = MOST_SEGMENTS if width > 1 else _ANY
        ranged = written(again.mapInArrow(_mark(most), f"{_MARKS}, piece binary"), f"ranges-{width}")
        found.append(_copied(ranged, window))
        few.append(ranged.where(F.col("kind") == _FEW).select(*columns))
        crowded = ranged.where(F.col("kind") == _MANY).select(*columns[1:])
    gathered = reduce(DataFrame.unionByName, few).repartition("anchor").sortWithinPartitions("anchor")
    return reduce(DataFrame.unionByName, [*found, gathered.mapInArrow(_sort_shards(window), _SPANS)])


def _copied(marks: DataFrame, window: int) -> DataFrame:
    """Spans of segments that occur twice or more as a whole."""
    return marks.where(F.col("kind") == _COPY).select(
        "doc_id", "text_key", F.col("start").alias("begin"), (F.col("start") + F.col("windows") + window - 1).alias("until")
    )


def _with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Texts with all spans of their row; the result has (doc_id, text_key, text, spans)."""
    merged = spans.groupBy("doc_id", "text_key").agg(F.array_distinct(F.collect_list(F.struct("begin", "until"))).alias("spans"))
    return docs.join(merged, _same_row(docs, merged), "left").drop(merged["doc_id"]).drop(merged["text_key"])


def _kept(data: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left, bytes removed, maximal removed runs."""
    if not spans:
        return data, 0, 0
    left, at, removed, runs = [], 0, 0, 0
    for begin, until in sorted((s["begin"], s["until"]) for s in spans):
        if begin > at or not runs:
            left.append(data[at:begin])
            removed += until - begin
            runs += 1
            at = until
        elif until > at:
            removed += until - at
            at = until
    return b"".join([*left, data[at:]]), removed, runs


DIGESTS = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removal_digests(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """What removal does to each row of ``docs``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = (text or "").encode()
                left, removed, runs = _kept(data, spans)
                rows.append((doc, len(data), removed, runs, hashlib.sha256(left).hexdigest()))
            names = [f.split()[0] for f in DIGESTS.split(", ")]
            yield _batch(names, [pa.int64()] * 4 + [pa.string()], list(zip(*rows, strict=True)) or [[]] * 5)

    spans = repeated_spans(docs, window, gram, id_col, text_col)
    return _with_spans(_keyed(docs, id_col, text_col), spans).select("doc_id", "text", "spans").mapInArrow(run, DIGESTS)


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    length_col: str | None = "n_chars",
) -> DataFrame:
    """``docs`` with the repeated bytes taken out of the text; bytes that no longer form a character go.

    ``length_col``, if given and there, gets the new number of characters; a null text stays null.
    """
    names = docs.columns

    def run(batches: Batches) -> Batches:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1).to_pylist()
            at = names.index(text_col)
            texts = [
                None if t is None else (_kept(t.encode(), s)[0].decode("utf-8", "ignore") if s else t)
                for t, s in zip(batch.column(at).to_pylist(), spans, strict=True)
            ]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, pa.string())
            if length_col in names:
                lengths = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                columns[names.index(length_col)] = lengths.cast(columns[names.index(length_col)].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    spans = repeated_spans(docs, window, gram, id_col, text_col)
    merged = spans.groupBy("doc_id", "text_key").agg(
        F.array_distinct(F.collect_list(F.struct("begin", "until"))).alias("__spans")
    )
    match = (F.xxhash64(docs[text_col]) == merged["text_key"]) & docs[id_col].cast("long").eqNullSafe(merged["doc_id"])
    joined = docs.join(merged, match, "left").select(*[docs[c] for c in names], merged["__spans"])
    return joined.mapInArrow(run, docs.schema)
