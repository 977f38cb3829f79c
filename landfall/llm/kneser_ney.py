"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over words, of order two, one for each language, trained on all trusted documents but
every fifth, which calibrate. No word, pair or text is left out: what the model holds grows with the
trusted text. Words are lower-cased runs of letters and digits; each symbol, and each character of a
script written without spaces, is a word of its own. A language's words are numbered apart from
another's by 64-bit hashes.

Up to 2 ** COMMON_BITS frequent words have small numbers instead, the most frequent the smallest. They are found in a
bounded part of the trusted text, which decides how short a pair is written and nothing else: a pair of two such words is
exactly its two numbers, any other pair is known by a hash.

Counts are summed in shards, which are ranges of 64-bit keys: a task counts its pairs and sends each shard
one packed block, a shard of pairs adds up what tasks counted and says how often each of its words is a context,
how often with one, two or more occurrences, and how many words it follows; shards of words add that up.
Discounts are by language, from the counts of counts.

Scoring is a join with these shards: a task takes about ``unit_words`` words of consecutive documents as a unit,
asks each shard once for the unit's distinct keys there, and gets the counts back in the same order, in a file of
the unit's own in the shared folder. It then reads its documents again and works out each pair's probability. So a key is
asked for once in a unit however frequent it is, no key is hot, and blocks of sorted keys take few bytes. A hashed pair is
known by as many bits as make a false match less likely than 2 ** -28 a look-up.

A document's perplexity is compared with quantiles of its language: the upper one of the documents that
calibrate, the lower one of all trusted documents, as those the model has seen are the most predictable. The room
beyond them is wider the fewer documents calibrate; a language without any has no bounds.

Defined results: a null or empty text, or one without words, or in a language without trusted text,
has a null perplexity and is kept; a null language is a language of its own; null labels and ids are
not trusted; repeated rows count each when trained on and get the same perplexity; a very long text is
one row like any other; an empty table gives no rows; columns of ``docs`` are never clashed with.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, filesystem, released_shuffles, written
from landfall.sources.scratch import scratch_folder

#: Every so many of the trusted documents (by a hash of the id) calibrate.
CALIBRATE = 5
LOW, HIGH = 0.001, 0.995
#: Room beyond the quantiles, as a factor of the perplexity: SLACK * (1 + FEW / sqrt(documents that calibrate)).
SLACK, FEW = 1.25, 2.0
#: Bytes of text to a shard, and words to a unit.
SHARD_BYTES, UNIT_WORDS = 16 << 20, 2_000_000
#: Trusted ids, of 8 bytes, that travel to the tasks; more are joined by a shuffle.
MOST_SENT = 4_000_000
#: Bits of a pair's hash beyond the binary digits of the bytes of trusted text.
MATCH_BITS = 26
#: Words with small numbers, as a power of two, and bytes of trusted text in which they are looked for.
COMMON_BITS, COMMON_BYTES = 16, 16 << 20
#: Words a task holds before it passes its counts on, and hashes of words a worker remembers.
_COUNTED, _REMEMBERED, _LONGEST = 2_000_000, 300_000, 64
#: Kinds of blocks.
PAIRS, WORDS, LANGUAGES, WORD_PARTS = range(4)
#: Counts of a word: as a context, in all and by pairs that occur once, twice, more often; as an end of pairs.
WORD_VALUES = 5
_NO_LANGUAGE = "\0"

_SPACELESS = "぀-ヿ㐀-䶿一-鿿"
#: A symbol, or a character of a spaceless script, or a run of other letters and digits.
_WORDS = re.compile(rf"[^\w\s]|_|[{_SPACELESS}]|[^\W_{_SPACELESS}]+")
#: Stand for the place before the first word and after the last; no word is empty or white.
_START, _END = "", " "


class Words:
    """Texts of a worker to numbers of their words: the start, each word, the end.

    A word of ``common`` has its place there as a number, any other one its hash, which is larger.
    """

    def __init__(self, common: np.ndarray):
        self.numbers = {h: i for i, h in enumerate(common.tolist())}
        self.known: dict[str, dict[str, int]] = {}
        self.size = 0

    def __call__(self, lang: str, text: str) -> np.ndarray:
        if self.size > _REMEMBERED:
            self.known, self.size = {}, 0
        known, seed = self.known.setdefault(lang, {}), zlib.crc32(lang.encode())
        words = [_START, *_WORDS.findall(text.lower()), _END]
        found = list(map(known.get, words))
        if None in found:
            for i, n in enumerate(found):
                if n is None:
                    word = words[i]
                    n = known.get(word)
                    if n is None:
                        n = max(xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), seed), 1 << COMMON_BITS)
                        n = self.numbers.get(n, n)
                        if len(word) <= _LONGEST:
                            known[word] = n
                            self.size += 1
                    found[i] = n
        return np.array(found, np.uint64)


def _mixed(numbers: np.ndarray) -> np.ndarray:
    numbers = (numbers ^ (numbers >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    numbers = (numbers ^ (numbers >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return numbers ^ (numbers >> np.uint64(31))


def _keys(common: np.ndarray, code: np.ndarray, hashed: np.ndarray, bits: int, width: int) -> np.ndarray:
    """Keys of ``width`` bits: ``bits`` for the shard, one that says which kind follows, and a code or a hash.

    The last bits of a code and a hash of the others are its shard, the others are what follows: codes that lie close
    are dealt to all shards and lie close in each.
    """
    rest = code >> np.uint64(bits)
    shard = (code + _mixed(rest)) & np.uint64((1 << bits) - 1)
    coded = (shard << np.uint64(width - bits) if bits else np.uint64(0)) | rest
    return np.where(common, coded, (hashed >> np.uint64(64 - width)) | np.uint64(1 << (width - bits - 1)))


def word_key(words: np.ndarray, bits: int) -> np.ndarray:
    """64-bit keys of words."""
    return _keys(words < np.uint64(1 << COMMON_BITS), words, words, bits, 64)


def pair_key(first: np.ndarray, second: np.ndarray, bits: int, width: int = 64) -> np.ndarray:
    """Keys of pairs of words; the order counts."""
    common = np.maximum(first, second) < np.uint64(1 << COMMON_BITS)
    hashed = _mixed((first ^ (first >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + second)
    return _keys(common, first << np.uint64(COMMON_BITS) | second, hashed, bits, width)


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids that a label calls good and none calls bad or toxic: (doc_id, calibrates)."""
    good = F.min(F.when(F.col("quality") == 1, 1).otherwise(0)) == 1
    calm = F.coalesce(F.max("toxic"), F.lit(0)) == 0
    ids = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
    ids = ids.agg(good.alias("good"), calm.alias("calm")).where("good AND calm").select("doc_id")
    return ids.withColumn("calibrates", F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATE)) == 0)


def shards_for(size: int) -> int:
    """Binary digits of the number of shards for texts of so many bytes."""
    return max(0, -(-size // SHARD_BYTES) - 1).bit_length()


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers by their bytes' significance, compressed: small ones take little."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return planes.T.copy().view("<u8").reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Keys by their differences, which are small where keys ascend."""
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Ascending; faster than numpy's own where most keys are distinct."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def _cuts(keys: np.ndarray, bits: int, width: int = 64) -> list[tuple[int, int, int]]:
    """(shard, begin, end) of ascending keys of ``width`` bits: a shard is a range of keys."""
    if not len(keys):
        return []
    shard = (keys >> np.uint64(width - bits) if bits else np.zeros(len(keys), np.uint64)).astype(np.int64)
    begin = np.flatnonzero(np.diff(shard, prepend=-1))
    return list(zip(shard[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(keys)], strict=True))


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their columns of ``values``."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    sums = np.add.reduceat(values[:, order], begin, axis=1) if len(keys) else values
    return keys[begin], sums


def _common_words(texts: DataFrame, size: int) -> np.ndarray:
    """Hashes of the words that are most frequent in about ``COMMON_BYTES`` of the texts, the most frequent first."""

    def run(batches: Batches) -> Batches:
        words = Words(np.empty(0, np.uint64))
        for batch in batches:
            found = [words(*row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True) if row[1]]
            if found:
                hashes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], names=["word", "n"])

    part = texts.select("lang", "text").sample(min(1.0, COMMON_BYTES / max(size, 1)), seed=0)
    counts = part.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    most = counts.orderBy(F.desc("n"), "word").limit(1 << COMMON_BITS).select("word").toArrow()
    return most["word"].to_numpy().view(np.uint64)


def _pair_parts(texts: DataFrame, bits: int, common: np.ndarray) -> DataFrame:
    """(lang, shard, a, b, n): what each task counted of the pairs of a shard."""

    def run(batches: Batches) -> Batches:
        words, pending, held = Words(common), {}, 0

        def flushed():
            for lang, parts in pending.items():
                a, b = (np.concatenate([p[side] for p in parts]) for side in (slice(None, -1), slice(1, None)))
                keys, first, n = np.unique(pair_key(a, b, bits), return_index=True, return_counts=True)
                rows = []
                for shard, begin, end in _cuts(keys, bits):
                    at = first[begin:end]
                    # pairs of a first word lie side by side, first those whose second word has a small number
                    order = np.lexsort((a[at], b[at] >> np.uint64(COMMON_BITS) > 0))
                    at = at[order]
                    rows.append((shard, packed_keys(a[at]), packed(b[at]), packed(n[begin:end][order])))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(rows)), pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                    names=["lang", "shard", "a", "b", "n"],
                )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(lang, text or "")
                if len(found) > 2:
                    pending.setdefault(lang, []).append(found)
                    held += len(found)
                if held >= _COUNTED:
                    yield from flushed()
                    pending, held = {}, 0
        yield from flushed()

    return texts.mapInArrow(run, "lang string, shard int, a binary, b binary, n binary")


_BLOCK = "kind int, shard int, lang string, keys binary, values binary, ones array<long>"


def _block(kind: int, shard: int, lang: str, keys: np.ndarray, values: np.ndarray, counts: np.ndarray) -> dict:
    """A row of the model; ``ones`` says how many counts are 1, 2, 3 and 4, how many there are, and their sum."""
    ones = [int((counts == k).sum()) for k in range(1, 5)] + [int((counts > 0).sum()), int(counts.sum())]
    return {
        "kind": kind, "shard": shard, "lang": lang,
        "keys": packed_keys(keys), "values": packed(values.reshape(-1)), "ones": ones,
    }


def _rows(rows: list[dict], like: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64())}
    fields = [field.split(" ") for field in like.split(", ")]
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields})


def _counted(texts: DataFrame, bits: int, width: int, common: np.ndarray) -> DataFrame:
    """Blocks of the pairs, complete, and of what each shard of pairs says of its words."""

    def merged(key: tuple, parts: pa.Table) -> pa.Table:
        lang, shard = (k.as_py() for k in key)
        a = np.concatenate([unpacked_keys(x) for x in parts["a"].to_pylist()])
        b, n = (np.concatenate([unpacked(x) for x in parts[c].to_pylist()]) for c in ("b", "n"))
        keys = pair_key(a, b, bits)
        # equal keys are equal pairs
        first = np.unique(keys, return_index=True)[1]
        n = _added(keys, n.astype(np.int64)[None])[1][0]
        a, b = a[first], b[first]
        rows = [_block(PAIRS, shard, lang, pair_key(a, b, bits, width), n, n)]
        words, at = np.unique(word_key(np.concatenate([a, b]), bits), return_inverse=True)
        before, after = at[: len(a)], at[len(a) :]
        size = len(words)
        values = [np.bincount(before, n, size)]
        values += [np.bincount(before[chosen], minlength=size) for chosen in (n == 1, n == 2, n > 2)]
        values = np.array([*values, np.bincount(after, minlength=size)]).astype(np.int64)
        for part, begin, end in _cuts(words, bits):
            rows.append(_block(WORD_PARTS, part, lang, words[begin:end], values[:, begin:end], np.zeros(0, np.int64)))
        return _rows(rows, _BLOCK)

    return written(_pair_parts(texts, bits, common).groupBy("lang", "shard").applyInArrow(merged, _BLOCK), "pair-counts")


def _word_blocks(counted: DataFrame) -> DataFrame:
    def merged(key: tuple, parts: pa.Table) -> pa.Table:
        lang, shard = (k.as_py() for k in key)
        keys = [unpacked_keys(x) for x in parts["keys"].to_pylist()]
        values = [unpacked(x).astype(np.int64).reshape(WORD_VALUES, -1) for x in parts["values"].to_pylist()]
        words, sums = _added(np.concatenate(keys), np.concatenate(values, axis=1))
        return _rows([_block(WORDS, shard, lang, words, sums, sums[-1])], _BLOCK)

    parts = counted.where(F.col("kind") == WORD_PARTS)
    return written(parts.groupBy("lang", "shard").applyInArrow(merged, _BLOCK), "word-counts")


def _discounts(ones: str) -> list[Column]:
    """What modified Kneser-Ney takes off a count of 1, of 2, and of more, by the counts of counts."""
    n = [F.col(ones)[k].cast("double") for k in range(4)]
    y = F.try_divide(n[0], n[0] + 2 * n[1])
    raw = [k - (k + 1) * y * F.try_divide(n[k], n[k - 1]) for k in (1, 2, 3)]
    return [
        F.least(F.greatest(F.coalesce(d, F.lit(k / 2)), F.lit(0.05)), F.lit(k * 0.95)) for k, d in enumerate(raw, 1)
    ]


def _languages(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, stats): discounts of pairs and of words, the pairs, and the chance of an unknown word."""

    def summed(blocks: DataFrame, name: str) -> DataFrame:
        sums = [F.sum(F.col("ones")[k]) for k in range(6)]
        return blocks.groupBy("lang").agg(F.array(*sums).alias(name))

    both = summed(pairs, "of_pairs").join(summed(words, "of_words"), "lang")
    of_words = F.col("of_words")
    rare = [of_words[0], of_words[1], of_words[4] - of_words[0] - of_words[1]]
    taken = sum((d * n for d, n in zip(_discounts("of_words"), rare, strict=True)), F.lit(0.0))
    unknown = taken / of_words[5] / (of_words[4] + 1)
    stats = [*_discounts("of_pairs"), *_discounts("of_words"), of_words[5].cast("double"), unknown]
    return both.select("lang", F.array(*stats).alias("stats"))


@dataclass
class Model:
    #: (kind, shard, lang, keys, values, stats): the counts of pairs and of words, and each language's numbers.
    blocks: DataFrame
    #: Shards are so many leading bits of a key, pairs are known by so many.
    bits: int
    width: int
    #: Hashes of the words that have small numbers.
    common: np.ndarray


def _shard_of_language(lang: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(lang), 64 - bits).cast("int") if bits else F.lit(0)


def train(texts: DataFrame, bits: int | None = None) -> Model:
    """The model of (lang, text); null languages are named before. ``bits`` fits texts to be scored."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = shards_for(size) if bits is None else bits
    # one more says whether a pair is hashed
    width = min(64, max(max(bits, size.bit_length()) + MATCH_BITS, 2 * COMMON_BITS) + 1)
    common = _common_words(texts, size)
    counted = _counted(texts, bits, width, common)
    pairs, words = counted.where(F.col("kind") == PAIRS), _word_blocks(counted)
    none = F.lit(None)
    stats = none.cast("array<double>").alias("stats")
    languages = _languages(pairs, words).select(
        F.lit(LANGUAGES).alias("kind"),
        _shard_of_language(F.col("lang"), bits).alias("shard"),
        "lang",
        none.cast("binary").alias("keys"),
        none.cast("binary").alias("values"),
        "stats",
    )
    blocks = pairs.unionByName(words).select("kind", "shard", "lang", "keys", "values", stats)
    return Model(blocks.unionByName(written(languages, "languages")), bits, width, common)


def _key(id_col: str, text_col: str, lang_col: str) -> Column:
    """Which rows are one document: those with the same id, language and text."""
    return F.xxhash64(F.col(id_col).cast("string"), F.col(lang_col).cast("string"), F.col(text_col))


class Unit:
    """Consecutive documents of a task: the keys of their words and pairs, each asked for once."""

    def __init__(self, rows: list[tuple], bits: int, width: int):
        self.doc_keys, self.langs, self.ids, found = (list(c) for c in zip(*rows, strict=True))
        self.id = int(np.uint64(xxhash.xxh64_intdigest(np.array(self.doc_keys, np.int64).tobytes())).astype(np.int64))
        self.lengths = np.array([len(f) - 1 if len(f) > 2 else 0 for f in found])
        words = np.concatenate([np.empty(0, np.uint64), *[f for f in found if len(f) > 2]])
        ends = np.cumsum(self.lengths[self.lengths > 0] + 1)
        inside = np.ones(max(len(words) - 1, 0), bool)
        inside[ends[:-1] - 1] = False  # from the end of a text to the start of the next
        self.first = np.flatnonzero(inside)
        self.pairs = pair_key(words[self.first], words[self.first + 1], bits, width)
        self.words = word_key(words, bits)

    def named(self) -> list[str]:
        return sorted({lang for lang, n in zip(self.langs, self.lengths, strict=True) if n})


def _units(batches: Batches, common: np.ndarray, bits: int, width: int, most: int) -> Iterator[Unit]:
    words, rows, held = Words(common), [], 0
    for batch in batches:
        for key, lang, text, doc_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = words(lang, text or "")
            rows.append((key, lang, doc_id, found))
            held += len(found)
            if held >= most:
                yield Unit(rows, bits, width)
                rows, held = [], 0
    if rows:
        yield Unit(rows, bits, width)


_ASKED = "unit long, kind int, shard int, keys binary, lang string"
_TOLD = "unit long, kind int, shard int, lang string, values binary, stats array<double>"
_SCORED = "doc_id long, lang string, n_words long, perplexity double, doc_key long"


def _told(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
    """What the blocks of a shard say of the keys that units ask for, in their order."""
    kind, shard = (k.as_py() for k in key)
    rows: list[dict] = []
    if kind == LANGUAGES:
        stats = dict(zip(known["lang"].to_pylist(), known["stats"].to_pylist(), strict=True))
        for unit, lang in zip(asked["unit"].to_pylist(), asked["lang"].to_pylist(), strict=True):
            rows.append({"unit": unit, "kind": kind, "shard": shard, "lang": lang, "stats": stats.get(lang)})
        return _rows(rows, _TOLD)
    if not asked.num_rows:
        return _rows(rows, _TOLD)
    height = 1 if kind == PAIRS else WORD_VALUES
    blocks = [unpacked_keys(x) for x in known["keys"].to_pylist()]
    values = [unpacked(x).reshape(height, -1) for x in known["values"].to_pylist()]
    keys = np.concatenate([*blocks, np.empty(0, np.uint64)])
    order = np.argsort(keys, kind="stable")
    keys = np.append(keys[order], np.uint64(2**64 - 1))
    table = np.concatenate([*values, np.zeros((height, 1), np.uint64)], axis=1)
    table = np.append(table[:, order], np.zeros((height, 1), np.uint64), axis=1)
    for unit, data in zip(asked["unit"].to_pylist(), asked["keys"].to_pylist(), strict=True):
        wanted = unpacked_keys(data)
        at = np.searchsorted(keys, wanted)
        told = np.where(keys[at] == wanted, table[:, at], np.uint64(0))
        rows.append({"unit": unit, "kind": kind, "shard": shard, "values": packed(told.reshape(-1))})
    return _rows(rows, _TOLD)


def _answers(folder: str, unit: int) -> list[dict]:
    """What was told a unit; rows that are there twice (two equal units) count once."""
    store, path = filesystem(f"{folder}/unit={unit}")
    files = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    rows: dict = {}
    for file in files:
        if file.base_name.startswith("part-"):
            with store.open_input_file(file.path) as opened:
                for row in pq.ParquetFile(opened).read().to_pylist():
                    rows[row["kind"], row["shard"], row["lang"] or ""] = row
    return [rows[k] for k in sorted(rows)]


def _perplexities(unit: Unit, rows: list[dict]) -> np.ndarray:
    """Of each document of a unit; not a number where there is none."""
    out = np.full(len(unit.lengths), np.nan)
    if not len(unit.words):
        return out
    words, word_at = np.unique(unit.words, return_inverse=True)
    pairs, one, pair_at = np.unique(unit.pairs, return_index=True, return_inverse=True)

    def of(kind: int, height: int, size: int) -> np.ndarray:
        parts = [unpacked(r["values"]).astype(np.float64).reshape(height, -1) for r in rows if r["kind"] == kind]
        values = np.concatenate([*parts, np.empty((height, 0))], axis=1)
        if values.shape[1] != size:
            raise RuntimeError("the rows came in another order than when their words were asked for: write the table first")
        return values

    total, k1, k2, k3, ends = of(WORDS, WORD_VALUES, len(words))
    (n,) = of(PAIRS, 1, len(pairs))
    stats = {r["lang"]: r["stats"] for r in rows if r["kind"] == LANGUAGES and r["stats"]}
    names = unit.named()
    numbers = np.array([stats.get(lang) or [np.nan] * 8 for lang in names])
    number_of = {lang: i for i, lang in enumerate(names)}
    doc = np.repeat(np.arange(len(unit.lengths)), unit.lengths)
    lang = np.array([number_of.get(x, 0) for x in unit.langs])[doc[one]]
    a, b = word_at[unit.first[one]], word_at[unit.first[one] + 1]

    def less(count: np.ndarray, begin: int) -> np.ndarray:
        off = numbers[lang, begin + np.clip(count, 1, 3).astype(np.int64) - 1]
        return np.where(count > 0, count - off, 0.0)

    guess = less(ends[b], 3) / numbers[lang, 6] + numbers[lang, 7]
    d1, d2, d3 = numbers[lang, :3].T
    left = k1[a] * d1 + k2[a] * d2 + k3[a] * d3
    context = np.maximum(total[a], 1)
    chance = np.where(total[a] > 0, less(n, 0) / context + left / context * guess, guess)
    logs = np.bincount(doc, np.log(chance)[pair_at], len(out))
    has = unit.lengths > 0
    out[has] = np.exp(-logs[has] / unit.lengths[has])
    return out


def score(
    docs: DataFrame, model: Model, id_col="doc_id", text_col="text", lang_col="lang", unit_words: int = UNIT_WORDS
) -> DataFrame:
    """(doc_id, lang, n_words, perplexity, doc_key) of every document.

    The rows are read twice and must come in the same order, as those of a table do; if not, this fails.
    """
    bits, width, common = model.bits, model.width, model.common
    named = F.coalesce(F.col(lang_col).cast("string"), F.lit(_NO_LANGUAGE))
    texts = docs.select(
        _key(id_col, text_col, lang_col).alias("doc_key"),
        named.alias("lang"),
        F.col(text_col).alias("text"),
        F.col(id_col).cast("long").alias("doc_id"),
    )

    def asked(batches: Batches) -> Batches:
        for unit in _units(batches, common, bits, width, unit_words):
            rows = [{"unit": unit.id, "kind": LANGUAGES, "lang": lang} for lang in unit.named()]
            for kind, keys, of in ((PAIRS, unit.pairs, width), (WORDS, unit.words, 64)):
                keys = _distinct(keys)
                for shard, begin, end in _cuts(keys, bits, of):
                    rows.append({"unit": unit.id, "kind": kind, "shard": shard, "keys": packed_keys(keys[begin:end])})
            yield from _rows(rows, _ASKED).to_batches()

    requests = texts.mapInArrow(asked, _ASKED)
    requests = requests.withColumn("shard", F.coalesce("shard", _shard_of_language(F.col("lang"), bits)))
    told = requests.groupBy("kind", "shard").cogroup(model.blocks.groupBy("kind", "shard")).applyInArrow(_told, _TOLD)
    folder = scratch_folder(docs.sparkSession, "perplexity-answers")
    told.repartition("unit").write.partitionBy("unit").parquet(folder)

    def finished(batches: Batches) -> Batches:
        for unit in _units(batches, common, bits, width, unit_words):
            found = _perplexities(unit, _answers(folder, unit.id))
            langs = [None if x == _NO_LANGUAGE else x for x in unit.langs]
            columns = [pa.array(unit.ids, pa.int64()), pa.array(langs, pa.string())]
            columns += [pa.array(np.maximum(unit.lengths - 1, 0)), pa.array(found, mask=np.isnan(found))]
            columns.append(pa.array(unit.doc_keys, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "n_words", "perplexity", "doc_key"])

    return texts.mapInArrow(finished, _SCORED)


def _scored(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    named = F.coalesce(F.col(lang_col).cast("string"), F.lit(_NO_LANGUAGE)).alias("lang")
    texts = docs.select(named, F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chosen = ids.where("NOT calibrates").select("doc_id")
    if chosen.count() <= MOST_SENT:  # or else the planner's join, which deals out the texts
        chosen = F.broadcast(chosen)
    model = train(texts.join(chosen, "doc_id").select("lang", "text"), shards_for(size))
    return written(score(docs, model, id_col, text_col, lang_col), "perplexities")


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    ids = written(trusted_ids(labels), "trusted")
    with released_shuffles(docs.sparkSession):
        scored = _scored(docs, ids, id_col, text_col, lang_col)
    bounds = scored.where("perplexity IS NOT NULL").join(ids, "doc_id").groupBy("lang").agg(
        F.percentile_approx("perplexity", LOW, 100_000).alias("least"),
        F.percentile_approx(F.when(F.col("calibrates"), F.col("perplexity")), HIGH, 100_000).alias("most"),
        F.lit(SLACK) * (1 + F.lit(FEW) / F.sqrt(F.greatest(F.count_if("calibrates"), F.lit(1)))),
    ).toDF("lang", "least", "most", "room")
    bounds = bounds.select(
        F.col("lang").alias("of"), (F.col("least") / F.col("room")).alias("low"), (F.col("most") * F.col("room")).alias("high")
    )
    kept = F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    judged = scored.join(bounds, F.col("lang").eqNullSafe(F.col("of")), "left").drop("of")
    return judged.withColumn("kept", kept)


def judge(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """(doc_id, lang, n_words, perplexity, low, high, kept) of every document."""
    return _judged(docs, labels, id_col, text_col, lang_col).drop("doc_key")


def without_poor(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, all columns as they are."""
    judged = _judged(docs, labels, id_col, text_col, lang_col)
    poor = written(judged.where("NOT kept").select(F.col("doc_key").alias("_poor_key")).distinct(), "poor")
    return docs.join(poor, _key(id_col, text_col, lang_col) == F.col("_poor_key"), "left_anti")
