"""Quality rules by how far a document's histograms lie from its language's.

Two histograms of a document, of character classes and of its language's common words, are
compared with the sums over all documents of the language by Jensen-Shannon distance (base 2,
0 to 1). A distance counts only for documents long enough for it, and base rules come first.

Defined results: a null or empty text has no words and fails the base; a null language is a
language of its own; a language without a list of common words is judged by characters alone;
rows are independent given the references, so repeated rows agree; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import Batches, arrow_map

#: Frequent function words by language.
COMMON_WORDS = {
    "en": "the of and to in is that for it as with was on are by this be at from or an not have he".split(),
    "fr": "de la le et les des en un une du que est pour dans qui par sur pas au plus ne se ce il".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más o pero".split(),
}
LEAST_WORDS = 50
MOST_REPEATED = 0.5
#: A distance counts from so many words on.
LEAST_WORDS_CHARS = 50
LEAST_WORDS_COMMON = 150
MOST_CHAR_DISTANCE = 0.3
MOST_WORD_DISTANCE = 0.32

_BLANKS = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_CLASSES = 8
VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, char_distance double, word_distance double"
)


def _class_table() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, sentence mark, other mark, beyond ASCII, rest."""
    table = np.full(256, 7, np.uint8)
    for b in range(256):
        if 97 <= b <= 122:
            table[b] = 0
        elif 65 <= b <= 90:
            table[b] = 1
        elif 48 <= b <= 57:
            table[b] = 2
        elif b in _BLANKS:
            table[b] = 3
        elif b in b".,;:!?'\"()-":
            table[b] = 4
        elif 33 <= b <= 126:
            table[b] = 5
        elif b >= 0xC0:  # the first byte of a character beyond ASCII stands for it
            table[b] = 6
    return table


_CLASS = _class_table()


def char_histogram(data: bytes) -> np.ndarray:
    counts = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=_CLASSES)
    counts[7] -= _continuations(data)
    return counts


def _continuations(data: bytes) -> int:
    a = np.frombuffer(data, np.uint8)
    return int(np.count_nonzero((a & 0xC0) == 0x80))


def word_forms(common: list[str]) -> dict[bytes, int]:
    """Bins by the forms of the common words: three cases, at most one mark at the end."""
    forms = {}
    for i, word in enumerate(common):
        for cased in (word, word.capitalize(), word.upper()):
            for mark in ("", *".,;:!?"):
                forms.setdefault((cased + mark).encode(), i)
    return forms


def word_histogram(words: list[bytes], forms: dict[bytes, int], bins: int) -> np.ndarray:
    """Counts of the common words, then of all other words."""
    counts = np.zeros(bins, np.int64)
    for i, n in Counter(map(forms.get, words)).items():
        counts[-1 if i is None else i] += n
    return counts


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; 0 if either is empty."""
    if not a.sum() or not b.sum():
        return 0.0
    p, q = a / a.sum(), b / b.sum()
    m = (p + q) / 2

    def divergence(x: np.ndarray) -> float:
        at = x > 0
        return float(np.sum(x[at] * np.log2(x[at] / m[at])))

    return float(np.sqrt(max(0.0, (divergence(p) + divergence(q)) / 2)))


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            total += i + 3 - max(i, covered)
            covered = i + 3
    return total


def repeated_lines(data: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in data.split(b"\n") if line.strip(_BLANKS)]
    return len(lines) - len(set(lines))


class _Forms(dict):
    """Word forms and bins by language, made when first asked for."""

    def __init__(self, lists: dict[str, list[str]]):
        super().__init__()
        self.lists = lists

    def __missing__(self, lang: str | None) -> tuple[dict[bytes, int], int]:
        common = self.lists.get(lang or "", [])
        self[lang] = (word_forms(common), len(common) + 1)
        return self[lang]


def references(
    docs: DataFrame, lists: dict[str, list[str]], text_col: str = "text", lang_col: str = "lang"
) -> dict[str | None, tuple[np.ndarray, np.ndarray]]:
    """Histograms of each language over all its documents: one row per language."""

    def run(batches: Batches) -> Batches:
        sums: dict[str | None, list[np.ndarray]] = {}
        forms = _Forms(lists)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                data = (text or "").encode()
                pair = [char_histogram(data), word_histogram(data.split(), *forms[lang])]
                kept = sums.get(lang)
                sums[lang] = pair if kept is None else [a + b for a, b in zip(kept, pair, strict=True)]
        rows = [
            (lang, kind, i, int(n))
            for lang, pair in sums.items()
            for kind in (0, 1)
            for i, n in enumerate(pair[kind])
        ]
        if rows:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "kind", "bin", "n"])

    chosen = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = chosen.mapInArrow(run, "lang string, kind int, bin int, n long")
    found: dict[str | None, tuple[np.ndarray, np.ndarray]] = {}
    for row in counts.groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")).collect():
        bins = len(lists.get(row["lang"] or "", [])) + 1
        pair = found.setdefault(row["lang"], (np.zeros(_CLASSES), np.zeros(bins)))
        pair[row["kind"]][row["bin"]] = row["n"]
    return found


def judge(
    docs: DataFrame,
    lists: dict[str, list[str]] = COMMON_WORDS,
    most_char_distance: float = MOST_CHAR_DISTANCE,
    most_word_distance: float = MOST_WORD_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Base figures, both distances and the verdict of every document."""
    known = references(docs, lists, text_col, lang_col)
    names = [f.split()[0] for f in VERDICT.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 2

    def make():
        forms = _Forms(lists)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                data = text.encode()
                words = data.split()
                n, repeats = len(words), repeated_words(words)
                failed = n < LEAST_WORDS or repeats > MOST_REPEATED * n
                listed_forms, bins = forms[lang]
                chars, listed = known[lang]
                by_char = distance(char_histogram(data), chars)
                by_word = distance(word_histogram(words, listed_forms, bins), listed) if bins > 1 else 0.0
                far = (n >= LEAST_WORDS_CHARS and by_char > most_char_distance) or (
                    n >= LEAST_WORDS_COMMON and by_word > most_word_distance
                )
                rows.append(
                    (
                        doc,
                        n,
                        len(text) - (len(data) - len(data.translate(None, _BLANKS))),
                        len(data) - len(data.translate(None, _SYMBOLS)),
                        repeated_lines(data),
                        repeats,
                        failed,
                        not failed and not far,
                        by_char,
                        by_word,
                    )
                )
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        return work

    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    )
    return arrow_map(chosen, make, VERDICT)
