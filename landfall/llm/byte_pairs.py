"""Byte-level BPE: text to ids by merge ranks, ids to text by vocabulary strings.

A word's symbols form a doubly linked list; a heap holds the adjacent pairs that can merge, by
rank and then place. The lowest is merged into its left symbol, its new pairs are pushed, and
entries whose symbols have changed since are skipped when they come up. Words repeat, so each
process keeps a bounded memo of them.

Defined results: a null text is empty and has no ids; a special token of the file in a text is
one id, as in the library; a word may have any length; rows are independent, so ties, repeated rows,
empty tables and further columns change nothing.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.encoding import Memo, byte_letters
from landfall.llm.shared import arrow_map

#: Fixed value: how byte-level vocabularies of this kind cut a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_WORDS = 500_000
#: Where this occurs, pieces between blanks do not stand for themselves.
_BLANK_RUN = re.compile(r"\s (?:\s|\Z)")
#: Marks that make one word after letters; the apostrophe may begin a contraction.
_MARKS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
#: Letters below this have had their classes in every version of Unicode in use.
_STABLE_LETTERS = chr(0x250)

DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class BytePairs:
    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: b for b, letter in enumerate(letters)}
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [b""] * (max([*vocab.values(), *specials.values()]) + 1)
        for shown, i in vocab.items():
            self.strings[i] = bytes(byte_of[c] for c in shown) if shown not in specials else b""
        for shown, i in specials.items():
            self.strings[i] = shown.encode()
        self.singles = [vocab[letter] for letter in letters]
        self.ranks: dict[tuple[int, int], int] = {}
        self.lefts, self.rights, self.merged = [], [], []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = rank
            self.lefts.append(vocab[a])
            self.rights.append(vocab[b])
            self.merged.append(vocab[a + b])
        self.specials = specials
        self._special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self._words = regex.compile(WORDS).findall
        self._word_ids = Memo(self._merge, 2 * memo_words)
        self._piece_ids = Memo(self._piece, memo_words)

    def _merge(self, word: str) -> tuple[int, ...]:
        """Ids of one word."""
        symbols = [self.singles[b] for b in word.encode()]
        n = len(symbols)
        if n == 1:
            return (symbols[0],)
        find, lefts, rights, merged = self.ranks.get, self.lefts, self.rights, self.merged
        # an entry is a rank and, in as many low bits as the word needs, the place of the left symbol
        width = n.bit_length()
        places = (1 << width) - 1
        ranks = map(find, zip(symbols, symbols[1:], strict=False))
        heap = [rank << width | i for i, rank in enumerate(ranks) if rank is not None]
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        symbols.append(-1)
        while heap:
            entry = heappop(heap)
            i, rank = entry & places, entry >> width
            j = after[i]
            if symbols[i] != lefts[rank] or symbols[j] != rights[rank]:
                continue  # stale: a symbol of the pair has merged since
            symbols[i] = new = merged[rank]
            symbols[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := find((new, symbols[k]))) is not None:
                    heappush(heap, rank << width | i)
            h = before[i]
            if h >= 0 and (rank := find((symbols[h], new))) is not None:
                heappush(heap, rank << width | h)
        return tuple([s for s in symbols if s >= 0])

    def _piece(self, piece: str) -> tuple[int, ...]:
        stem = piece.rstrip(_MARKS)
        bare = stem[1:] if stem[:1] == " " else stem
        if bare.isalpha() and max(bare) < _STABLE_LETTERS:  # a run of letters, then one of marks
            ids = self._word_ids[stem]
            return ids if len(stem) == len(piece) else ids + self._word_ids[piece[len(stem) :]]
        return tuple([i for word in self._words(piece) for i in self._word_ids[word]])

    def _plain(self, text: str) -> list[int]:
        if _BLANK_RUN.search(text):
            words, memo = self._words(text), self._word_ids
        else:
            first, *rest = text.split(" ")
            words, memo = [first, *[" " + piece for piece in rest]], self._piece_ids
        ids: list[int] = []
        for word in map(memo.__getitem__, words):
            ids += word
        return ids

    def encode(self, text: str) -> list[int]:
        if not self._special or not self._special.search(text):
            return self._plain(text) if text else []
        ids, at = [], 0
        for found in self._special.finditer(text):
            if found.start() > at:
                ids += self._plain(text[at : found.start()])
            ids.append(self.specials[found[0]])
            at = found.end()
        return ids + (self._plain(text[at:]) if at < len(text) else [])

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """The coder of this worker process."""
    return BytePairs(path)


def encode_texts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every text: (doc_id, ids)."""

    def make():
        coder = byte_pairs(tokenizer)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = pa.array([coder.encode(t or "") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

        return work

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(chosen, make, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """Texts of (doc_id, ids): (doc_id, text)."""

    def make():
        coder = byte_pairs(tokenizer)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = pa.array([coder.decode(i or []) for i in batch.column(1).to_pylist()], pa.string())
            return pa.RecordBatch.from_arrays([batch.column(0), texts], names=["doc_id", "text"])

        return work

    return arrow_map(encoded.select("doc_id", "ids"), make, "doc_id long, text string")


def round_trip_digests(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Digests of the ids of every text and of the text decoded from those ids."""

    def make():
        coder = byte_pairs(tokenizer)
        shown = list(map(str, range(len(coder.strings))))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, id_sums, text_sums = [], [], []
            for text in batch.column(1).to_pylist():
                ids = coder.encode(text or "")
                counts.append(len(ids))
                listed = ",".join(map(shown.__getitem__, ids))
                id_sums.append(hashlib.sha256(listed.encode()).hexdigest())
                text_sums.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_sums), pa.array(text_sums)]
            return pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            )

        return work

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(chosen, make, DIGESTS)
