"""Ids of whole texts by the tokenizers library, with a bounded memo of words.

A tokenizer that drops white space gives a text the ids of its words one after the other, so
each word needs the library once. The memo is cleared when full: memory is bounded, the result
does not depend on it.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

MEMO_WORDS = 600_000
#: Letters below this code point have had their classes in every version of Unicode in use.
_STABLE_LETTERS = chr(0x250)
#: Marks that make one token when they end a word; the apostrophe may belong to a contraction.
_MARKS = b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"


class Memo(dict):
    """A dictionary that computes what it lacks and is cleared when it has ``most`` entries."""

    def __init__(self, compute: Callable, most: int):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each of the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    letters = dict(zip(shown, map(chr, shown), strict=True))
    letters |= {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class WordEncoder:
    """Encodes texts with one tokenizer file; ids come as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, memo_words: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self._words = Memo(self._word, memo_words)
        self._stems = Memo(self._stem, memo_words * 3 // 2)
        self._letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        #: words may be taken one by one: white space is dropped and the normal form is NFC, lower case
        self.by_word = spec["model"].get("end_of_word_suffix") == "</w>" and [
            step["type"] for step in (spec["normalizer"] or {}).get("normalizers", [])
        ] == ["NFC", "Replace", "Lowercase"]

    def encode(self, text: str) -> bytes:
        if self.by_word:
            return b"".join(map(self._words.__getitem__, text.encode().split()))
        return self._library(text)

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _word(self, word: bytes) -> bytes:
        if b"<" in word:  # may hold a special token, which is found before lower-casing
            return self._library(word.decode())
        word = word.lower()
        stem = word.rstrip(_MARKS)
        if len(stem) < len(word) and stem[-1:].isalnum():
            return self._stems[stem] + self._stems[word[len(stem) :]]
        return self._stems[word]

    def _stem(self, stem: bytes) -> bytes:
        if stem.isascii():
            shown = stem.decode() if stem.isalpha() else ""
        else:
            text = stem.decode().lower()
            plain = text.isalpha() and max(text) < _STABLE_LETTERS  # such letters are in NFC
            shown = "".join([self._letters[b] for b in text.encode()]) if plain else ""
        if shown:
            ids = [token.id for token in self.tokenizer.model.tokenize(shown)]
            return array(self._code, ids).tobytes()
        return self._library(stem.decode())


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of this worker process."""
    return WordEncoder(path)
