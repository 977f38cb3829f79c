"""License scans by template markup compiled into token automata.

A template is written in words with regions: ``[[...]]`` may be absent, ``{{a-b}}`` stands for
any ``a`` to ``b`` words, ``x|y`` for either word. Compiled, it is an automaton over words that
accepts a stretch of text whose mandatory wording is exactly the template's. Templates begin
with a mandatory word, which starts the automaton.

Words are runs of letters and digits after lower-casing A-Z; any character beyond ASCII counts
as a letter. Defined results: a null or empty text has no words, no labels and score 0; rows are
independent, so ties, repeated rows, empty tables and further columns change nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.shared import arrow_map

#: The phrases of the base and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_GRANT = "released|licensed|distributed|available|published"
_WARRANTY = (
    "this software is provided by {{1-12}} as is and any express or implied warranties including but not "
    "limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"
)
#: Label, strength of evidence, template. Wording of public license texts and notices.
TEMPLATES = (
    ("mit-notice", 0.8, f"{_GRANT} under [[the terms of]] the mit|expat license"),
    (
        "apache-2.0-notice",
        0.8,
        f"{_GRANT} under [[the terms of]] the apache license [[version]] {{{{0-1}}}} 2 [[0]]",
    ),
    (
        "gpl-notice",
        0.8,
        f"{_GRANT} under [[the terms of]] the gnu [[lesser|affero]] general public license [[as published by the "
        "free software foundation]] [[either]] [[version {{1-2}}]]",
    ),
    (
        "gpl-notice",
        0.9,
        "this program|library is free software you can redistribute it and or modify it under the terms of the gnu "
        "[[lesser|affero|library]] general public license as published by the free software foundation",
    ),
    (
        "cc-by-notice",
        0.8,
        f"{_GRANT} under [[a|the]] [[terms of the]] creative commons attribution [[{{{{1-2}}}}]] [[international]] "
        "[[public]] license",
    ),
    ("cc-by-notice", 0.8, f"{_GRANT} under [[a|the]] cc by {{{{0-2}}}} [[license]]"),
    (
        "mit-text",
        1.0,
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies "
        "or substantial portions of the software",
    ),
    (
        "isc-text",
        1.0,
        "permission to use copy modify and|or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "bsd-text",
        1.0,
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met [[1]] redistributions of source code must retain the above copyright notice "
        "this list of conditions and the following disclaimer [[2]] redistributions in binary form must reproduce the "
        "above copyright notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution [[[[3]] neither the name of {{1-10}} nor the names of its "
        f"contributors may be used to endorse or promote products derived from this software]] {_WARRANTY}",
    ),
    (
        "apache-2.0-notice",
        1.0,
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
        "the license",
    ),
    (
        "zlib-text",
        1.0,
        "this software is provided as is without any express or implied warranty in no event will the authors be held "
        "liable for any damages arising from the use of this software",
    ),
)
BASE_STRENGTH = 0.5

SCAN = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double"
)

#: A-Z to a-z, other ASCII beside letters and digits to a blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_MARKUP = re.compile(r"\[\[|\]\]|\{\{(\d+)-(\d+)\}\}|[^\s\[\]{}]+")


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


@dataclass
class Automaton:
    """States with moves by word, by any word (None) and without a word."""

    label: str
    strength: float
    moves: list[dict[bytes | None, list[int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    final: int = 0

    def state(self) -> int:
        self.moves.append({})
        self.free.append([])
        return len(self.moves) - 1

    def move(self, at: int, word: bytes | None) -> int:
        after = self.state()
        self.moves[at].setdefault(word, []).append(after)
        return after

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for after in self.free[todo.pop()]:
                if after not in states:
                    states.add(after)
                    todo.append(after)
        return states

    def longest(self, words: list[bytes], start: int) -> int:
        """The end of the longest stretch accepted from ``start``; -1 if there is none."""
        states, end = self.closure({0}), -1
        for i in range(start, len(words)):
            reached: set[int] = set()
            for s in states:
                reached.update(self.moves[s].get(words[i], ()), self.moves[s].get(None, ()))
            if not reached:
                break
            states = self.closure(reached)
            if self.final in states:
                end = i + 1
        return end


def compile_template(label: str, strength: float, template: str) -> Automaton:
    made = Automaton(label, strength)
    at, opened = made.state(), []
    for found in _MARKUP.finditer(template):
        if found[0] == "[[":
            opened.append(at)
        elif found[0] == "]]":
            after = made.state()
            made.free[at].append(after)
            made.free[opened.pop()].append(after)
            at = after
        elif found[1] is not None:
            after, least, most = made.state(), int(found[1]), int(found[2])
            for k in range(most + 1):
                if k >= least:
                    made.free[at].append(after)
                if k < most:
                    at = made.move(at, None)
            at = after
        else:
            after = made.state()
            for word in found[0].split("|"):
                made.free[made.move(at, word.encode())].append(after)
            at = after
    if opened or made.free[0] or None in made.moves[0]:
        raise ValueError(f"template {label} must close its regions and begin with a mandatory word")
    made.final = at
    return made


class Scanner:
    def __init__(self, base: dict[str, str] = BASE, templates=TEMPLATES):
        automata = [(True, compile_template(label, BASE_STRENGTH, phrase)) for phrase, label in base.items()]
        automata += [(False, compile_template(*t)) for t in templates]
        self.starts: dict[bytes, list[tuple[bool, Automaton]]] = {}
        for entry in automata:
            for word in entry[1].moves[0]:
                self.starts.setdefault(word, []).append(entry)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, bool, str, float]]:
        """(start, end, whether of the base, label, strength) of every accepted stretch."""
        found, starts = [], self.starts
        for i in [i for i, w in enumerate(words) if w in starts]:
            for base, automaton in starts[words[i]]:
                end = automaton.longest(words, i)
                if end >= 0:
                    found.append((i, end, base, automaton.label, automaton.strength))
        return found


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, places and labels per document; ``score`` is the strength of the best match."""

    def make():
        scanner = Scanner()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns: list[list] = [[] for _ in range(7)]
            for text in batch.column(1).to_pylist():
                words = words_of(text or "")
                found = scanner.matches(words)
                places = [i for i, _, base, _, _ in found if base]
                row = (
                    len(words),
                    len(places),
                    min(places, default=None),
                    max(places, default=None),
                    ",".join(sorted({label for _, _, base, label, _ in found if base})),
                    ",".join(sorted({m[3] for m in found})),
                    max((m[4] for m in found), default=0.0),
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = [f.split()[0] for f in SCAN.split(", ")]
            return pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

        return work

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return arrow_map(chosen, make, SCAN)
