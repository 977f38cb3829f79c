"""Spelling variants against brute force over deletions."""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import pytest

from landfall.llm import spelling
from landfall.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LETTERS = {chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]}


def runs_of(text):
    run = ""
    for c in (text or "") + " ":
        if c in LETTERS:
            run += c.lower() if c.isascii() else c
        elif run:
            yield run
            run = ""


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in runs_of(text):
            h = crc32(f"{doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: set() for w in counts}
    wild = {}
    for w in counts:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in counts:
                near[w].add(shorter)
                near[shorter].add(w)
            wild.setdefault((i, shorter), []).append(w)
    for same in wild.values():
        for a in same:
            near[a].update(set(same) - {a})
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


def rows(frame):
    return sorted(tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_agrees_with_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(QUERIES["op11_spelling_variants"](spark, SF)) == brute(docs)


def crowd():
    """Words around a few stems: substitutions, insertions of a neighbouring letter, chains of forms."""
    texts = [f"x{c}zzabcdefgh zzabcd{c}efgh aaaaaa{c}aa " * 2 for c in "abcdefghijklmnopqrst"]
    texts += ["aaaaaaa aaaaaaaa aaaaaaaaa " * 3, "straßen straÀen STRAßEN çççççççç ççççççç " * 2]
    texts += ["lengthy " * 900, "lengthyy " * 60, "lengthyyy " * 3, "Lengthyyy. lengthyyyy lengthyyyy short run runs"]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("tile", [4, 1024])
def test_large_blocks_are_dealt_into_tiles(spark, tile):
    docs = [*crowd(), (None, "nowhere nowhere"), (7, None), (8, "")]
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    found = rows(spelling.variants(frame.repartition(5), tile=tile))
    assert found == brute(docs)
    chain = {w: (form, root) for w, form, root, *_ in found}
    assert chain["lengthyyy"] == ("lengthyy", "lengthy")
    assert chain["lengthyy"] == ("lengthy", "lengthy")


def test_edge_rows(spark, edge, edge_rows):
    assert rows(spelling.variants(edge)) == brute([(r[0], r[1]) for r in edge_rows])


def test_empty_table(empty):
    assert rows(spelling.variants(empty)) == []
