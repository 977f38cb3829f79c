"""The Jaccard join and the removal of repeats against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from landfall.llm import jaccard, suffix_repeats


def shingles(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 4:
        return frozenset([tuple(words)])
    return frozenset(zip(words, words[1:], words[2:], words[3:], strict=False))


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    name = list(range(len(rows)))

    def find(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                name[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return Counter((r[0], len(s), least[find(i)] if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets, strict=True)))


def found(frame):
    return Counter(tuple(r) for r in jaccard.similar_documents(frame).select("doc_id", "n_shingles", "component_id").collect())


def test_components_equal_brute_force(edge, edge_rows):
    assert found(edge) == brute_components(edge_rows)


def test_large_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ALL_PAIRS", 4)
    draw = random.Random(3)
    base = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for at in draw.sample(range(120), draw.randrange(8)):
            words[at] = f"v{draw.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == brute_components(rows)


@pytest.mark.parametrize("tail", [1, 2, 12, 24])
def test_tails_of_cut_groups_stay_in_their_group(tail, monkeypatch):
    """Every class of a cut group is a member of a large one, and every part has a hub."""
    monkeypatch.setattr(jaccard, "_PART", 50)
    rows = 100 + tail - 1  # cut at 100 rows but for the last one
    frames = []
    for token, count in ((7, rows), (8, 3)):
        sizes = np.arange(count, dtype=np.int64) + 1000
        frames.append((np.full(count, token), sizes + token * 10**6, sizes << jaccard._PLACE_BITS))
    t, s, n = (np.concatenate(c) for c in zip(*frames, strict=True))
    cuts = [0, 100, *([rows] if rows > 100 else []), len(t)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c[i:j]) for c in (t, s, n)], names=["token", "set_id", "size_place"])
        for i, j in zip(cuts, cuts[1:], strict=False)
    ]
    made = [r for b in jaccard._group_pairs(85, 24, [], 4)(iter(batches)) for r in b.to_pylist()]
    members = {r["a"] for r in made if r["kind"] == jaccard._MEMBER}
    assert members == set(s[t == 7].tolist())
    hubs = [r for r in made if r["kind"] == jaccard._HUB]
    assert len(hubs) == 2 and {r["token"] for r in hubs} == {7}


@pytest.mark.parametrize("tail", [1, 12, 24])
def test_cut_groups_equal_brute_force(spark, tail, monkeypatch):
    monkeypatch.setattr(jaccard, "_PART", 50)
    draw = random.Random(tail)
    base = [f"w{draw.randrange(10**6)}" for _ in range(100)]
    texts = []
    for _ in range(50 + tail):
        words = list(base)
        words[draw.randrange(100)] = f"v{draw.randrange(10**6)}"
        texts.append(" ".join(words + [f"x{i}" for i in range(draw.randrange(8))]))
    rows = list(enumerate(texts))
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "51")
    try:
        assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute_components(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_components_without_rows_or_ids(spark, empty):
    assert jaccard.similar_documents(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e"), (None, "a b c d e"), (5, None)], "doc_id long, text string")
    assert found(rows) == Counter({(None, 2, None): 2, (5, 0, 5): 1})


def test_one_of_each_stays(edge, edge_rows):
    kept = jaccard.one_of_each(edge, jaccard.similar_documents(edge))
    assert kept.columns == edge.columns
    brute = brute_components(edge_rows)
    wanted = {d for d, n, c in brute if n and d == c} | {d for d, n, _ in brute if not n}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(wanted)


@pytest.mark.parametrize(("changed", "stay"), [(22, 1), (23, 2)])
def test_pipeline_stage_links_from_four_fifths_of_five_words(spark, changed, stay):
    words = [f"w{i}" for i in range(1004)]
    other = [f"v{i}" if i % 40 == 20 and i < 40 * changed else w for i, w in enumerate(words)]
    sets = [set(zip(*(x[i:] for i in range(5)), strict=False)) for x in (words, other)]
    assert (len(sets[0] & sets[1]) >= 0.8 * len(sets[0] | sets[1])) == (stay == 1)
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id long, text string")
    assert corpus_pipeline.one_of_each(spark, docs, "").count() == stay


@pytest.mark.parametrize("letters", [1, 2, 3])
def test_suffixes_are_sorted(letters):
    draw = random.Random(letters)
    for _ in range(40):
        text = bytes(draw.choice(b"abc"[:letters]) for _ in range(draw.randint(1, 250)))
        order = suffix_repeats.suffix_array(np.frombuffer(text, np.uint8), 256).tolist()
        assert order == sorted(range(len(text)), key=lambda i: text[i:])


def brute_removal(rows, window=200):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = Counter(t[i : i + window] for _, t in texts for i in range(len(t) - window + 1))
    result = Counter()
    for doc, text in texts:
        covered = np.zeros(len(text), bool)
        for i in range(len(text) - window + 1):
            if seen[text[i : i + window]] > 1:
                covered[i : i + window] = True
        runs = int((np.diff(np.r_[False, covered].astype(int)) == 1).sum())
        left = np.frombuffer(text, np.uint8)[~covered].tobytes()
        result[doc, len(text), int(covered.sum()), runs, hashlib.sha256(left).hexdigest()] += 1
    return result


@pytest.mark.parametrize("most", [2, 2_000])
def test_removal_equals_brute_force(edge, edge_rows, most, monkeypatch):
    monkeypatch.setattr(suffix_repeats, "MOST_SEGMENTS", most)
    assert Counter(tuple(r) for r in suffix_repeats.removal_digests(edge).collect()) == brute_removal(edge_rows)


PASSAGE = "".join(random.Random(4).choices("abcdefgh ", k=460))


def rims(n):
    """One passage in many documents, whole or in part, between texts of their own."""
    draw = random.Random(n)

    def own(most):
        return "".join(draw.choice("klmnopqrstuvwxyz ") for _ in range(draw.randrange(most)))

    rows = [(i, own(300) + PASSAGE[draw.randrange(40) :] + own(300)) for i in range(n)]
    rows += [(n + i, own(3) + PASSAGE[: draw.randrange(190, 300)] + own(3)) for i in range(n)]
    return rows + [(3 * n, "ab" * 400), (3 * n + 1, "x" + "ab" * 300)]


@pytest.mark.parametrize("most", [2, 20])
def test_crowded_anchors_are_cut_by_offsets(spark, most, monkeypatch):
    rows, made = rims(150), {}
    whole = suffix_repeats.written

    def counted(frame, purpose):
        out = whole(frame, purpose)
        made[purpose] = out.count()
        return out

    monkeypatch.setattr(suffix_repeats, "written", counted)
    monkeypatch.setattr(suffix_repeats, "MOST_SEGMENTS", most)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = Counter(tuple(r) for r in suffix_repeats.removal_digests(docs).collect())
    assert found == brute_removal(rows)
    # a row per window would be some 150 for each segment of a crowded anchor
    segments = made["segment-pieces"]
    assert made["ranges-64"] < 6 * segments
    assert all(made.get(f"ranges-{w}", 0) < 8 * segments for w in (16, 4, 1))


def test_texts_after_removal(edge, empty):
    left = suffix_repeats.without_repeats(edge)
    assert left.columns == edge.columns
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in left.collect()}
    assert texts[90005] == ("", 0)  # repeated rows remove each other's text
    assert texts[90001] == (None, None) and texts[90002] == ("", 0)
    assert texts[90011] == ("one two three", 13)
    assert suffix_repeats.without_repeats(empty).count() == 0
