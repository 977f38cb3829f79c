"""Licenses, toxicity, perplexity and divergence: base figures by brute force, verdicts by held-out labels."""

from __future__ import annotations

import math
import os
import re
import tempfile
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from landfall.llm import divergence, kneser_ney, licenses, toxicity
from landfall.llm.shared import released_shuffles

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))


def brute_licenses(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_license_base_equals_brute_force(tables, edge, edge_rows):
    docs, _ = tables
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for frame, known in ((docs, rows), (edge, [r[:2] for r in edge_rows])):
        got = Counter(tuple(r)[:6] for r in licenses.scan(frame).collect())
        assert got == Counter((d, *brute_licenses(t)) for d, t in known)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", {"mit", "mit-notice"}),
        ("Released under the terms of the MIT license", {"mit", "mit-notice"}),
        ("Licensed under the Apache License, Version 2.0", {"apache", "apache-2.0-notice"}),
        ("licensed beneath the MIT license", {"mit"}),
        ("CC BY-SA", {"cc-by"}),
        ("permission is hereby granted", set()),
        (None, set()),
    ],
)
def test_license_templates(text, labels):
    assert {m[3] for m in licenses.Scanner().matches(licenses.words_of(text or ""))} == labels


def test_template_regions():
    made = licenses.compile_template("x", 1.0, "a [[b {{1-2}}]] c|d")
    for text, end in (("a c", 2), ("a b q d", 4), ("a b q r c", 5), ("a b c", -1), ("a q c", -1), ("c", -1)):
        assert made.longest([w.encode() for w in text.split()], 0) == end
    with pytest.raises(ValueError, match="mandatory"):
        licenses.compile_template("x", 1.0, "[[a]] b")


def test_toxicity_on_held_out_labels(tables):
    docs, labels = tables
    got = toxicity.score(docs, toxicity.learn_stems(docs, labels)).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["predicted"] for r in held if r["toxic"] == 0) == 0
    # the smallest table has few examples beside the English ones
    assert sum(r["predicted"] for r in held if r["toxic"] == 1) >= 0.7 * sum(r["toxic"] == 1 for r in held)


def test_clauses_weigh_more_than_words():
    reads = toxicity.WordTransducer({"idio": 3.0})
    weight = [toxicity.text_weight(t, reads)[0] for t in ("an idiot", "you idiot", "not an idiot", "she said idiot", "")]
    assert weight[1] > weight[0] > weight[2] and weight[1] > weight[3] and weight[4] == 0
    assert toxicity.text_weight("the kill switch", reads)[0] == 0 < toxicity.text_weight("kill them", reads)[0]


def test_stems_of_minorities_short_and_long_words(spark):
    rows = [(f"filler{i} moronic text", "en", 1) for i in range(600)]
    rows += [(f"filler{i} assessment of text", "en", 0) for i in range(600)]
    rows += [(f"wort{i} achlicheib", "de", 1) for i in range(12)] + [(f"wort{i} achlichkeit", "de", 0) for i in range(12)]
    rows += [(f"mot{i} ass", None, 1) for i in range(12)]
    rows += [("the same zebra text", "en", 1)] * 60  # one text, however many copies
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, toxic int")
    reads = toxicity.WordTransducer(toxicity.learn_stems(frame, frame.select("doc_id", "toxic")))
    for word in ("moronic", "achlicheib", "ass"):
        assert toxicity.text_weight(f"a {word}", reads)[0] > 0, word
    for word in ("achlichkeit", "assessment", "zebra", "filler1"):
        assert toxicity.text_weight(f"a {word}", reads)[0] == 0, word
    long_words = spark.createDataFrame([(0, "x" * 200_000, "en")], "doc_id long, text string, lang string")
    assert toxicity.learn_stems(long_words, long_words.selectExpr("doc_id", "1 AS toxic")) == {}


def test_toxicity_edges(spark, edge, edge_rows, empty):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    stems = toxicity.learn_stems(edge, none)
    assert stems == {} and toxicity.score(edge, stems).count() == len(edge_rows)
    assert toxicity.without_toxic(edge, stems).columns == edge.columns
    assert toxicity.score(empty, {"idio": 1.0}).count() == 0


def test_perplexity_finds_poor_text(tables):
    docs, labels = tables
    got = kneser_ney.judge(docs, labels).join(labels, "doc_id").collect()
    good = [r["kept"] for r in got if r["quality"] == 1]
    poor = [r["kept"] for r in got if r["quality"] == 0]
    assert sum(good) >= 0.96 * len(good) and sum(poor) <= 0.15 * len(poor)


def discounts(counts):
    n = [sum(v == k for v in counts) for k in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if y is not None and n[k - 1] else k / 2 for k in (1, 2, 3)]
    return [min(max(d, 0.05), 0.95 * k) for k, d in enumerate(raw, 1)]


class BruteModel:
    """Modified Kneser-Ney over words, one probability after the other."""

    def __init__(self, texts):
        self.pairs = Counter(p for t in texts for p in self.pairs_of(t))
        ends = Counter(b for _, b in self.pairs)
        d1, self.d2 = discounts(ends.values()), discounts(self.pairs.values())
        every = sum(ends.values())
        self.unknown = sum(d1[min(n, 3) - 1] for n in ends.values()) / every / (len(ends) + 1)
        self.p1 = {w: (n - d1[min(n, 3) - 1]) / every + self.unknown for w, n in ends.items()}
        self.total, self.off = Counter(), Counter()
        for (a, _), n in self.pairs.items():
            self.total[a] += n
            self.off[a] += self.d2[min(n, 3) - 1]

    @staticmethod
    def pairs_of(text):
        words = kneser_ney._WORDS.findall((text or "").lower())
        return list(zip(["", *words], [*words, " "], strict=True)) if words else []

    def p(self, a, b):
        guess = self.p1.get(b, self.unknown)
        if a not in self.total:
            return guess
        n = self.pairs.get((a, b), 0)
        own = (n - self.d2[min(n, 3) - 1]) / self.total[a] if n else 0
        return own + self.off[a] / self.total[a] * guess

    def perplexity(self, text):
        pairs = self.pairs_of(text)
        return math.exp(-sum(math.log(self.p(a, b)) for a, b in pairs) / len(pairs)) if pairs else None


@pytest.mark.parametrize("bits, unit", [(None, 3_000_000), (0, 1), (5, 400)])
def test_perplexities_equal_brute_force(spark, edge, edge_rows, bits, unit):
    """However many shards there are, and however few documents ask together."""
    rows = [(r[0], r[1], r[2] or "\0") for r in edge_rows]
    trained = [r for r in rows if r[0] % 2]
    models = {g: BruteModel([t for _, t, lang in trained if lang == g]) for g in {r[2] for r in trained if r[1]}}
    texts = spark.createDataFrame([(g, t) for _, t, g in trained], "lang string, text string")
    model = kneser_ney.train(texts, bits)
    got = kneser_ney.score(edge, model, unit_words=unit).collect()
    known = {(d, g): models[g].perplexity(t) if g in models else None for d, t, g in rows}
    assert len(got) == len(rows)
    for r in got:
        expected = known[r["doc_id"], r["lang"] or "\0"]
        assert r["perplexity"] == (expected if expected is None else pytest.approx(expected, rel=1e-9)), r


def test_probabilities_sum_to_one():
    model = BruteModel(["a rose is a rose is a rose", "is it a rose ?"])
    for before in ("", "a", "rose", "unseen"):
        assert sum(model.p(before, w) for w in [*model.p1, "unseen"]) == pytest.approx(1.0)


def test_trusted_ids_too_many_to_send(tables, monkeypatch):
    docs, labels = tables
    sent = kneser_ney.judge(docs, labels).orderBy("doc_id").collect()
    monkeypatch.setattr(kneser_ney, "MOST_SENT", 0)
    assert kneser_ney.judge(docs, labels).orderBy("doc_id").collect() == sent


def test_shuffles_go_with_their_job(spark, tmp_path):
    """Shuffle files of jobs inside do not wait for the driver's garbage collector; the setting is put back."""
    root = Path(os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir()))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")

    def left(folder):
        known = set(root.glob("blockmgr-*/*/shuffle_*.data"))
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / folder))
        for _ in range(50):  # files go in the background
            found = set(root.glob("blockmgr-*/*/shuffle_*.data")) - known
            if not found:
                break
            time.sleep(0.1)
        return len(found)

    assert left("plain") > 0
    with released_shuffles(spark):
        assert left("released") == 0
    with pytest.raises(ZeroDivisionError), released_shuffles(spark):
        raise ZeroDivisionError
    assert spark.conf.get(name, "false") == before


def test_packed_numbers():
    for numbers in ([], [0], [2**64 - 1, 0, 5], list(range(0, 10**6, 7))):
        array = np.array(numbers, np.uint64)
        assert kneser_ney.unpacked(kneser_ney.packed(array)).tolist() == numbers
        assert kneser_ney.unpacked_keys(kneser_ney.packed_keys(np.sort(array))).tolist() == sorted(numbers)
    assert [kneser_ney.shards_for(n) for n in (0, 1, 16 << 20, (16 << 20) + 1, 80 << 20)] == [0, 0, 0, 1, 3]


def test_keys_of_common_pairs_are_exact_and_dealt_out():
    a, b = (x.reshape(-1).astype(np.uint64) for x in np.meshgrid(np.arange(300), np.arange(300)))
    for bits, width in ((0, 33), (1, 40), (6, 55), (12, 64), (20, 64)):
        keys = kneser_ney.pair_key(a, b, bits, width)
        assert len(np.unique(keys)) == len(a) and int(keys.max()) < 1 << width
        shards = np.bincount((keys >> np.uint64(width - bits) if bits else keys * np.uint64(0)).astype(np.int64), minlength=1 << bits)
        assert bits > 6 or shards.max() < 1.2 * len(a) / (1 << bits)
        hashed = kneser_ney.pair_key(a + np.uint64(1 << 16), b, bits, width)
        assert not np.isin(hashed, keys).any()


def test_requests_take_few_bytes(tables):
    docs, _ = tables
    texts = docs.selectExpr("coalesce(lang, '') AS lang", "text")
    common = kneser_ney._common_words(texts, 1)
    assert len(common) == len(set(common.tolist())) <= 1 << kneser_ney.COMMON_BITS
    for coded, least, most in ((common, 0.5, 3.0), (common[:0], 4.0, 6.0)):
        words = kneser_ney.Words(coded)
        unit = kneser_ney.Unit([(0, r["lang"], 0, words(r["lang"], r["text"] or "")) for r in texts.collect()], 2, 56)
        keys = np.unique(unit.pairs)
        size = sum(len(kneser_ney.packed_keys(keys[i:j])) for _, i, j in kneser_ney._cuts(keys, 2, 56))
        assert least < size / len(keys) < most


def test_words_of_any_script():
    found = kneser_ney._WORDS.findall("naïve_x2 | 中文字 かな don't")
    assert found == ["naïve", "_", "x2", "|", "中", "文", "字", "か", "な", "don", "'", "t"]


def test_perplexity_edges(spark, edge, edge_rows, empty):
    labels = spark.createDataFrame([(r[0], 1, None) for r in edge_rows[:60]], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in kneser_ney.judge(edge, labels).collect()}
    assert got[90001]["perplexity"] is None and got[90001]["kept"]
    assert got[90009]["perplexity"] is None  # no trusted text in its language
    assert kneser_ney.judge(empty, labels).count() == 0
    assert kneser_ney.judge(edge, labels.limit(0)).where("NOT kept").count() == 0


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def test_rules_equal_brute_force(tables, edge, edge_rows):
    docs, _ = tables
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for frame, known in ((docs, rows), (edge, [r[:2] for r in edge_rows])):
        got = divergence.judge(frame).collect()
        assert Counter(tuple(r)[:7] for r in got) == Counter((d, *brute_rules(t)) for d, t in known)
        assert not any(r["kept"] for r in got if r["base_failed"])


def test_divergence_keeps_good_text(tables, empty):
    docs, labels = tables
    got = divergence.judge(docs).join(labels, "doc_id").where("NOT base_failed").collect()
    assert all(r["kept"] for r in got if r["quality"] == 1)
    poor = [r["kept"] for r in got if r["quality"] == 0]
    assert sum(poor) < 0.4 * len(poor)
    assert divergence.judge(empty).count() == 0
