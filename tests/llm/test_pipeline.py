"""All five stages of the pipeline: each against a plain version, and the run against the stages."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_removal

import corpus_pipeline
from landfall.llm import kneser_ney, toxicity
from landfall.llm.queries import END_ID, word_tokenizer
from landfall.llm.shared import written

SF = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(5)), strict=False))


def one_per_component(rows):
    """Rows that stay: the smallest id of each component of similar texts, and texts without words."""
    sets = [shingles(r["text"]) for r in rows]
    name = list(range(len(rows)))

    def find(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                name[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r["doc_id"]), r["doc_id"])
    return {r["doc_id"] for i, r in enumerate(rows) if not sets[i] or least[find(i)] == r["doc_id"]}


@pytest.fixture(scope="module")
def docs(spark):
    """The small table with copies near the threshold, nulls, empties and a column of a clashing name."""
    table = spark.read.parquet(f"{SF}/documents.parquet")
    words = [f"w{i}" for i in range(400)]
    near = list(words)
    for i in range(0, 320, 40):
        near[i + 20] = "other"
    far = list(words)
    for i in range(0, 400, 20):
        far[i + 10] = "other"
    rows = [(80001, " ".join(words)), (80002, " ".join(near)), (80003, " ".join(far)), (80004, None), (80005, "")]
    more = spark.createDataFrame([(i, t, "en", "x", 0) for i, t in rows], table.schema)
    return written(table.unionByName(more).withColumn("component", F.lit("clash")), "pipeline-test")


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_stages(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)

    good = written(stages["quality classifier"](spark, docs, SF), "good")
    assert good.columns == docs.columns
    assert ids(good) == ids(kneser_ney.judge(docs, labels).where("kept"))

    calm = written(stages["toxicity"](spark, good, SF), "calm")
    scored = toxicity.score(good, toxicity.learn_stems(good, labels))
    assert ids(calm) == ids(scored.where("predicted = 0")) and calm.columns == docs.columns

    single = written(stages["n-gram Jaccard join"](spark, docs, SF), "single")
    assert ids(single) == one_per_component(docs.collect())
    assert {80001, 80003} <= ids(single) and 80002 not in ids(single)

    clear = written(stages["suffix-array dedup"](spark, single, SF), "clear")
    before = [(r["doc_id"], r["text"]) for r in single.collect()]
    kept = {d: n - removed for d, n, removed, *_ in brute_removal(before)}
    assert clear.columns == docs.columns
    for r in clear.collect():
        assert len((r["text"] or "").encode()) <= kept[r["doc_id"]]
        assert len((r["text"] or "").encode()) >= kept[r["doc_id"]] - 12  # characters cut in two go

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    want = Counter()
    for r in clear.collect():
        tokens = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, END_ID]
        want[r["doc_id"]] = len(tokens)
    pieces = stages["packing"](spark, clear, SF).collect()
    packed = Counter()
    for p in pieces:
        packed[p["doc_id"]] += p["length"]
    assert packed == want


def test_run_is_its_stages_in_a_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), name.replace(" ", "-"))
    want = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_stages_on_an_empty_table(spark, docs):
    none = written(docs.where("false"), "none")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0
