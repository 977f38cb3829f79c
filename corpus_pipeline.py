"""A corpus from documents: good text, no toxicity, one of each near copy, no repeats, packed.

Each stage works on what the one before it kept, written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import jaccard, kneser_ney, packing, suffix_repeats, toxicity
from landfall.llm.queries import END_ID, word_tokenizer
from landfall.llm.shared import let_workers_import, table, written

#: Near copies of this stage: word shingles and their least similarity; op9 has its own.
NEAR_WORDS, NEAR_PERCENT = 5, 80

#: Bytes of an Arrow batch: five operators share Python workers, whose memory should hold one batch of each.
BATCH_BYTES = "8m"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def prepare(spark: SparkSession) -> None:
    let_workers_import(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return kneser_ney.without_poor(docs, table(spark, sf_dir, "labels"))


def calm_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.without_toxic(docs, toxicity.learn_stems(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return jaccard.one_of_each(docs, jaccard.similar_documents(docs, words=NEAR_WORDS, percent=NEAR_PERCENT))


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return suffix_repeats.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs, word_tokenizer(), END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_text),
    ("toxicity", calm_text),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", no_repeats),
    ("packing", packed),
]

#: Trained models, tokens and suffix sorting are beyond SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
