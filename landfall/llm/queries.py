"""The operators over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import (
    decontaminate,
    divergence,
    jaccard,
    kneser_ney,
    licenses,
    neighbours,
    prefix_trie,
    spelling,
    suffix_repeats,
    toxicity,
)
from landfall.llm.byte_pairs import round_trip_digests
from landfall.llm.packing import pack
from landfall.llm.shared import let_workers_import, table
from landfall.llm.token_files import read_token_files, write_token_files
from landfall.sources.scratch import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Appended to each document that is stored or packed.
END_ID = 2


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(run)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        let_workers_import(spark)
        return run(spark, sf_dir)

    QUERIES[run.__name__] = prepared
    return prepared


def word_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, word_tokenizer(), END_ID)
    return read_token_files(spark, folder)


@query
def op2_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return round_trip_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), word_tokenizer(), END_ID)


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn_stems(docs, table(spark, sf_dir, "labels")))


@query
def op8_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents"))


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id")


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.removal_digests(table(spark, sf_dir, "documents"))


#: The stated query set: rows whose id this divides.
QUERY_EVERY = 20


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.search(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))


@query
def op7_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query
def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
