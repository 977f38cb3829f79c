from __future__ import annotations

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LINE = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix jars of purple ink "


@pytest.fixture(autouse=True)
def _workers(spark):
    from landfall.llm.shared import let_workers_import

    let_workers_import(spark)


@pytest.fixture(scope="session")
def edge_rows(spark):
    """Rows of the small table, and nulls, empty and long texts, ties, copies, odd characters."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(80).collect()]
    unique = " ".join(f"word{i}" for i in range(90))
    rows += [
        (90001, None, "en", "a", 0),
        (90002, "", None, None, None),
        (90003, " \n\t ", "en", "a", 4),
        (90004, unique, "en", "a", None),
        (90005, unique, "en", "b", 1),
        (90005, unique, "en", "b", 1),
        (90006, unique.replace("word40", "WORD40 other"), None, None, 2),
        (90007, LINE * 3, "en", "a", 3),
        (90008, "x" * 700, "en", "a", 3),
        (90009, "naïve Straße 中文 ½ x² <|endoftext|> don't  a   b \n c", "xx", "a", 3),
        (90010, (LINE + "! ") * 400, "de", "hot", 3),
        (90011, "one two three", "en", "hot", 3),
        (90012, "One  TWO\nthree", "en", "hot", 3),
    ]
    return rows


@pytest.fixture
def edge(spark, edge_rows):
    """The rows in two files' worth of partitions, with further columns of clashing names."""
    frame = spark.createDataFrame(edge_rows, SCHEMA).repartition(3)
    clash = ["set_id", "anchor", "token", "part", "kind", "window", "id", "perplexity"]
    return frame.withColumns({name: F.lit("clash") for name in clash})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
