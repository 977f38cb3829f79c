"""Every registered query against its SQL, and the driver's entry points."""

from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import pytest
from check_oracles import compare, database

from __spark_entry__ import entry, oracle_sql, queries
from landfall.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(queries()) >= set(QUERIES)
    assert set(oracle_sql()) >= set(ORACLES)


def test_other_queries_stay_without_what_the_corpus_operators_need():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e;"
        f"assert set(e.queries()) == set(e.oracle_sql()) and len(e.queries()) == {len(QUERIES)}"
    )
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["event_name", "events", "earliest_millis"]
    assert result.count() == 5


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, db, name):
    result = QUERIES[name](spark, SF)
    assert compare(result, db, name) == ""
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert not re.search("EvalPython|InPandas|InArrow", plan)
