"""Every registered query against its SQL, on the smallest tables."""

import inspect
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from feedlake.plans.oracle import ORACLE
from feedlake.plans.queries import QUERIES

from .oracle_check import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_of_the_engine_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", oracle_sql())
def test_query_matches_its_sql(spark, con, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert differences(df, con, name) is None


def test_entry(spark):
    got = entry(spark)
    assert got.columns == ["period_from", "period_to", "n_rows", "digest"]
    assert got.count() > 0


def test_library_uses_no_udf_or_local_checkpoint():
    package = Path(inspect.getfile(entry)).parent / "feedlake"
    text = "\n".join(path.read_text() for path in package.rglob("*.py"))
    for word in ("localCheckpoint", "F.udf", "pandas_udf", "crossJoin", "toPandas", ".rdd"):
        assert word not in text, word
