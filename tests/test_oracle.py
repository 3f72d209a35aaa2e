"""Every query with an SQL counterpart, compared value by value."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from riskflow.plans.incremental_oracle import INCREMENTAL_ORACLE
from riskflow.plans.oracle import ORACLE as SCANS_ORACLE
from riskflow.plans.queries import QUERIES

ORACLE = {**SCANS_ORACLE, **INCREMENTAL_ORACLE}


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


def _assert_stays_in_the_jvm(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, database, name):
    df = contract.queries()[name](spark, sf_dir)
    _assert_stays_in_the_jvm(df)
    assert differences(df, database, contract.oracle_sql()[name]) == []


ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_returns_rows(spark, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    _assert_stays_in_the_jvm(df)
    assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[-3:] == ["probability", "prediction", "risk_band"]
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
