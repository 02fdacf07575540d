"""Every query of the library against its SQL, on the smallest test folder."""

import pytest

import __spark_entry__ as contract
from conftest import SMALL
from demandloom.verification import oracle, queries
from demandloom.verification.check import compare, duckdb_tables
from demandloom.verification.queries import Tables, over

NAMES = list(queries.registered())


@pytest.fixture(scope="module")
def con():
    return duckdb_tables(SMALL)


@pytest.fixture(scope="module")
def tables(spark):
    """Shared by all queries, so that each stage is stored once."""
    return Tables(spark, SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(tables, con, name):
    df = over(tables, name)
    verdict, _ = compare(con, name, df)
    assert verdict == "ok"
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan


def test_every_query_has_sql():
    assert set(oracle.statements()) == set(NAMES)


def test_entry_file_registers_the_whole_library():
    assert set(NAMES) <= set(contract.queries())
    assert set(oracle.statements()) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_feature_table(spark):
    assert len(contract.entry(spark).columns) == 28
