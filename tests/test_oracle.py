"""Every named query against the same query in SQL, over the whole small tables."""

import pytest
from check import compare, compare_types, duckdb_tables

import __spark_entry__ as contract
from cohortlens.plans.oracle import ORACLE
from cohortlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duckdb_tables(SF)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == set()
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    result, sql = QUERIES[name](spark, SF), ORACLE[name]
    assert compare_types(result, con, sql) == ""
    assert compare(result, con, sql) == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 17
    assert df.count() > 0
