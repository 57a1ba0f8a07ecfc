"""Every operator query that SQL can express against that SQL, over the whole small tables."""

import pytest
from check import compare, compare_types, duckdb_tables

from cohortlens.llm.oracle import ORACLE
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duckdb_tables(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    result = QUERIES[name](spark, SF).cache()
    assert compare_types(result, con, ORACLE[name]) == ""
    assert compare(result, con, ORACLE[name]) == ""
