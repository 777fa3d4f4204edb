"""Every registered fleet query against its brute-force DuckDB statement (sf0.001)."""

import pytest

import __spark_entry__ as E
from geotrail.plans import catalog
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
# (the corpus queries that SQL can't express are tested against brute force in tests/llm)
QUERIES = {n: q for n, q in E.queries().items() if n in catalog.QUERIES}
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(catalog.QUERIES) and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "average_speed_kph" in df.columns
