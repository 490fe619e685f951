"""Every registered query with an oracle equals its DuckDB SQL (sf0.001 by default)."""

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_ORACLE
from tests.harness import compare, duck

QUERIES = entry_mod.queries()
ORACLE = entry_mod.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_ORACLE)
    ok, msg = compare(df, con, ORACLE[name])
    assert ok, f"{name}: {msg}"


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["store_id", "sales_person_id", "full_name", "sales_month", "total_sales", "incentive"]
    assert df.count() > 0
