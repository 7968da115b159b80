"""Every registered query against its DuckDB oracle on the smallest fixture,
plus the driver's smoke entry.  (tests/oracle_check.py runs the same check
at sf0.01 from the command line.)"""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import compare, duck_connect

QUERIES = E.queries()
SQLS = E.oracle_sql()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "risk_level" in df.columns


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    status, n_spark, n_oracle, _ = compare(spark, con, name, QUERIES[name], SQLS.get(name), SF_SMALL)
    assert status in ("OK", "NO-SQL"), (status, n_spark, n_oracle)
