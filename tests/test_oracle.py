"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from strata import oracles
from strata.queries import QUERIES
from strata.sources.fixtures import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(oracles.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert res["status"].startswith("OK"), res
