"""Registered queries of the subpackage against their DuckDB SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from strata.llm.registry import ORACLES, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import compare


def test_all_queries_are_registered():
    assert set(ORACLES) <= set(QUERIES)
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, len(QUERIES) + 1))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = compare(spark, con, key, QUERIES[key], ORACLES[key], SF_SMALL)
    assert res["status"].startswith("OK"), res
