"""Registered queries against DuckDB or against the operators' own checks."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from gridpulse.llm.oracle import ORACLE_SQL
from gridpulse.llm.queries import QUERIES
from scripts.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_all_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE_SQL[name], con, SF_SMALL)
    assert r["spark_rows"] > 0 and r["cols_match"] and r["values_match"] and r["types_match"], r
