"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from closetops.oracle.check import compare, type_mismatches
from closetops.oracle.queries_sql import SQL
from closetops.registry import QUERIES

from conftest import SF_SMALL


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


def test_entry_registers_every_report():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck_small, name):
    df = QUERIES[name](spark, SF_SMALL)
    r = compare(df, duck_small, SQL[name])
    assert r["ok"], r.get("why")
    assert not type_mismatches(df, duck_small, SQL[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:1] == ["asofdate"] or "total" in df.columns
    assert df.count() >= 0
