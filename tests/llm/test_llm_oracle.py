"""The queries that SQL can express against DuckDB."""

import pytest

from closetops.llm.registry import QUERIES, SQL
from closetops.oracle.check import compare

from conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck_small, name):
    r = compare(QUERIES[name](spark, SF_SMALL), duck_small, SQL[name])
    assert r["ok"], r.get("why")


def test_registered():
    import __spark_entry__ as entry
    assert set(QUERIES) <= set(entry.queries())
