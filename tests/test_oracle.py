"""Every registered query against its DuckDB oracle (sf0.001: quick)."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import compare, duck

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "cost" in df.columns


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duck(SF)
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
