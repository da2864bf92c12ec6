"""Every registered query with a SQL twin gives the same rows as DuckDB; those with p-values at two scales."""

import pytest
from check_oracles import compare, connect

from traceframe import checks

SF = "/root/testdata/sf0.01"
QUERIES, ORACLES = checks.load()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    rows, outcome = compare(spark, con, SF, name, QUERIES[name], ORACLES[name])
    assert outcome == "match", outcome
    assert rows > 0


@pytest.mark.parametrize("name", [n for n in sorted(ORACLES) if "drift" in n or n in ("monitoring_report", "shapiro_wilk", "small_sample_distance")])
def test_query_matches_sql_at_the_smallest_scale(spark, name):
    small = "/root/testdata/sf0.001"
    rows, outcome = compare(spark, connect(small), small, name, QUERIES[name], ORACLES[name])
    assert outcome == "match", outcome
    assert rows > 0


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
