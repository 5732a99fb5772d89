"""Every registered query that has SQL gives the rows of that SQL."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    ok, note = compare(spark, name, QUERIES[name], ORACLES[name], sf_dir)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = {r["category_encode"]: r["n_samples"] for r in entry.entry(spark).collect()}
    assert set(rows) <= {0, 1} and sum(rows.values()) > 0
