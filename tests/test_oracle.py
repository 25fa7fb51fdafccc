"""Every registered query against its DuckDB oracle (the driver's check, locally)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, duck

KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare(spark, name, sf_dir, con)
    assert ok, msg


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_queries_without_oracle_run(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["user_id", "sessions_total", "sessions_focused", "sessions_distracted", "prompt"]
