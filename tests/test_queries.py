"""Every registered query against its checking SQL, and again with most keys treated as hot."""

import pytest
from compare import differences
from conftest import TINY

from __spark_entry__ import entry, oracle_sql, queries
from altimart.operators import skew
from altimart.queries import QUERIES

NAMES = list(QUERIES)
GUARDED = ["fct_flights", "fct_bookings", "fct_tickets", "dim_routes", "win_competitor", "win_loyalty"]


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, name):
    assert differences(queries()[name](spark, TINY), tables, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", GUARDED)
def test_query_with_hot_keys(spark, tables, name):
    spark.conf.set(skew.ROWS_SETTING, "16")
    try:
        df = queries()[name](spark, TINY)
    finally:
        spark.conf.unset(skew.ROWS_SETTING)
    assert differences(df, tables, oracle_sql()[name]) == []


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "avg_load_factor_pct" in df.columns
