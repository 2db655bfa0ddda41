"""Every registered query against its SQL on the smallest benchmark folder."""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_statement_has_a_query():
    queries = entry_points.queries()
    assert set(SQL) <= set(queries)
    own = {name for name in queries if not name.startswith("op") and name != "pipeline"}
    assert own - set(SQL) == {"demand_model", "forecasts", "reorder_points_model"}


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_equals_sql(spark, con, key):
    _, difference = compare(entry_points.queries()[key](spark, FOLDER), con, SQL[key])
    assert difference == ""


@pytest.mark.parametrize("key", ["abc_classification", "sales_velocity", "prep_batch_keys", "prep_products", "prep_store_weights"])
def test_ranking_in_many_ranges_equals_sql(spark, con, key):
    """Many ranges instead of the few of a small session."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, difference = compare(entry_points.queries()[key](spark, FOLDER), con, SQL[key])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert difference == ""


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["store_id", "store_name", "sku_id"]
    assert df.count() > 0
