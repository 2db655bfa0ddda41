"""Key checks and plausibility reports."""

from datetime import date

from pyspark.sql import functions as F

from shelfflow.operators import facts, quality
from shelfflow.schemas import Params


def test_unique_and_null(shop):
    po = shop["purchase_orders"]
    assert [tuple(r) for r in quality.check_unique(po, ["batch_id"]).collect()] == [(11, 2)]
    assert quality.check_unique(po, ["po_line_id"]).count() == 0
    nulls = {r.column: r.nulls for r in quality.check_not_null(po, ["actual_delivery_date", "sku_id"]).collect()}
    assert nulls == {"actual_delivery_date": 1, "sku_id": 0}


def test_unique_keys_stay_in_all_tasks(spark):
    keys = spark.range(20_000).select((F.col("id") % 10_000).alias("k"), F.lit("x").alias("other"))
    repeated = quality.check_unique(keys, ["k"])
    tasks = [r["count"] for r in repeated.groupBy(F.spark_partition_id()).count().collect()]
    # Few bytes, but not merged into one task: a task's keys are bounded by the number of partitions.
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(tasks) == 10_000
    assert max(tasks) < 3_000


def test_repeated_null_and_hot_keys(spark):
    rows = spark.range(5_000).selectExpr("if(id < 4000, NULL, 7) AS a", "if(id < 4998, 'hot', string(id)) AS b")
    got = {tuple(r) for r in quality.check_unique(rows, ["a", "b"]).collect()}
    assert got == {(None, "hot", 4_000), (7, "hot", 998)}


def test_duplicates_over_all_tables(shop):
    assert quality.duplicate_keys(shop).count() == 0
    twice = shop.replaced(orders=shop["orders"].unionByName(shop["orders"].filter("order_id = 4")))
    assert [tuple(r) for r in quality.duplicate_keys(twice).collect()] == [("orders", "4", 2)]


def test_orphans(shop, frame):
    stray = frame("order_items", [{"order_item_id": 99, "order_id": 404, "sku_id": 1, "quantity": 1}])
    broken = shop.replaced(order_items=shop["order_items"].unionByName(stray))
    got = {(r.child, r.key_column): r.orphans for r in quality.orphan_counts(broken).collect()}
    assert got["order_items", "order_id"] == 1
    assert sum(got.values()) == 1
    listed = quality.check_foreign_key(broken["order_items"], broken["orders"], "order_id")
    assert [r.order_item_id for r in listed.collect()] == [99]


def test_schema(shop):
    assert quality.check_schema(shop["orders"], "orders") == []
    assert quality.check_schema(shop["orders"].drop("store_id"), "orders") == ["store_id: None instead of int"]


def test_sold_ratio(shop):
    row = quality.sold_purchased_ratio(shop).first()
    assert (row.total_sold, row.total_purchased, row.ratio_pct, row.in_band) == (21, 83, 25.3, False)
    assert quality.sold_purchased_ratio(shop, Params(sold_ratio_band=(20, 30))).first().in_band


def test_order_rate(shop):
    row = quality.orders_per_customer_month(shop).first()
    assert (row.delivered_orders, row.customers, row.orders_per_month, row.in_band) == (4, 2, 0.67, False)


def test_quantity_distribution(shop):
    got = {r.quantity: (r.items, r.share) for r in quality.quantity_distribution(shop["order_items"]).collect()}
    assert got[1] == (3, 3 / 7) and sum(n for n, _ in got.values()) == 7


def test_delivery_summary(shop):
    row = quality.delivery_summary(shop["purchase_orders"]).first()
    assert tuple(row) == (6, 83, 3, 2, 60.0, 40.0)


def test_negative_stock(shop):
    got = quality.negative_stock(facts.inventory_snapshot(facts.daily_movement(shop))).collect()
    assert [tuple(r) for r in got] == [(2, 3, date(2025, 1, 5), -2)]


def test_missing_opening_skips_products_without_demand(shop):
    got = {tuple(r) for r in quality.missing_opening(shop, date(2024, 12, 30)).collect()}
    assert got == {(s, k) for s in (1, 2, 3) for k in (1, 2, 4)} - {(1, 1)}


def test_category_counts(shop):
    assert {r.category: r.products for r in quality.category_counts(shop["products"]).collect()} == {"A": 2, "B": 2}


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    a = [r.id for r in quality.sample_rows(df, "id", 20, seed=1).collect()]
    assert a == [r.id for r in quality.sample_rows(df.repartition(7), "id", 20, seed=1).collect()]
    assert len(set(a)) == 20
    assert a != [r.id for r in quality.sample_rows(df, "id", 20, seed=2).collect()]
