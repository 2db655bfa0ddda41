"""Preparation operators."""

from datetime import date
from decimal import Decimal as D

import pytest

from shelfflow.operators import prep
from shelfflow.operators.prep import CATEGORY_RULES


def feed(spark, rows):
    return spark.createDataFrame(rows, "feed_row bigint, Category string, name string, mrp int, weightInGms int")


def test_products_are_trimmed_deduplicated_and_numbered_in_feed_order(spark):
    rows = [
        (70000, " Munchies ", "Chips", 1999, 50),
        (3, "Fruits & Vegetables", " Onion ", 2500, 1000),
        (9, "Fruits & Vegetables", "Onion", 2500, 1000),
        (5, "Fruits & Vegetables", "Onion", 2500, 500),
        (70001, "Munchies", " Chips", 1999, 50),
        (2**40, "Unheard of", "Thing", 5, 1),
    ]
    got = [tuple(r) for r in prep.build_products(feed(spark, rows)).orderBy("sku_id").collect()]
    assert got == [
        (1, "Onion", "Fruits & Vegetables", D("25.00"), 1000, True, 2, 7, 10),
        (2, "Onion", "Fruits & Vegetables", D("25.00"), 500, True, 2, 7, 10),
        (3, "Chips", "Munchies", D("19.99"), 50, False, 90, 180, 6),
        (4, "Thing", "Unheard of", D("0.05"), 1, False, 180, 180, 1),
    ]


def test_rules_cover_the_known_categories():
    assert len(CATEGORY_RULES) == 14
    assert all(low <= high for _, low, high, _ in CATEGORY_RULES.values())


def test_store_weights(spark):
    stores = spark.createDataFrame(
        [(1, "South Delhi", 10), (2, "North Delhi", 50), (3, "West Delhi", 50), (4, "Moon", 30), (5, "East Delhi", 20), (6, "South Delhi", 40)],
        "store_id int, zone string, capacity_units int",
    )
    got = {r.store_id: r.demand_weight for r in prep.store_demand_weights(stores).collect()}
    # Capacity order 2, 3 | 6, 4 | 5, 1.
    assert got == {2: 1.12, 3: 1.06, 6: 1.18, 4: 1.0, 5: 0.92, 1: 1.1}


def test_batch_keys_number_store_supplier_day(shop):
    got = prep.assign_batch_keys(shop["purchase_orders"].drop("batch_id")).collect()
    assert len(got) == 6
    ids = {r.po_line_id: r.batch_id for r in got}
    keys = {r.po_line_id: (r.store_id, r.supplier_id, r.actual_delivery_date or date.min) for r in got}
    order = sorted(set(keys.values()))
    assert ids == {line: order.index(k) + 1 for line, k in keys.items()}


def test_opening_batch_keys_ignore_the_day(shop):
    ids = {r.po_line_id: r.batch_id for r in prep.assign_batch_keys(shop["purchase_orders"], opening=True).collect()}
    assert ids == {"PO-1": 1, "PO-2": 1, "PO-3": 2, "PO-4": 3, "PO-6": 4, "PO-5": 5}


@pytest.mark.parametrize("partitions", ["1", "50"])
def test_batch_keys_with_nulls(spark, partitions):
    """NULL store, supplier and day are values of their own and come first, however many ranges there are."""
    lines = [(s, v, day) for s in (None, 1) for v in (None, 7, 8) for day in (None, date(2025, 1, 1), date(2025, 1, 2))]
    columns = "store_id int, supplier_id int, actual_delivery_date date"
    po = spark.createDataFrame(lines * 2, columns)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = prep.assign_batch_keys(po).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(lines) * 2
    assert {tuple(r[:3]): r.batch_id for r in got} == {line: n for n, line in enumerate(lines, 1)}


def test_receipts_and_opening_stock(shop, rows_of):
    receipts = rows_of(prep.daily_receipts(shop["purchase_orders"]))
    assert {(r["sku_id"], r["quantity_received"]) for r in receipts} == {(1, 10), (2, 10), (3, 5), (4, 8)}
    opening = prep.opening_stock(shop["purchase_orders"], shop["dark_stores"], shop["products"], date(2024, 12, 30))
    got = {(r.store_id, r.sku_id): r.opening_stock for r in opening.collect()}
    assert len(got) == 12 and got[1, 1] == 10 and sum(got.values()) == 10


def test_supplier_multiplicity(shop):
    got = {r.suppliers: r.skus for r in prep.supplier_multiplicity(shop["product_suppliers"]).collect()}
    assert got == {1: 3, 2: 1}


def test_expiry_is_null_while_undelivered(shop):
    got = {r.po_line_id: r.expiry_date for r in prep.with_expiry(shop["purchase_orders"], shop["products"]).collect()}
    assert got["PO-1"] == date(2025, 1, 2)
    assert got["PO-5"] is None


def test_order_date(shop):
    assert prep.with_order_date(shop["orders"].drop("order_date")).filter("order_id = 1").first().order_date == date(2025, 1, 2)
