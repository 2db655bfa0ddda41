"""Facts on a hand-made shop."""

from datetime import date
from decimal import Decimal as D

from pyspark.sql import functions as F

from shelfflow.operators import facts
from shelfflow.schemas import Params


def test_daily_sales_counts_delivered_only(shop, rows_of):
    got = {(r["store_id"], r["sku_id"], str(r["order_date"])): r for r in rows_of(facts.daily_sales(shop))}
    assert set(got) == {(1, 1, "2025-01-02"), (1, 1, "2025-01-04"), (1, 2, "2025-01-02"), (1, 2, "2025-04-02"), (2, 3, "2025-01-05")}
    row = got[1, 1, "2025-01-02"]
    assert (row["total_quantity_sold"], row["total_revenue"], row["total_profit"]) == (4, D("36.00"), D("12.00"))
    assert got[2, 3, "2025-01-05"]["total_profit"] == D("19.25")


def test_movement_joins_both_sides_and_skips_undelivered(shop, rows_of):
    got = {(r["store_id"], r["sku_id"], str(r["movement_date"])): r for r in rows_of(facts.daily_movement(shop))}
    both = got[2, 3, "2025-01-05"]
    assert (both["total_quantity_sold"], both["total_quantity_purchased"]) == (7, 5)
    assert both["total_purchased_value"] == D("10.00")
    assert sum(r["total_quantity_purchased"] for r in got.values()) == 6 + 4 + 10 + 5 + 8
    assert got[1, 1, "2024-12-30"]["total_sold_value"] == D("0.00")


def test_snapshot_counts_earlier_movement_but_hides_it(shop, rows_of):
    got = rows_of(facts.inventory_snapshot(facts.daily_movement(shop)))
    assert min(r["movement_date"] for r in got) >= date(2025, 1, 1)
    sku1 = [r for r in got if (r["store_id"], r["sku_id"]) == (1, 1)]
    sku1.sort(key=lambda r: r["movement_date"])
    assert [(r["opening_stock"], r["closing_stock"]) for r in sku1] == [(10, 6), (6, 4)]


def test_opening_equals_previous_closing(shop):
    everything = facts.inventory_snapshot(facts.daily_movement(shop), Params(start=date(2000, 1, 1))).collect()
    by_key = {}
    for r in sorted(everything, key=lambda r: r.movement_date):
        assert r.opening_stock == by_key.get((r.store_id, r.sku_id), 0)
        by_key[r.store_id, r.sku_id] = r.closing_stock


def test_wastage_adds_lines_of_a_batch_and_subtracts_sales(shop, rows_of):
    got = {(r["batch_id"], r["sku_id"]): r for r in rows_of(facts.wastage_log(shop, shop["order_items"]))}
    # Batch 11 expired on 2025-01-02: ten units bought in two lines, six sold.
    assert got[11, 1]["quantity_purchased"] == 10
    assert got[11, 1]["quantity_sold"] == 6
    assert got[11, 1]["quantity_wasted"] == 4
    assert got[11, 1]["expiry_date"] == date(2025, 1, 2)
    # Never sold; never delivered batch 14 is absent.
    assert got[15, 4]["quantity_wasted"] == 8
    assert (14, 3) not in got


def test_wastage_cutoff(shop):
    early = facts.wastage_log(shop, shop["order_items"], Params(wastage_as_of=date(2025, 1, 1)))
    assert early.count() == 0


def test_fully_sold_batch_is_not_wasted(shop, frame):
    items = shop["order_items"].selectExpr("*").drop("quantity").selectExpr(
        "order_item_id", "order_id", "sku_id", "10 AS quantity", "unit_price_at_sale", "discount_pct", "batch_id"
    )
    log = facts.wastage_log(shop, items)
    assert log.filter("batch_id = 11").count() == 0


def test_wastage_stays_in_all_tasks(shop, frame, spark):
    lines = [
        {"batch_id": 100 + n, "po_line_id": f"L{n}", "store_id": 1, "sku_id": 1, "actual_delivery_date": date(2025, 1, 1), "quantity_ordered": 2}
        for n in range(400)
    ]
    t = shop.replaced(purchase_orders=frame("purchase_orders", lines))
    log = facts.wastage_log(t, t["order_items"])
    tasks = [r["count"] for r in log.groupBy(F.spark_partition_id()).count().collect()]
    # Few bytes, but not merged into one task: a task's rows are bounded by the number of partitions.
    assert len(tasks) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(tasks) == 400
    assert max(tasks) < 200
