"""KPIs on hand-made rows: ties, empty denominators, missing deliveries, repeated batches."""

from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfflow.operators import facts, kpis, stores
from shelfflow.schemas import Params


@pytest.fixture(scope="module")
def movement(shop):
    return facts.daily_movement(shop).cache()


@pytest.fixture(scope="module")
def snapshot(movement):
    return facts.inventory_snapshot(movement).cache()


def sales_of(spark, revenues):
    return spark.createDataFrame(
        [(k, f"P{k}", D(str(r))) for k, r in revenues.items()], "sku_id int, sku_name string, total_revenue decimal(27,2)"
    )


def test_abc_ties_share_one_cumulative_value(spark):
    # 60 %, then two SKUs of 15 % each: both stand at 90 %, although one alone would reach 75 %.
    got = {r.sku_id: r for r in kpis.abc_classification(sales_of(spark, {1: 60, 2: 15, 3: 15, 4: 10})).collect()}
    assert [got[k].cumulative_revenue_pct for k in (1, 2, 3, 4)] == [60.0, 90.0, 90.0, 100.0]
    assert [got[k].abc_class for k in (1, 2, 3, 4)] == ["A", "B", "B", "C"]
    assert [got[k].cumulative_sku_pct for k in (1, 2, 3, 4)] == [25.0, 75.0, 75.0, 100.0]
    assert got[1].sku_pct == 25.0


def test_abc_classifies_the_rounded_value(spark):
    got = kpis.abc_classification(sales_of(spark, {1: 70004, 2: 29996})).filter("sku_id = 1").first()
    assert (got.cumulative_revenue_pct, got.abc_class) == (70.0, "A")


def test_abc_without_revenue(spark):
    got = kpis.abc_classification(sales_of(spark, {1: 0, 2: 0})).collect()
    assert {(r.cumulative_revenue_pct, r.abc_class) for r in got} == {(None, "C")}


def test_abc_limits_are_parameters(spark):
    got = kpis.abc_classification(sales_of(spark, {1: 60, 2: 40}), Params(abc_a=50, abc_b=60))
    assert {r.sku_id: r.abc_class for r in got.collect()} == {1: "B", 2: "C"}


def test_velocity_and_available_days(shop, snapshot):
    got = {(r.store_id, r.sku_id): r for r in kpis.sales_velocity(snapshot, shop).collect()}
    row = got[1, 1]
    assert (row.total_units_sold, row.days_available) == (6, 2)
    assert row.sales_velocity == pytest.approx(6 / 90)
    assert row.adjusted_velocity_days_available == 3.0
    # Two SKUs only: the first two deciles, so both are fast.
    assert row.classification == "Fast-moving"


def test_velocity_without_stock_has_no_adjusted_value(shop, spark):
    snap = spark.createDataFrame(
        [(1, 1, date(2025, 1, 2), -5, 0, 2, -7)],
        "store_id int, sku_id int, movement_date date, opening_stock bigint, total_quantity_purchased bigint, "
        "total_quantity_sold bigint, closing_stock bigint",
    )
    row = kpis.sales_velocity(snap, shop).first()
    assert (row.days_available, row.adjusted_velocity_days_available) == (0, None)


def test_velocity_period_and_scale(shop, snapshot):
    row = kpis.sales_velocity(snapshot, shop, Params(period_days=365), scale=4).filter("store_id = 1 AND sku_id = 1").first()
    assert row.sales_velocity == 0.0164


def test_velocity_deciles(spark, shop):
    n = 23
    snap = spark.range(1, n + 1).selectExpr(
        "1 AS store_id", "cast(id AS int) AS sku_id", "DATE'2025-01-02' AS movement_date", "10L AS opening_stock",
        "0L AS total_quantity_purchased", "id div 3 AS total_quantity_sold", "10L AS closing_stock",
    )
    tables = shop.replaced(products=spark.range(1, n + 1).selectExpr("cast(id AS int) AS sku_id", "'x' AS sku_name", "'c' AS category"))
    got = {r.sku_id: r.classification for r in kpis.sales_velocity(snap, tables).collect()}
    order = sorted(range(1, n + 1), key=lambda k: (-(k // 3), k))
    # 23 rows in ten tiles: three tiles of 3, then seven of 2.
    tiles = [t for t, size in enumerate([3] * 3 + [2] * 7, 1) for _ in range(size)]
    names = {t: "Fast-moving" if t <= 3 else "Medium-moving" if t <= 7 else "Slow-moving" for t in range(1, 11)}
    assert got == {k: names[t] for k, t in zip(order, tiles)}


def test_turnover_and_empty_stock(spark):
    schema = (
        "store_id int, store_name string, sku_id int, sku_name string, movement_date date, opening_stock bigint, "
        "total_quantity_sold bigint, closing_stock bigint"
    )
    rows = [
        (1, "S", 1, "P", date(2025, 1, 1), 10, 4, 6),
        (1, "S", 1, "P", date(2025, 1, 2), 6, 1, 5),
        (1, "S", 2, "Q", date(2025, 1, 2), 3, 6, -3),
        (1, "S", 3, "R", date(2025, 1, 2), 4, 0, 4),
        (1, "S", 3, "R", date(2025, 4, 2), 4, 100, 4),
    ]
    got = {r.sku_id: r for r in kpis.inventory_turnover(spark.createDataFrame(rows, schema)).collect()}
    assert (got[1].avg_inventory, got[1].inventory_turnover_ratio, got[1].days_of_inventory_on_hand) == (6.75, 0.74, 121.5)
    assert (got[2].avg_inventory, got[2].inventory_turnover_ratio, got[2].days_of_inventory_on_hand) == (0.0, None, None)
    assert (got[3].inventory_turnover_ratio, got[3].days_of_inventory_on_hand) == (0.0, None)


def test_stock_outs(movement):
    got = {(r.store_id, r.sku_id, str(r.stock_out_date)): r for r in kpis.stock_out_incidents(movement).collect()}
    assert list(got) == [(2, 3, "2025-01-05")]
    row = got[2, 3, "2025-01-05"]
    assert (row.cumulative_purchased, row.cumulative_sold, row.closing_stock) == (5, 7, -2)


def test_stock_outs_with_demand_only(spark):
    rows = [(1, "S", 1, "P", date(2025, 1, 1), 0, 5), (1, "S", 1, "P", date(2025, 1, 2), 4, 0), (1, "S", 1, "P", date(2025, 1, 3), 0, 1)]
    moves = spark.createDataFrame(
        rows,
        "store_id int, store_name string, sku_id int, sku_name string, movement_date date, "
        "total_quantity_purchased bigint, total_quantity_sold bigint",
    )
    assert kpis.stock_out_incidents(moves).count() == 3
    assert kpis.stock_out_incidents(moves, require_demand=True).count() == 2


def test_store_movement_values_stock_from_the_start_only(shop, movement):
    got = {(r.store_id, str(r.movement_date)): r for r in kpis.store_movement(movement, shop["products"]).collect()}
    before = got[1, "2024-12-30"]
    assert (before.purchase_value, before.inventory_value, before.stockout_flag) == (D("50.00"), D("0.00"), 0)
    after = got[1, "2025-01-02"]
    # SKU 1 closes at 6, SKU 2 at 9.
    assert after.inventory_value == D("144.00")
    # Negative stock is not the zero that raises the flag.
    assert got[2, "2025-01-05"].stockout_flag == 0


def test_store_movement_flag_at_zero(shop, movement, spark):
    sold_out = spark.createDataFrame(
        [(1, "S1", date(2025, 1, 3), 1, "P1", 10, D("1.00"), 10, D("1.00"))], movement.schema
    )
    assert kpis.store_movement(sold_out, shop["products"]).first().stockout_flag == 1


def test_supplier_reliability(shop):
    got = {r.supplier_id: r for r in kpis.supplier_reliability(shop["purchase_orders"], shop["suppliers"]).collect()}
    one = got[1]
    # Lines: promised 8, 10, 4 days; actual 10, 10, 4.
    assert (one.total_orders, one.avg_promised_lead_time_days, one.avg_actual_lead_time_days) == (3, 7.33, 8.0)
    assert one.lead_time_stddev_days == 2.83
    assert one.avg_lead_time_deviation_days == 0.67
    assert (one.on_time_pct, one.avg_delay_days_when_late) == (66.67, 2.0)
    # Never delivered: counts as an order that was not on time.
    assert (got[3].total_orders, got[3].on_time_pct, got[3].avg_actual_lead_time_days) == (1, 0.0, None)
    assert (got[3].lead_time_stddev_days, got[3].avg_delay_days_when_late) == (None, None)


def test_leadtime_single_order_has_zero_deviation(shop):
    got = {(r.store_id, r.sku_id, r.supplier_id): r for r in kpis.store_sku_supplier_leadtime(shop["purchase_orders"]).collect()}
    assert got[2, 4, 2].lead_time_stddev_days == 0.0
    assert got[1, 1, 1].total_orders == 2
    assert (2, 3, 3) not in got


def test_wastage_info(shop):
    log = facts.wastage_log(shop, shop["order_items"])
    row = kpis.wastage_info(log, shop["products"]).filter("sku_id = 1").first()
    assert (row.total_quantity_wasted, row.wastage_pct) == (4, 40.0)
    assert (row.wastage_value_cost, row.wastage_value_mrp_equivalent) == (D("24.00"), D("40.00"))


def test_store_orders_weights_delivery_time_by_item(shop):
    got = {r.store_id: r for r in stores.store_orders(shop).collect()}
    one = got[1]
    assert (one.total_orders, one.cancelled_orders, one.delivered_orders) == (4, 1, 3)
    # Two items at 10 minutes, one at 31, one at 20.
    assert one.avg_delivery_time_mins == 17.8
    assert one.total_revenue == D("90.00")
    assert one.cancellation_rate_pct == 25.0
    assert (got[2].delivered_orders, got[2].avg_delivery_time_mins) == (1, None)


def test_restocks_count_undelivered_as_late(shop):
    got = {r.store_id: r.on_time_restock_pct for r in stores.store_restocks(shop["purchase_orders"]).collect()}
    assert got == {1: 33.33, 2: 66.67}


def naive_line_wastage(po, log):
    """The plain join that repeats rows."""
    w = log.select("batch_id", "sku_id", "quantity_wasted")
    return po.join(w, ["batch_id", "sku_id"], "left")


def test_wastage_repeats_rows_of_shared_batches(shop):
    log = facts.wastage_log(shop, shop["order_items"])
    got = {r.store_id: r for r in stores.store_wastage(shop, log).collect()}
    # Two lines of batch 11 each meet its four wasted units; batch 12 wastes eight: 16 of 20 ordered.
    assert got[1].wastage_pct == 80.0
    assert got[1].wastage_value == D("144.00")


def test_line_wastage_equals_the_plain_join(spark):
    po = spark.range(60).selectExpr(
        "cast(id % 3 AS int) AS store_id", "id % 4 AS batch_id", "cast(id % 2 AS int) AS sku_id", "cast(id AS int) AS quantity_ordered"
    )
    log = spark.range(9).selectExpr("id % 3 AS batch_id", "cast(id % 2 AS int) AS sku_id", "id AS quantity_wasted")
    fast = stores._line_wastage(po, log).groupBy("store_id").agg(F.sum("ordered"), F.sum("wasted")).orderBy("store_id").collect()
    slow = (
        naive_line_wastage(po, log).groupBy("store_id")
        .agg(F.sum("quantity_ordered"), F.coalesce(F.sum("quantity_wasted"), F.lit(0))).orderBy("store_id").collect()
    )
    assert [tuple(r) for r in fast] == [tuple(r) for r in slow]


def test_scorecard_agrees_with_its_parts(shop, movement, snapshot):
    log = facts.wastage_log(shop, shop["order_items"])
    card = {r.store_id: r for r in stores.store_performances(shop, movement, log).collect()}
    assert set(card) == {1, 2}
    velocity = kpis.sales_velocity(snapshot, shop)
    for r in stores.store_velocity(velocity).collect():
        assert card[r.store_id].store_sales_velocity == r.store_sales_velocity
    for r in stores.store_top_category(velocity).collect():
        assert card[r.store_id].top_performing_category == r.top_performing_category
    for r in stores.store_turnover(movement).collect():
        assert card[r.store_id].store_inventory_turnover_ratio == r.store_inventory_turnover_ratio
        assert card[r.store_id].store_days_of_inventory_on_hand == r.store_days_of_inventory_on_hand
    rates = {r.store_id: r.stockout_rate_pct for r in stores.store_stockouts(movement).collect()}
    assert rates == {2: round(100 / 180, 2)}
    # No stock-out at all is a gap, not zero.
    assert card[1].stockout_rate_pct is None


def test_network_is_the_sum_of_the_stores(shop, movement):
    log = facts.wastage_log(shop, shop["order_items"])
    net = stores.network_summary(shop, movement, log).collect()
    assert len(net) == 1
    revenue = stores.store_orders(shop).agg(F.sum("total_revenue")).first()[0]
    assert net[0].total_network_revenue == revenue
    assert net[0].network_stockout_rate_pct == round(100 / (4 * 90), 2)


def test_category_tie_goes_to_the_first_name(spark):
    velocity = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 2), (1, "a", 3), (2, "z", 1)], "store_id int, category string, total_units_sold bigint"
    )
    got = {r.store_id: r.top_performing_category for r in stores.store_top_category(velocity).collect()}
    assert got == {1: "a", 2: "z"}

