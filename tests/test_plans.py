"""The whole build, the demand model, and the plans of the main operators."""

import math
from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfflow.operators import facts, features, fifo, kpis, reorder, stores
from shelfflow.plans import boosting, demand, warehouse
from shelfflow.sources.files import write_fact


@pytest.fixture(scope="module")
def tables(spark):
    from shelfflow.sources.benchmark_tables import load_tables

    return load_tables(spark, "/root/testdata/sf0.001")


def test_publish_registers_everything(shop, spark, frame, tmp_path):
    row = {"store_id": 1, "sku_id": 1, "snapshot_date": date(2025, 3, 1), "target_sold_qty": 1, "predicted_demand": Decimal(2)}
    forecast = frame("fact_ml_forecasts", [row])
    t = warehouse.allocate_batches(shop.replaced(fact_ml_forecasts=forecast))
    views = warehouse.publish(t, folder=str(tmp_path))
    for name in views:
        # Five observed days are too few for a 28-day history.
        assert (spark.table(name).count() == 0) == (name == "view_forecast_features_clean"), name
    in_memory = warehouse.build_views(t, warehouse.build_facts(t))
    for name in ("view_store_performances", "view_wastage_info", "view_sales_velocity"):
        assert sorted(map(repr, spark.table(name).collect())) == sorted(map(repr, in_memory[name].collect()))
    assert spark.sql("SELECT count(*) FROM orders").first()[0] == 6


def test_from_tables_to_reorder_points(tables, spark, tmp_path):
    """The flow of the README on benchmark tables, with a small model."""
    t = warehouse.allocate_batches(tables)
    views = warehouse.publish(t, folder=str(tmp_path / "facts"))
    clean = features.cap_dates(views["view_forecast_features_clean"], date(2025, 3, 31))
    m = demand.ModelParams(max_iter=2, max_depth=3, max_bins=32)
    forecasts = write_fact(demand.demand_forecasts(clean, m=m), str(tmp_path / "forecasts"), ["snapshot_date"])
    points = reorder.reorder_points(
        forecasts, views["view_sales_velocity"], views["view_store_sku_supplier_leadtime"]
    )
    assert points.count() == clean.filter("snapshot_date >= '2025-03-01'").count() > 0
    assert points.filter("reorder_point < safety_stock").count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_allocated_items_are_read_and_not_allocated_again(shop):
    t = warehouse.allocate_batches(shop)
    for df in (facts.daily_sales(t), facts.daily_movement(t), stores.store_orders(t)):
        assert "Window" not in plan_of(df)


def test_scans_read_only_needed_columns(tables):
    plan = plan_of(facts.daily_movement(tables))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans and all("l_tax" not in s and "l_extendedprice" not in s for s in scans)
    assert all("EqualTo(l_linestatus" in s for s in scans)


@pytest.mark.parametrize("name", ["velocity", "abc", "fifo", "features", "stock_outs"])
def test_no_cross_product_and_no_python_in_the_plans(tables, name):
    movement = facts.daily_movement(tables)
    df = {
        "velocity": lambda: kpis.sales_velocity(facts.inventory_snapshot(movement), tables),
        "abc": lambda: kpis.abc_classification(facts.daily_sales(tables)),
        "fifo": lambda: fifo.fifo_allocate(tables["order_items"], tables["orders"], tables["purchase_orders"], tables["products"]),
        "features": lambda: features.forecast_features(
            tables["dark_stores"], tables["products"], features.daily_sold(tables), features.calendar(date(2025, 1, 1), date(2025, 3, 31))
        ),
        "stock_outs": lambda: kpis.stock_out_incidents(movement),
    }[name]()
    plan = plan_of(df)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in plan


def test_stock_outs_sort_once(tables):
    plan = plan_of(kpis.stock_out_incidents(facts.daily_movement(tables)))
    assert plan.count("Window [") == 1


def clean_rows(spark, days=40, skus=12):
    """A learnable pattern: demand depends on SKU and weekday."""
    rows = []
    for k in range(skus):
        for n in range(days):
            day = date(2025, 1, 10) + timedelta(days=n)
            y = (k % 4) * (3 if day.isoweekday() >= 6 else 1)
            rows.append((1, k, day, day.isoweekday() % 7 + 1, int(day.isoweekday() >= 6), day.day, y, y, y, float(y), None if n == 0 else 0.5,
                         "ab"[k % 2], "z", 10, 1.0, 2.0, y))
    schema = (
        "store_id int, sku_id int, snapshot_date date, day_of_week int, is_weekend int, day_of_month int, sales_lag_1 bigint, "
        "sales_lag_7 bigint, sales_lag_28 bigint, rolling_7day_avg double, rolling_7day_stddev double, category string, zone string, "
        "capacity_units int, unit_cost double, mrp double, target_sold_qty bigint"
    )
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("objective", ["tweedie", "squared"])
def test_model_beats_the_mean_and_is_not_negative(spark, objective):
    clean = clean_rows(spark)
    train, test = features.split_by_date(clean, date(2025, 2, 10))
    m = demand.ModelParams(objective=objective, variance_power=1.5, max_iter=12, max_depth=4, step_size=0.3, max_bins=32)
    out = demand.predict_demand(demand.fit_demand_model(train, m), test)
    assert out.columns == ["store_id", "sku_id", "snapshot_date", "target_sold_qty", "predicted_demand"]
    assert out.count() == test.count()
    assert out.filter("predicted_demand < 0").count() == 0
    mae = features.forecast_metrics(out).first().mae
    mean = train.agg(F.avg("target_sold_qty")).first()[0]
    naive = test.agg(F.avg(F.abs(F.col("target_sold_qty") - mean))).first()[0]
    assert mae < 0.6 * naive


@pytest.mark.parametrize("name", ["demand_model", "forecasts", "reorder_points_model"])
def test_registered_models_may_grow_all_rounds(tables, monkeypatch, name):
    """The full model's rounds, depth and patience, on every row before the split."""
    import __spark_entry__ as entry_points

    class Asked(Exception):
        pass

    def asked(train, m):
        raise Asked(m)

    monkeypatch.setattr(demand, "stage", lambda df: df)
    monkeypatch.setattr(demand, "fit_demand_model", asked)
    with pytest.raises(Asked) as found:
        entry_points.ON_TABLES[name](tables)
    power = 1.5 if name == "demand_model" else 1.9
    assert found.value.args[0] == demand.ModelParams("tweedie", power, 300, 6, 0.05, 20)


def test_unseen_category_can_be_scored(spark):
    clean = clean_rows(spark, days=20, skus=4)
    m = demand.ModelParams(max_iter=2, max_depth=2, max_bins=32)
    model = demand.fit_demand_model(clean, m)
    assert demand.predict_demand(model, clean.withColumn("category", F.lit("new"))).count() == 80


def test_report(spark):
    m = demand.ModelParams(max_iter=2, max_depth=2, max_bins=32, variance_power=1.5)
    row = demand.model_report(clean_rows(spark), m=m).collect()
    assert len(row) == 1
    assert row[0].best_naive_mae == 0.0 and row[0].improvement_pct is None and row[0].mae > 0


def test_best_round_waits_for_patience():
    assert demand._best_round([5, 4, 4.5, 4.4, 3.0], patience=2) == 2
    assert demand._best_round([5, 4, 4.5, 4.4, 3.0], patience=3) == 5
    assert demand._best_round([5], patience=3) == 1


def test_gradient_matches_the_deviance():
    power, eps = 1.5, 1e-5
    g, h = boosting.gradients(np.array([3.0]), np.array([0.7]), power)

    def loss(s):
        return -3 * math.exp((1 - power) * s) / (1 - power) + math.exp((2 - power) * s) / (2 - power)

    assert g[0] == pytest.approx((loss(0.7 + eps) - loss(0.7 - eps)) / (2 * eps), rel=1e-5)
    assert h[0] == pytest.approx((loss(0.7 + eps) - 2 * loss(0.7) + loss(0.7 - eps)) / eps**2, rel=1e-3)

