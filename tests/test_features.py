"""Feature table, splits, metrics and baselines."""

from datetime import date, timedelta
from statistics import pstdev, stdev

import pytest
from pyspark.sql import functions as F

from shelfflow.operators import facts, features
from shelfflow.operators.features import calendar

START, END = date(2025, 1, 1), date(2025, 2, 9)


@pytest.fixture(scope="module")
def sold(spark):
    rows = [(1, 1, START + timedelta(days=n), (n * 7) % 5) for n in range(0, 40, 3)] + [(2, 3, date(2025, 1, 4), 6)]
    return spark.createDataFrame(rows, "store_id int, sku_id int, snapshot_date date, sold_qty bigint")


def test_base_has_every_pair_on_every_day(shop, sold):
    base = features.forecast_base(shop["dark_stores"], shop["products"], sold, calendar(START, END))
    assert base.count() == 3 * 4 * 40
    assert base.groupBy("store_id", "sku_id", "snapshot_date").count().filter("count > 1").count() == 0
    assert base.agg(F.sum("sold_qty")).first()[0] == sold.agg(F.sum("sold_qty")).first()[0]
    assert base.filter("store_id = 2 AND sku_id = 3 AND snapshot_date = '2025-01-04'").first().sold_qty == 6


def test_sales_outside_the_calendar_do_not_leak_in(shop, sold):
    base = features.forecast_base(shop["dark_stores"], shop["products"], sold, calendar(date(2025, 1, 5), END))
    assert base.filter("store_id = 2").agg(F.sum("sold_qty")).first()[0] == 0


def test_features_against_plain_lists(shop, sold):
    df = features.forecast_features(shop["dark_stores"], shop["products"], sold, calendar(START, END))
    assert df.columns == features.FEATURE_COLUMNS
    rows = df.filter("store_id = 1 AND sku_id = 1").orderBy("snapshot_date").collect()
    qty = [(n * 7) % 5 if n % 3 == 0 else 0 for n in range(40)]
    for n, r in enumerate(rows):
        day = START + timedelta(days=n)
        assert (r.snapshot_date, r.target_sold_qty) == (day, qty[n])
        for lag in (1, 7, 28):
            assert r[f"sales_lag_{lag}"] == (qty[n - lag] if n >= lag else None)
        past = qty[max(0, n - 7) : n]
        assert r.rolling_7day_avg == (pytest.approx(sum(past) / len(past)) if past else None)
        assert r.rolling_7day_stddev == (pytest.approx(pstdev(past)) if past else None)
        assert r.day_of_week == day.isoweekday() % 7 + 1
        assert r.is_weekend == int(day.isoweekday() >= 6)
        assert r.day_of_month == day.day
    assert features.clean_features(df).count() == 3 * 4 * 12


def test_the_grid_unfolds_in_all_tasks(spark, shop, sold):
    df = features.forecast_features(shop["dark_stores"], shop["products"], sold, calendar(START, END))
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_task_holds_a_bounded_number_of_pairs(shop, sold, monkeypatch):
    monkeypatch.setattr(features._tasks, "__defaults__", (2,))
    df = features.forecast_features(shop["dark_stores"], shop["products"], sold, calendar(START, END))
    assert df.rdd.getNumPartitions() == 3 * 4 // 2 and df.count() == 3 * 4 * 40


def test_sample_deviation_more_windows_and_month(shop, sold):
    df = features.forecast_features(
        shop["dark_stores"], shop["products"], sold, calendar(START, END), windows=(7, 14, 30), ddof=1, month=True
    )
    assert df.columns[-5:] == [
        "rolling_14day_avg", "rolling_14day_stddev", "rolling_30day_avg", "rolling_30day_stddev", "month",
    ]
    rows = df.filter("store_id = 1 AND sku_id = 1").orderBy("snapshot_date").collect()
    qty = [r.target_sold_qty for r in rows]
    assert rows[1].rolling_7day_stddev is None
    assert rows[20].rolling_14day_stddev == pytest.approx(stdev(qty[6:20]))
    assert rows[39].month == 2


def test_observed_spine_equals_calendar_when_every_day_is_seen(spark, shop):
    days = [START + timedelta(days=n) for n in range(12)]
    snap = spark.createDataFrame(
        [(1, 1, day, n % 4) for n, day in enumerate(days)], "store_id int, sku_id int, movement_date date, total_quantity_sold bigint"
    )
    sold = features.sold_from_snapshot(snap)
    a = features.forecast_base(shop["dark_stores"], shop["products"], sold, features.observed_dates(snap))
    b = features.forecast_base(shop["dark_stores"], shop["products"], sold, calendar(days[0], days[-1]))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    assert a.count() == 12 * 12


def test_observed_spine_misses_days_without_movement(spark, shop):
    snap = facts.inventory_snapshot(facts.daily_movement(shop))
    base = features.forecast_base(shop["dark_stores"], shop["products"], features.sold_from_snapshot(snap), features.observed_dates(snap))
    assert base.select("snapshot_date").distinct().count() == snap.select("movement_date").distinct().count()


def test_cap_dates(sold):
    capped = features.cap_dates(sold.withColumn("stray", F.lit(1)), date(2025, 1, 10), ["stray"])
    assert capped.columns == sold.columns
    assert capped.agg(F.max("snapshot_date")).first()[0] == date(2025, 1, 10)


def dated(spark, counts):
    return spark.createDataFrame(
        [(START + timedelta(days=n),) for n, c in enumerate(counts) for _ in range(c)], "snapshot_date date"
    )


@pytest.mark.parametrize("counts,q", [([3, 1, 2, 5], 0.68), ([1] * 10, 0.5), ([10], 0.68), ([2, 2], 0.5), ([1, 1, 1, 1, 1, 1], 0.1)])
def test_quantile_date_is_the_nearest_row(spark, counts, q):
    df = dated(spark, counts)
    rows = sorted(r[0] for r in df.collect())
    want = rows[round(q * (len(rows) - 1))]
    assert features.quantile_date(df, q).first()[0] == want
    train, test = features.split_by_quantile(df, q)
    assert train.count() == sum(r <= want for r in rows)
    assert train.count() + test.count() == len(rows)


def test_split_by_date_and_summary(spark):
    train, test = features.split_by_date(dated(spark, [1, 2, 3]), date(2025, 1, 2))
    got = {r.part: (r.rows, r.days, r.first_date, r.last_date) for r in features.split_summary(train, test).collect()}
    assert got == {"train": (1, 1, START, START), "test": (5, 2, date(2025, 1, 2), date(2025, 1, 3))}


def scored(spark, rows):
    return spark.createDataFrame(
        rows, "target_sold_qty bigint, predicted_demand double, sales_lag_1 bigint, sales_lag_7 bigint, rolling_7day_avg double"
    )


def test_metrics_and_baselines(spark):
    df = scored(spark, [(4, 3.0, None, 2, 2.5), (0, 1.0, 4, 0, 1.5), (2, 2.0, 0, 7, None)])
    row = features.forecast_metrics(df).first()
    assert (row.rows, row.mae) == (3, pytest.approx(2 / 3))
    assert row.mape_nonzero_pct == pytest.approx(12.5)
    naive = features.naive_baselines(df).first()
    assert naive.naive_zero_mae == 2.0
    assert naive.naive_lag_1_mae == pytest.approx((4 + 4 + 2) / 3)
    assert naive.naive_lag_7_mae == pytest.approx((2 + 0 + 5) / 3)
    assert naive.naive_rolling_mae == pytest.approx((1.5 + 1.5 + 2) / 3)
    gain = features.baseline_improvement(df).first()
    assert gain.best_naive_mae == pytest.approx(5 / 3)
    assert gain.improvement_pct == pytest.approx(60.0)


def test_mape_without_sales_is_null(spark):
    row = features.forecast_metrics(scored(spark, [(0, 1.0, 0, 0, 0.0)])).first()
    assert (row.mae, row.mape_nonzero_pct) == (1.0, None)


def test_target_distribution(spark):
    df = spark.createDataFrame([(v,) for v in [0, 0, 0, 0, 1, 1, 2, 3]], "target_sold_qty int")
    got = [(r.target_sold_qty, r.rows, r.share, r.zero_pct) for r in features.target_distribution(df, 3).collect()]
    assert got == [(0, 4, 0.5, 50.0), (1, 2, 0.25, 50.0), (2, 1, 0.125, 50.0)]
