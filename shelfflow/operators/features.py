"""Demand-forecast features, splits, metrics and baselines."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfflow.functions.numeric import deviation, quotient, rounded_ratio
from shelfflow.operators.facts import CELL, Tables, delivered_items
from shelfflow.operators.prep import store_sku_pairs
from shelfflow.schemas import Params

LAGS = (1, 7, 28)
# So that what a task sorts or keeps of the unfolded rows does not grow with the tables.
PAIRS_PER_TASK = 10_000
TARGET = "target_sold_qty"
FEATURE_COLUMNS = [
    "store_id",
    "sku_id",
    "snapshot_date",
    "day_of_week",
    "is_weekend",
    "day_of_month",
    "sales_lag_1",
    "sales_lag_7",
    "sales_lag_28",
    "rolling_7day_avg",
    "rolling_7day_stddev",
    "category",
    "zone",
    "capacity_units",
    "unit_cost",
    "mrp",
    "target_sold_qty",
]
STORE_STATICS = ["zone", "capacity_units"]
SKU_STATICS = ["category", "unit_cost", "mrp"]


def daily_sold(t: Tables) -> DataFrame:
    """Units of delivered items per store, SKU and day."""
    return (
        delivered_items(t)
        .groupBy(*CELL, F.col("order_date").alias("snapshot_date"))
        .agg(F.sum("quantity").alias("sold_qty"))
    )


def sold_from_snapshot(snapshot: DataFrame) -> DataFrame:
    """The same, read off the inventory snapshot."""
    return snapshot.select(
        *CELL, F.col("movement_date").alias("snapshot_date"), F.col("total_quantity_sold").alias("sold_qty")
    )


def calendar(start: date, end: date) -> Column:
    """Every day from ``start`` to ``end`` as an array."""
    return F.sequence(F.lit(start), F.lit(end))


def observed_dates(snapshot: DataFrame, p: Params = Params()) -> Column:
    """The distinct movement days from ``p.start`` on, as an array (one entry per calendar day)."""
    days = snapshot.filter(F.col("movement_date") >= F.lit(p.start))
    return days.agg(F.sort_array(F.collect_set("movement_date"))).scalar()


def date_spine(spark, start: date, end: date) -> DataFrame:
    """One row per calendar day."""
    return spark.range(1).select(F.explode(calendar(start, end)).alias("snapshot_date"))


def _aligned(listed: Column, days: Column) -> Column:
    """Quantities by place in the calendar as one array with an entry for every day, 0 where nothing is listed.

    Each entry brings the zeros since the one before it, so the array is built in one pass.
    """
    places = F.transform(listed, lambda x: x["_place"])
    before = F.slice(F.concat(F.array(F.lit(0).cast("long")), places), 1, F.size(listed))
    none = F.lit(0).cast("long")

    def with_gap(x: Column, last: Column) -> Column:
        return F.concat(F.array_repeat(none, (x["_place"] - last - 1).cast("int")), F.array(x["sold_qty"].cast("long")))

    rest = F.array_repeat(none, (days - F.coalesce(F.array_max(places), F.lit(0))).cast("int"))
    return F.concat(F.flatten(F.zip_with(listed, before, with_gap)), rest)


def _tasks(stores: DataFrame, products: DataFrame, per_task: int = PAIRS_PER_TASK) -> int:
    """Tasks for all pairs: the session's shuffle partitions, or more where these would hold more than ``per_task`` pairs each."""
    pairs = stores.count() * products.count()
    return max(int(products.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(pairs / per_task))


def _pairs_with_sales(
    stores: DataFrame, products: DataFrame, sold: DataFrame, days: Column, sku_columns: Sequence[str], store_columns: Sequence[str]
) -> DataFrame:
    """Every store and SKU with the calendar ``_days`` and the units sold on each of its days, ``_sold``."""
    place = F.array_position(days, F.col("snapshot_date"))
    on_calendar = sold.withColumn("_place", place).filter(F.col("_place") > 0)
    listed = F.sort_array(F.collect_list(F.struct("_place", "sold_qty")))
    # A pair is a few bytes and unfolds to a row per day: dealt out by number, since partitions of few bytes would be merged into few tasks.
    # Both sides are, or the join would take the number of the other.
    tasks = _tasks(stores, products)
    by_pair = on_calendar.repartition(tasks, *CELL).groupBy(*CELL).agg(_aligned(listed, F.size(days)).alias("_sold"))
    pairs = store_sku_pairs(stores.select(*store_columns), products.select(*sku_columns)).repartition(tasks, *CELL)
    return pairs.join(by_pair, CELL, "left").withColumns(
        {"_days": days, "_sold": F.coalesce("_sold", F.array_repeat(F.lit(0).cast("long"), F.size(days)))}
    )


def forecast_base(stores: DataFrame, products: DataFrame, sold: DataFrame, days: Column) -> DataFrame:
    """Units sold for every store, SKU and day of ``days``, 0 where nothing sold.

    The sales of a store and SKU on those days travel as one array of the calendar's days, join the pair
    once, and the days unfold beside it. Only pairs are shuffled, not the far larger grid.
    """
    pairs = _pairs_with_sales(stores, products, sold, days, ["sku_id"], ["store_id"])
    return pairs.select("sku_id", "store_id", F.inline(F.arrays_zip("_days", "_sold")).alias("snapshot_date", "sold_qty"))


def calendar_features(df: DataFrame, month: bool = False) -> DataFrame:
    """Day of week (1 = Sunday), weekend flag, day of month; on request the month."""
    day = F.dayofweek("snapshot_date")
    columns = {
        "day_of_week": day,
        "is_weekend": F.when(day.isin(1, 7), 1).otherwise(0),
        "day_of_month": F.dayofmonth("snapshot_date"),
    }
    if month:
        columns["month"] = F.month("snapshot_date")
    return df.withColumns(columns)


def lag_features(df: DataFrame, lags: Sequence[int] = LAGS) -> DataFrame:
    """Units sold some days ago; the base has no gaps, so rows are days."""
    order = Window.partitionBy(*CELL).orderBy("snapshot_date")
    return df.withColumns({f"sales_lag_{n}": F.lag("sold_qty", n).over(order) for n in lags})


def rolling_features(df: DataFrame, windows: Sequence[int] = (7,), ddof: int = 0) -> DataFrame:
    """Mean and deviation of the days before the current one (``ddof=1`` for the sample value)."""
    order = Window.partitionBy(*CELL).orderBy("snapshot_date")
    qty = F.col("sold_qty").cast("long")
    columns = {}
    for days in windows:
        past = order.rowsBetween(-days, -1)
        n, total, squares = F.count(qty).over(past), F.sum(qty).over(past), F.sum(qty * qty).over(past)
        columns[f"rolling_{days}day_avg"] = quotient(total, n)
        columns[f"rolling_{days}day_stddev"] = deviation(n, total, squares, ddof)
    return df.withColumns(columns)


def _sold_before(n: int) -> Column:
    """Units sold ``n`` days before the day at ``_place``; NULL before the calendar begins."""
    return F.get("_sold", F.col("_place") - n)


def _sums_before(days: int) -> dict[str, Column]:
    """Number, sum and sum of squares of the ``days`` days before the day at ``_place``, as far as the calendar has them."""
    units = [F.coalesce(_sold_before(n), F.lit(0).cast("long")) for n in range(1, days + 1)]
    return {
        f"_n_{days}": F.least(F.col("_place"), F.lit(days)).cast("long"),
        f"_total_{days}": reduce(Column.__add__, units),
        f"_squares_{days}": reduce(Column.__add__, [u * u for u in units]),
    }


def _rolling_before(days: int, ddof: int) -> tuple[Column, Column]:
    """Mean and deviation of the days before, from ``_sums_before``."""
    n, total, squares = (F.col(f"_{c}_{days}") for c in ("n", "total", "squares"))
    return quotient(total, F.nullif(n, F.lit(0).cast("long"))), deviation(n, total, squares, ddof)


def forecast_features(
    stores: DataFrame,
    products: DataFrame,
    sold: DataFrame,
    days: Column,
    windows: Sequence[int] = (7,),
    ddof: int = 0,
    month: bool = False,
) -> DataFrame:
    """The full feature table: calendar, lags, rolling values, static attributes, target.

    Lags and rolling values are read off the array of the pair's days while it unfolds, so the grid is neither sorted nor moved.
    """
    statics = (["sku_id", *SKU_STATICS], ["store_id", *STORE_STATICS])
    pairs = _pairs_with_sales(stores, products, sold, days, *statics)
    places = pairs.select(*statics[0], *statics[1], "_sold", F.posexplode("_days").alias("_place", "snapshot_date"))
    columns = {}
    for n in windows:
        columns[f"rolling_{n}day_avg"], columns[f"rolling_{n}day_stddev"] = _rolling_before(n, ddof)
    # Sums are columns of their own, computed once a row: written out in every term they make a method too long to be compiled.
    sums = {name: c for n in windows for name, c in _sums_before(n).items()}
    lags = {f"sales_lag_{n}": _sold_before(n) for n in LAGS}
    df = calendar_features(places.withColumns(sums | lags | {TARGET: _sold_before(0)}), month).withColumns(columns)
    extra = [f"rolling_{d}day_{s}" for d in windows if d != 7 for s in ("avg", "stddev")] + (["month"] if month else [])
    return df.select(*[c for c in FEATURE_COLUMNS if c in df.columns], *extra)


def clean_features(features: DataFrame) -> DataFrame:
    """Rows with a full 28-day history."""
    return features.filter(F.col("sales_lag_28").isNotNull() & F.col("rolling_7day_avg").isNotNull())


def cap_dates(df: DataFrame, end: date, stray: Sequence[str] = ()) -> DataFrame:
    """Without the stray columns and without days after ``end``."""
    return df.drop(*stray).filter(F.col("snapshot_date") <= F.lit(end))


def split_by_date(df: DataFrame, day: date) -> tuple[DataFrame, DataFrame]:
    """Rows before ``day`` and rows from it on."""
    d = F.col("snapshot_date")
    return df.filter(d < F.lit(day)), df.filter(d >= F.lit(day))


def quantile_date(df: DataFrame, q: float) -> DataFrame:
    """The date at row number ``round(q * (n - 1))`` of the rows in date order, as ``split_date``.

    Rows are counted per date; only the dates are ordered.
    """
    per_day = df.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("rows"))
    order = Window.orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, 0)
    through = per_day.withColumn("through", F.sum("rows").over(order)).withColumn(
        "n", F.sum("rows").over(Window.partitionBy())
    )
    index = F.rint(F.lit(q) * (F.col("n") - 1))
    return through.filter(F.col("through") > index).agg(F.min("snapshot_date").alias("split_date"))


def split_by_quantile(df: DataFrame, q: float) -> tuple[DataFrame, DataFrame]:
    """Rows up to the quantile date and rows after it."""
    split = quantile_date(df, q).scalar()
    return df.filter(F.col("snapshot_date") <= split), df.filter(F.col("snapshot_date") > split)


def split_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows, days, first and last day of both parts."""

    def part(name: str, df: DataFrame) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("snapshot_date").alias("days"),
            F.min("snapshot_date").alias("first_date"),
            F.max("snapshot_date").alias("last_date"),
        ).select(F.lit(name).alias("part"), "*")

    return part("train", train).unionByName(part("test", test))


def mean_error(actual: Column, predicted: Column) -> Column:
    """Mean absolute error as an aggregate; the terms add up as decimals, in any order alike."""
    gap = F.abs(actual - predicted).cast("decimal(28,10)")
    return quotient(F.sum(gap), F.count(gap))


# Baseline name -> the feature it repeats; the constant 0 has none.
BASELINES = {"zero": None, "lag_1": "sales_lag_1", "lag_7": "sales_lag_7", "rolling": "rolling_7day_avg"}


def _model_errors(predicted: str) -> dict[str, Column]:
    y, p = F.col(TARGET), F.col(predicted)
    share = F.when(y > 0, F.abs(y - p).cast("double") / y).cast("decimal(28,12)")
    return {
        "rows": F.count(F.lit(1)),
        "mae": mean_error(y, p),
        "mape_nonzero_pct": quotient(F.sum(share), F.count(share)) * 100,
    }


def _naive_errors() -> dict[str, Column]:
    def guess(feature: str | None) -> Column:
        return F.coalesce(F.col(feature), F.lit(0)) if feature else F.lit(0)

    return {f"naive_{name}_mae": mean_error(F.col(TARGET), guess(c)) for name, c in BASELINES.items()}


def _aggregated(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.agg(*[c.alias(name) for name, c in columns.items()])


def _with_gain(errors: DataFrame) -> DataFrame:
    best = F.col("best_naive_mae")
    return errors.withColumn("best_naive_mae", F.least(*[f"naive_{name}_mae" for name in BASELINES])).withColumn(
        "improvement_pct", quotient(best - F.col("mae"), best) * 100
    )


def forecast_metrics(forecasts: DataFrame, predicted: str = "predicted_demand") -> DataFrame:
    """MAE over all rows and MAPE in percent over rows with sales (NULL without any)."""
    return _aggregated(forecasts, _model_errors(predicted))


def naive_baselines(test: DataFrame) -> DataFrame:
    """MAE of four naive forecasts in one pass; missing history counts as 0."""
    return _aggregated(test, _naive_errors())


def baseline_improvement(test: DataFrame, predicted: str = "predicted_demand") -> DataFrame:
    """Model MAE, best naive MAE and the gain over it in percent; ``test`` holds the prediction too."""
    return forecast_report(test, predicted).select(F.col("mae").alias("model_mae"), "best_naive_mae", "improvement_pct")


def forecast_report(test: DataFrame, predicted: str = "predicted_demand") -> DataFrame:
    """Model errors, naive errors and the gain over the best of them, in one pass over the rows."""
    return _with_gain(_aggregated(test, _model_errors(predicted) | _naive_errors()))


def target_distribution(test: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent target values with their share, and the share of zeros."""
    counts = test.groupBy("target_sold_qty").agg(F.count(F.lit(1)).alias("rows"))
    totals = counts.agg(
        F.struct(
            F.sum("rows").alias("n"),
            F.coalesce(F.sum(F.when(F.col("target_sold_qty") == 0, F.col("rows"))), F.lit(0)).alias("zeros"),
        )
    ).scalar()
    return (
        counts.orderBy(F.col("rows").desc(), "target_sold_qty")
        .limit(k)
        .withColumn("_t", totals)
        .select(
            "target_sold_qty",
            "rows",
            quotient(F.col("rows"), F.col("_t.n")).alias("share"),
            rounded_ratio(F.col("_t.zeros") * 100, F.col("_t.n"), 1).alias("zero_pct"),
        )
    )
