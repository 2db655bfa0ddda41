"""KPI views per SKU, supplier and store day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfflow.functions.numeric import cents, deviation, half_up, quotient, rounded_ratio
from shelfflow.functions.ordering import running_before, tile
from shelfflow.operators.facts import CELL, Tables, running, with_names
from shelfflow.schemas import Params
from shelfflow.sources.staging import stage


def abc_classification(sales: DataFrame, p: Params = Params()) -> DataFrame:
    """Class A, B or C of each SKU by its place in the cumulative revenue.

    SKUs of equal revenue share one cumulative value, so the running totals run over the distinct
    revenues, range by range, and come back to the SKUs by an equi-join.
    """
    skus = stage(
        sales.groupBy("sku_id", "sku_name")
        .agg(F.sum("total_revenue").alias("total_revenue"))
        .withColumn("revenue_cents", cents(F.col("total_revenue")).cast("long"))
    )
    steps = skus.groupBy("revenue_cents").agg(
        F.count("sku_id").alias("skus"),
        (F.col("revenue_cents").cast("decimal(38,0)") * F.count("sku_id")).alias("revenue"),
    )
    steps = running_before(steps, [("revenue_cents", True)], ["skus", "revenue"])
    revenue_total, sku_total = F.col("revenue_total"), F.col("skus_total")
    share = rounded_ratio((F.col("revenue_before") + F.col("revenue")) * 100, revenue_total, 2)
    steps = steps.select(
        "revenue_cents",
        rounded_ratio(F.col("revenue_cents") * F.lit(100).cast("decimal(3,0)"), revenue_total, 2).alias(
            "sku_revenue_pct"
        ),
        share.alias("cumulative_revenue_pct"),
        rounded_ratio(F.lit(100), sku_total, 4).alias("sku_pct"),
        rounded_ratio((F.col("skus_before") + F.col("skus")) * 100, sku_total, 4).alias("cumulative_sku_pct"),
        F.when(share <= p.abc_a, "A").when(share <= p.abc_b, "B").otherwise("C").alias("abc_class"),
    )
    return skus.join(steps, "revenue_cents").drop("revenue_cents")


def in_period(p: Params) -> Column:
    return F.col("movement_date").between(F.lit(p.start), F.lit(p.end))


def available_day() -> Column:
    return F.when(F.col("opening_stock") + F.col("total_quantity_purchased") > 0, 1).otherwise(0)


def sales_velocity(snapshot: DataFrame, t: Tables, p: Params = Params(), scale: int | None = None) -> DataFrame:
    """Units sold per day and per available day, and the speed class within the store.

    ``scale`` rounds the velocities as a decimal database would (4 digits); by default they stay
    doubles. Ties in the decile order go to the smaller ``sku_id``.
    """
    skus = (
        snapshot.filter(in_period(p))
        .groupBy(*CELL)
        .agg(
            F.sum("total_quantity_sold").alias("total_units_sold"),
            F.sum(available_day()).alias("days_available"),
        )
        .withColumn("rows", F.lit(1).cast("long"))
    )
    ranked = running_before(skus, [("total_units_sold", True), ("sku_id", False)], ["rows"], ["store_id"])
    decile = tile(F.col("rows_before") + 1, F.col("rows_total"), 10)

    def per_day(days: Column) -> Column:
        if scale is None:
            return quotient(F.col("total_units_sold"), days)
        return rounded_ratio(F.col("total_units_sold"), days, scale)

    return with_names(ranked, t, "category").select(
        "store_id",
        "store_name",
        "sku_id",
        "sku_name",
        "category",
        "total_units_sold",
        "days_available",
        per_day(F.lit(p.period_days)).alias("sales_velocity"),
        per_day(F.col("days_available")).alias("adjusted_velocity_days_available"),
        F.when(decile <= 3, "Fast-moving")
        .when(decile <= 7, "Medium-moving")
        .otherwise("Slow-moving")
        .alias("classification"),
    )


def wastage_info(log: DataFrame, products: DataFrame) -> DataFrame:
    """Wastage per store and SKU in units, percent, cost and list price."""
    cells = log.groupBy("store_id", "store_name", "sku_id", "sku_name").agg(
        F.sum("quantity_purchased").alias("total_quantity_purchased"),
        F.sum("quantity_sold").alias("total_quantity_sold"),
        F.sum("quantity_wasted").alias("total_quantity_wasted"),
    )
    wasted = F.col("total_quantity_wasted")
    return (
        cells.join(products.select("sku_id", "category", "unit_cost", "mrp"), "sku_id")
        .withColumns(
            {
                "wastage_pct": rounded_ratio(wasted * 100, F.col("total_quantity_purchased"), 2),
                "wastage_value_cost": (wasted * F.col("unit_cost")).cast("decimal(27,2)"),
                "wastage_value_mrp_equivalent": (wasted * F.col("mrp")).cast("decimal(27,2)"),
            }
        )
        .drop("mrp")
    )


def turnover_columns(sold: Column, stock: Column, days: Column, p: Params) -> tuple[Column, Column]:
    """Turnover ratio and days on hand from units sold, summed opening + closing, and row count.

    The average stock is ``stock / (2 * days)``; both ratios are formed from whole numbers.
    """
    ratio = rounded_ratio(sold * days * 2, stock, 2)
    on_hand = rounded_ratio(stock * p.period_days, sold * days * 2, 1)
    return ratio, F.when(stock != 0, on_hand)


def inventory_turnover(snapshot: DataFrame, p: Params = Params()) -> DataFrame:
    """Units sold over average stock per store and SKU, and the days the stock lasts."""
    cells = (
        snapshot.filter(in_period(p))
        .groupBy("store_id", "store_name", "sku_id", "sku_name")
        .agg(
            F.sum("total_quantity_sold").alias("total_units_sold"),
            F.sum(F.col("opening_stock") + F.col("closing_stock")).alias("stock"),
            F.count(F.lit(1)).alias("days"),
        )
    )
    ratio, on_hand = turnover_columns(F.col("total_units_sold"), F.col("stock"), F.col("days"), p)
    return cells.select(
        "store_id",
        "store_name",
        "sku_id",
        "sku_name",
        "total_units_sold",
        quotient(F.col("stock"), F.col("days") * 2).alias("avg_inventory"),
        ratio.alias("inventory_turnover_ratio"),
        on_hand.alias("days_of_inventory_on_hand"),
    )


def stock_out_incidents(movement: DataFrame, require_demand: bool = False) -> DataFrame:
    """Movement days that end with no stock; ``require_demand`` keeps those with a sale only."""
    out = F.col("closing_stock") <= 0
    if require_demand:
        out &= F.col("total_quantity_sold") > 0
    return (
        movement.withColumns(
            {
                "cumulative_purchased": running("total_quantity_purchased"),
                "cumulative_sold": running("total_quantity_sold"),
            }
        )
        .withColumn("closing_stock", F.col("cumulative_purchased") - F.col("cumulative_sold"))
        .filter(out)
        .select(
            "store_id",
            "store_name",
            "sku_id",
            "sku_name",
            F.col("movement_date").alias("stock_out_date"),
            "cumulative_purchased",
            "cumulative_sold",
            "closing_stock",
        )
    )


def store_movement(movement: DataFrame, products: DataFrame, p: Params = Params()) -> DataFrame:
    """Value sold, bought and held per store and day, with a flag for any SKU at zero.

    Stock counts from ``p.start`` on. It is the running sum of the same rows, so no join with the
    snapshot is needed.
    """
    net = F.col("total_quantity_purchased") - F.col("total_quantity_sold")
    stock = F.when(F.col("movement_date") >= F.lit(p.start), F.col("closing_stock"))
    return (
        movement.withColumn("closing_stock", running(net))
        .withColumn("closing_stock", stock)
        .join(products.select("sku_id", "unit_cost"), "sku_id")
        .groupBy("store_id", "store_name", "movement_date")
        .agg(
            F.sum("total_sold_value").alias("sales_value"),
            F.sum("total_purchased_value").alias("purchase_value"),
            F.sum(F.coalesce("closing_stock", F.lit(0)) * F.col("unit_cost"))
            .cast("decimal(38,2)")
            .alias("inventory_value"),
            F.max(F.when(F.col("closing_stock") == 0, 1).otherwise(0)).alias("stockout_flag"),
        )
    )


def on_time() -> Column:
    """1 when delivered by the expected date, else 0 (also while undelivered)."""
    return F.when(F.col("actual_delivery_date") <= F.col("expected_delivery_date"), 1).otherwise(0)


def supplier_reliability(po: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Promised and actual lead time, punctuality and delay per supplier."""
    promised = F.datediff("expected_delivery_date", "order_date").cast("long")
    actual = F.datediff("actual_delivery_date", "order_date").cast("long")
    late = F.when(
        F.col("actual_delivery_date") > F.col("expected_delivery_date"),
        F.datediff("actual_delivery_date", "expected_delivery_date").cast("long"),
    )
    sums = po.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum(promised).alias("promised"),
        F.count(promised).alias("n_promised"),
        F.sum(actual).alias("actual"),
        F.sum(actual * actual).alias("actual_sq"),
        F.count(actual).alias("n_actual"),
        F.sum(on_time()).alias("on_time"),
        F.sum(late).alias("late"),
        F.count(late).alias("n_late"),
    )
    c = F.col
    return sums.join(suppliers.select("supplier_id", "supplier_name"), "supplier_id").select(
        "supplier_id",
        "supplier_name",
        "total_orders",
        rounded_ratio(c("promised"), c("n_promised"), 2).alias("avg_promised_lead_time_days"),
        rounded_ratio(c("actual"), c("n_actual"), 2).alias("avg_actual_lead_time_days"),
        half_up(deviation(c("n_actual"), c("actual"), c("actual_sq")), 2).alias("lead_time_stddev_days"),
        rounded_ratio(
            c("actual") * c("n_promised") - c("promised") * c("n_actual"), c("n_actual") * c("n_promised"), 2
        ).alias("avg_lead_time_deviation_days"),
        rounded_ratio(c("on_time") * 100, c("total_orders"), 2).alias("on_time_pct"),
        rounded_ratio(c("late"), c("n_late"), 2).alias("avg_delay_days_when_late"),
    )


def store_sku_supplier_leadtime(po: DataFrame) -> DataFrame:
    """Mean and population deviation of the lead time per store, SKU and supplier."""
    lead = F.datediff("actual_delivery_date", "order_date").cast("long")
    return (
        po.filter(F.col("actual_delivery_date").isNotNull())
        .groupBy(*CELL, "supplier_id")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            F.count(lead).alias("n"),
            F.sum(lead).alias("days"),
            F.sum(lead * lead).alias("squares"),
        )
        .select(
            *CELL,
            "supplier_id",
            "total_orders",
            quotient(F.col("days"), F.col("n")).alias("avg_lead_time_days"),
            deviation(F.col("n"), F.col("days"), F.col("squares")).alias("lead_time_stddev_days"),
        )
    )
