"""Fact tables: daily sales, daily movement, running stock and the wastage log.

Dimensions join after aggregation, on one row per cell. No join carries a broadcast hint: the
session's size threshold, checked on file statistics and again at run time, decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfflow.functions.dealing import dealt_by_key
from shelfflow.schemas import Params
from shelfflow.sources.tables import LazyTables as Tables

CELL = ["store_id", "sku_id"]


def delivered_items(t: Tables, items: DataFrame | None = None) -> DataFrame:
    """Items of delivered orders with the store and date of their order."""
    orders = t["orders"].filter(F.col("order_status") == "delivered").select("order_id", "store_id", "order_date")
    return (t["order_items"] if items is None else items).join(orders, "order_id")


def with_names(df: DataFrame, t: Tables, *sku_columns: str) -> DataFrame:
    """Inner join of store names and SKU attributes: rows of unknown stores or SKUs drop out."""
    stores = t["dark_stores"].select("store_id", "store_name")
    products = t["products"].select("sku_id", "sku_name", *sku_columns)
    return df.join(stores, "store_id").join(products, "sku_id")


def daily_sales(t: Tables) -> DataFrame:
    """Units, revenue and profit per store, day and SKU of delivered orders.

    Unit cost belongs to the SKU, so profit is revenue less cost times units of the cell, and the
    products join one row per cell instead of one per item.
    """
    cells = (
        delivered_items(t)
        .groupBy("store_id", "order_date", "sku_id")
        .agg(
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum(F.col("quantity") * F.col("unit_price_at_sale")).cast("decimal(27,2)").alias("total_revenue"),
        )
    )
    return with_names(cells, t, "category", "unit_cost").select(
        "store_id",
        "store_name",
        "order_date",
        "sku_id",
        "sku_name",
        "category",
        "total_quantity_sold",
        "total_revenue",
        (F.col("total_revenue") - F.col("unit_cost") * F.col("total_quantity_sold"))
        .cast("decimal(27,2)")
        .alias("total_profit"),
    )


def _sales_side(t: Tables) -> DataFrame:
    return delivered_items(t).select(
        "store_id",
        "sku_id",
        F.col("order_date").alias("movement_date"),
        F.col("quantity").cast("long").alias("sold"),
        (F.col("quantity") * F.col("unit_price_at_sale")).cast("decimal(17,2)").alias("sold_value"),
    )


def _purchase_side(t: Tables) -> DataFrame:
    po = t["purchase_orders"].filter(F.col("actual_delivery_date").isNotNull())
    return po.select(
        "store_id",
        "sku_id",
        F.col("actual_delivery_date").alias("movement_date"),
        F.col("quantity_ordered").cast("long").alias("purchased"),
        (F.col("quantity_ordered") * F.col("cost_price")).cast("decimal(17,2)").alias("purchased_value"),
    )


def daily_movement(t: Tables) -> DataFrame:
    """Units and value sold and purchased per store, SKU and day.

    Both sides are stacked as rows and summed once; partial sums shrink them before the shuffle.
    """
    zero = F.lit(0)
    moved = _sales_side(t).unionByName(_purchase_side(t), allowMissingColumns=True)
    cells = moved.groupBy("store_id", "sku_id", "movement_date").agg(
        F.coalesce(F.sum("sold"), zero).alias("total_quantity_sold"),
        F.coalesce(F.sum("sold_value"), zero).cast("decimal(27,2)").alias("total_sold_value"),
        F.coalesce(F.sum("purchased"), zero).alias("total_quantity_purchased"),
        F.coalesce(F.sum("purchased_value"), zero).cast("decimal(27,2)").alias("total_purchased_value"),
    )
    return with_names(cells, t).select(
        "store_id",
        "store_name",
        "movement_date",
        "sku_id",
        "sku_name",
        "total_quantity_sold",
        "total_sold_value",
        "total_quantity_purchased",
        "total_purchased_value",
    )


def running(c: Column | str) -> Column:
    """Running total of a movement column per store and SKU; at most one row per day in a group."""
    through = Window.partitionBy(*CELL).orderBy("movement_date").rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(c).over(through)


def inventory_snapshot(movement: DataFrame, p: Params = Params()) -> DataFrame:
    """Opening and closing stock on each movement day from ``p.start`` on.

    The running sum starts with the first movement ever; the date filter comes after it.
    """
    net = F.col("total_quantity_purchased") - F.col("total_quantity_sold")
    return (
        movement.withColumn("closing_stock", running(net))
        .filter(F.col("movement_date") >= F.lit(p.start))
        .select(
            "store_id",
            "store_name",
            "sku_id",
            "sku_name",
            "movement_date",
            (F.col("closing_stock") - net).alias("opening_stock"),
            "total_quantity_purchased",
            "total_quantity_sold",
            "closing_stock",
        )
    )


def wastage_log(t: Tables, items: DataFrame, p: Params = Params()) -> DataFrame:
    """Expired and unsold units per batch, store and SKU up to ``p.wastage_as_of``.

    ``items`` are the order items with their ``batch_id``, or the allocation itself; rows without a
    batch do not count.
    """
    key = ["batch_id", "store_id", "sku_id"]
    batched = items.filter(F.col("batch_id").isNotNull()).select("order_id", "sku_id", "batch_id", "quantity")
    sold = delivered_items(t, batched)
    sold = sold.groupBy(*key).agg(F.sum("quantity").alias("quantity_sold"))
    bought = (
        t["purchase_orders"]
        .filter(F.col("actual_delivery_date").isNotNull())
        .groupBy(*key, "actual_delivery_date")
        .agg(F.sum("quantity_ordered").alias("quantity_purchased"))
    )
    expired = (
        with_names(bought, t, "shelf_life_days")
        .withColumn("expiry_date", F.date_add("actual_delivery_date", F.col("shelf_life_days")))
        .filter(F.col("expiry_date") <= F.lit(p.wastage_as_of))
    )
    units_sold = F.coalesce("quantity_sold", F.lit(0))
    # Both sides are narrow and compress well: dealt by number, since merged by their bytes few tasks would sort them all.
    return (
        dealt_by_key(expired, key)
        .join(sold, key, "left")
        .select(
            *key,
            "store_name",
            "sku_name",
            "actual_delivery_date",
            "expiry_date",
            "quantity_purchased",
            units_sold.alias("quantity_sold"),
            (F.col("quantity_purchased") - units_sold).alias("quantity_wasted"),
        )
        .filter(F.col("quantity_wasted") > 0)
    )
