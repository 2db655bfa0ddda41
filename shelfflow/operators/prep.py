"""Preparation of the base tables: products, store weights, batch numbers, receipts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfflow.functions.numeric import rounded_ratio
from shelfflow.functions.ordering import running_before
from shelfflow.operators.facts import CELL

# Category -> (perishable, shortest and longest shelf life in days, demand weight).
CATEGORY_RULES: dict[str, tuple[bool, int, int, int]] = {
    "Fruits & Vegetables": (True, 2, 7, 10),
    "Dairy, Bread & Batter": (True, 2, 7, 9),
    "Meats, Fish & Eggs": (True, 1, 3, 3),
    "Beverages": (True, 30, 180, 7),
    "Ice Cream & Desserts": (True, 60, 180, 4),
    "Packaged Food": (False, 90, 270, 5),
    "Biscuits": (False, 90, 270, 5),
    "Munchies": (False, 90, 180, 6),
    "Chocolates & Candies": (False, 120, 365, 4),
    "Cooking Essentials": (False, 180, 365, 3),
    "Paan Corner": (True, 3, 10, 4),
    "Personal Care": (False, 365, 730, 2),
    "Home & Cleaning": (False, 365, 730, 2),
    "Health & Hygiene": (False, 180, 730, 3),
}
# What an unlisted category gets.
DEFAULT_RULE = (False, 180, 180, 1)

# Demand tier per zone (1.0 where unlisted), in hundredths.
ZONE_TIERS: dict[str, int] = {"South Delhi": 130, "North Delhi": 100, "East Delhi": 100, "West Delhi": 90}
DEFAULT_TIER = 100
# Capacity factor of the top, middle and bottom third of the stores, in hundredths.
CAPACITY_FACTORS = (130, 100, 80)


def _lookup(table: Mapping[str, object], key: Column, default: object) -> Column:
    if not table:
        return F.lit(default)
    pairs = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, key), F.lit(default))


def build_products(
    feed: DataFrame,
    rules: Mapping[str, tuple[bool, int, int, int]] = CATEGORY_RULES,
    default: tuple[bool, int, int, int] = DEFAULT_RULE,
) -> DataFrame:
    """The product list of a raw feed: trimmed, in rupees, without copies, numbered in feed order.

    Copies collapse by a grouped minimum of ``feed_row``; the numbers are bounded running counts.
    Shelf life is the range of the category (its draw belongs to data generation).
    """
    distinct = (
        feed.select(
            F.col("feed_row").cast("long").alias("feed_row"),
            F.trim("Category").alias("category"),
            F.trim("name").alias("sku_name"),
            (F.col("mrp").cast("decimal(12,0)") / 100).cast("decimal(12,2)").alias("mrp"),
            F.col("weightInGms").alias("unit_weight_grams"),
        )
        .groupBy("category", "sku_name", "mrp", "unit_weight_grams")
        .agg(F.min("feed_row").alias("feed_row"))
        .withColumn("rows", F.lit(1).cast("long"))
    )
    numbered = running_before(distinct, [("feed_row", False)], ["rows"])
    columns = ("is_perishable", "shelf_life_min_days", "shelf_life_max_days", "demand_weight")
    return numbered.select(
        (F.col("rows_before") + 1).alias("sku_id"),
        "sku_name",
        "category",
        "mrp",
        "unit_weight_grams",
        *[
            _lookup({k: v[i] for k, v in rules.items()}, F.col("category"), default[i]).alias(c)
            for i, c in enumerate(columns)
        ],
    )


def store_demand_weights(stores: DataFrame, tiers: Mapping[str, int] = ZONE_TIERS) -> DataFrame:
    """Demand weight of a store: 60 % zone tier, 40 % capacity third (equal capacity: lower id first)."""
    keyed = stores.select("store_id", "zone", "capacity_units").withColumn("rows", F.lit(1).cast("long"))
    ranked = running_before(keyed, [("capacity_units", True), ("store_id", False)], ["rows"])
    n, place = F.col("rows_total"), F.col("rows_before")
    top, middle, bottom = CAPACITY_FACTORS
    factor = (
        F.when(place < F.floor(n / 3), top).when(place < F.floor(n * 2 / 3), middle).otherwise(bottom)
    )
    blend = _lookup(tiers, F.col("zone"), DEFAULT_TIER) * 6 + factor * 4
    return ranked.select("store_id", rounded_ratio(blend, F.lit(1000), 2).alias("demand_weight"))


def with_order_date(orders: DataFrame) -> DataFrame:
    """Orders with the calendar day of their timestamp."""
    return orders.withColumn("order_date", F.to_date("order_timestamp"))


def assign_batch_keys(po: DataFrame, opening: bool = False) -> DataFrame:
    """PO lines with one consecutive ``batch_id`` per store, supplier and delivery day.

    ``opening=True`` numbers opening stock, one batch per store and supplier. NULL keys come first
    and count like any other value.
    """
    key = ["store_id", "supplier_id"] + ([] if opening else ["actual_delivery_date"])
    batches = po.select(*key).distinct().withColumn("rows", F.lit(1).cast("long"))
    numbered = running_before(batches, [(k, False) for k in key], ["rows"])
    same = [po[k].eqNullSafe(F.col(f"_{k}")) for k in key]
    numbered = numbered.select(
        *[F.col(k).alias(f"_{k}") for k in key], (F.col("rows_before") + 1).alias("_batch_id")
    )
    return (
        po.join(numbered, same, "left")
        .withColumn("batch_id", F.col("_batch_id"))
        .drop("_batch_id", *[f"_{k}" for k in key])
    )


def daily_receipts(po: DataFrame) -> DataFrame:
    """Units received per store, SKU and day."""
    return (
        po.filter(F.col("actual_delivery_date").isNotNull())
        .groupBy(*CELL, "actual_delivery_date")
        .agg(F.sum("quantity_ordered").alias("quantity_received"))
    )


def opening_stock(po: DataFrame, stores: DataFrame, products: DataFrame, day: date) -> DataFrame:
    """Units received on the opening day for every store and SKU, 0 where none."""
    received = (
        po.filter(F.col("actual_delivery_date") == F.lit(day))
        .groupBy(*CELL)
        .agg(F.sum("quantity_ordered").alias("opening_stock"))
    )
    return (
        store_sku_pairs(stores.select("store_id"), products.select("sku_id"))
        .join(received, CELL, "left")
        .withColumn("opening_stock", F.coalesce("opening_stock", F.lit(0)))
    )


def store_sku_pairs(stores: DataFrame, products: DataFrame, per_bucket: int = 1000) -> DataFrame:
    """Every store with every SKU: the full grid is the wanted result.

    Stores lie in buckets of about ``per_bucket``. Each product row takes every bucket number, then an equi-join on the
    number pairs it with the stores of that bucket: no list of stores is held anywhere, and no join key
    has more stores than a bucket.
    """
    # The number of stores is one value, whatever their number.
    buckets = stores.agg(F.ceil(F.count(F.lit(1)) / per_bucket).alias("n")).scalar()
    dealt = stores.withColumn("_bucket", F.pmod(F.xxhash64("store_id"), F.greatest(buckets, F.lit(1))))
    numbered = products.withColumn("_bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(buckets, F.lit(1)) - 1)))
    return numbered.join(dealt, "_bucket").select(*products.columns, *stores.columns)


def supplier_multiplicity(product_suppliers: DataFrame) -> DataFrame:
    """How many SKUs have one supplier, two suppliers, and so on."""
    return (
        product_suppliers.groupBy("sku_id")
        .agg(F.count(F.lit(1)).alias("suppliers"))
        .groupBy("suppliers")
        .agg(F.count(F.lit(1)).alias("skus"))
    )


def with_expiry(po: DataFrame, products: DataFrame) -> DataFrame:
    """PO lines with their last sellable day; NULL while undelivered or without shelf life."""
    return po.join(products.select("sku_id", "shelf_life_days"), "sku_id", "left").withColumn(
        "expiry_date", F.date_add("actual_delivery_date", F.col("shelf_life_days"))
    )
