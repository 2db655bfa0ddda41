"""Key checks and plausibility reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfflow.functions.dealing import dealt_by_key
from shelfflow.functions.numeric import quotient, rounded_ratio
from shelfflow.operators.facts import CELL, Tables
from shelfflow.operators.prep import store_sku_pairs
from shelfflow.schemas import FACT_KEYS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS, SCHEMAS, Params


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    dealt = dealt_by_key(df.select(*keys), keys)
    return dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs per column, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns])
    return counts.select(F.inline(pairs))


def check_foreign_key(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose key has no parent."""
    keys = parent.select(column)
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def duplicate_keys(t: Tables, tables: Mapping[str, Sequence[str]] = PRIMARY_KEYS | FACT_KEYS) -> DataFrame:
    """Every repeated primary key of every table: table, key, count. A NULL in a key is shown as ``NULL``."""
    parts = []
    for name, keys in tables.items():
        if name in t:
            label = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
            parts.append(
                check_unique(t[name], keys).select(
                    F.lit(name).alias("table_name"), label.alias("key_value"), "occurrences"
                )
            )
    return reduce(DataFrame.unionByName, parts)


def required_nulls(t: Tables) -> DataFrame:
    """NULLs in keys and other required columns of every table: table, column, count."""
    parts = []
    for name, keys in (PRIMARY_KEYS | FACT_KEYS).items():
        if name in t:
            counted = check_not_null(t[name], [*keys, *NOT_NULL.get(name, [])])
            parts.append(counted.select(F.lit(name).alias("table_name"), "column", "nulls"))
    return reduce(DataFrame.unionByName, parts)


def orphan_counts(t: Tables) -> DataFrame:
    """Rows without a parent, per foreign key."""
    parts = []
    for child, column, parent in FOREIGN_KEYS:
        if child in t and parent in t:
            parts.append(
                check_foreign_key(t[child], t[parent], column).agg(F.count(F.lit(1)).alias("orphans")).select(
                    F.lit(child).alias("child"), F.lit(column).alias("key_column"), F.lit(parent).alias("parent"), "orphans"
                )
            )
    return reduce(DataFrame.unionByName, parts)


def check_schema(df: DataFrame, name: str) -> list[str]:
    """Differences between a frame and the declared schema of table ``name`` (empty when equal)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in SCHEMAS[name]}
    return sorted(f"{c}: {have.get(c)} instead of {want.get(c)}" for c in {*have, *want} if have.get(c) != want.get(c))


def _in_band(value: Column, band: tuple[float, float]) -> Column:
    return value.between(F.lit(band[0]), F.lit(band[1]))


def sold_purchased_ratio(t: Tables, p: Params = Params()) -> DataFrame:
    """Units sold as a percentage of units ordered, and whether it lies in the band."""
    sold = t["order_items"].select(F.col("quantity").cast("long").alias("sold"))
    bought = t["purchase_orders"].select(F.col("quantity_ordered").cast("long").alias("bought"))
    return (
        sold.unionByName(bought, allowMissingColumns=True)
        .agg(F.sum("sold").alias("total_sold"), F.sum("bought").alias("total_purchased"))
        .withColumn("ratio_pct", rounded_ratio(F.col("total_sold") * 100, F.col("total_purchased"), 2))
        .withColumn("in_band", _in_band(F.col("ratio_pct"), p.sold_ratio_band))
    )


def orders_per_customer_month(t: Tables, p: Params = Params()) -> DataFrame:
    """Delivered orders per customer and month, and whether the rate lies in the band."""
    delivered = t["orders"].filter(F.col("order_status") == "delivered").select(F.lit(1).alias("delivered"))
    customers = t["customers"].select(F.lit(1).alias("customer"))
    return (
        delivered.unionByName(customers, allowMissingColumns=True)
        .agg(F.count("delivered").alias("delivered_orders"), F.count("customer").alias("customers"))
        .withColumn(
            "orders_per_month", rounded_ratio(F.col("delivered_orders"), F.col("customers") * p.months, 2)
        )
        .withColumn("in_band", _in_band(F.col("orders_per_month"), p.order_rate_band))
    )


def quantity_distribution(items: DataFrame) -> DataFrame:
    """Share of items per quantity."""
    counts = items.groupBy("quantity").agg(F.count(F.lit(1)).alias("items"))
    total = counts.agg(F.sum("items")).scalar()
    return counts.withColumn("share", quotient(F.col("items"), total))


def delivery_summary(po: DataFrame) -> DataFrame:
    """Lines and units ordered, and on-time and late deliveries with their share."""
    actual, expected = F.col("actual_delivery_date"), F.col("expected_delivery_date")
    return (
        po.agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("quantity_ordered").alias("units"),
            F.count_if(actual <= expected).alias("on_time"),
            F.count_if(actual > expected).alias("late"),
        )
        .withColumn("delivered", F.col("on_time") + F.col("late"))
        .select(
            "lines",
            "units",
            "on_time",
            "late",
            rounded_ratio(F.col("on_time") * 100, F.col("delivered"), 1).alias("on_time_pct"),
            rounded_ratio(F.col("late") * 100, F.col("delivered"), 1).alias("late_pct"),
        )
    )


def negative_stock(snapshot: DataFrame) -> DataFrame:
    """Days on which more has been sold than was ever bought."""
    return snapshot.filter(F.col("closing_stock") < 0).select(*CELL, "movement_date", "closing_stock")


def missing_opening(t: Tables, day: date) -> DataFrame:
    """Store and SKU pairs with demand but without stock received on the opening day."""
    wanted = t["products"].filter(F.col("demand_weight") > 0).select("sku_id")
    received = t["purchase_orders"].filter(F.col("actual_delivery_date") == F.lit(day)).select(*CELL)
    return store_sku_pairs(t["dark_stores"].select("store_id"), wanted).join(received, CELL, "left_anti").select(*CELL)


def category_counts(products: DataFrame) -> DataFrame:
    """Number of products per category."""
    return products.groupBy("category").agg(F.count(F.lit(1)).alias("products"))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in a fixed random order of ``key``: the same rows for the same seed."""
    mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(mixed, key).limit(n)
