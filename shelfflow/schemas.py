"""Table schemas and the parameters of a run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import types as T

# Columns and types of the tables. Keys that grow with the number of transactions are 64 bit wide.
_COLUMNS: dict[str, str] = {
    "products": "sku_id int, sku_name string, category string, mrp decimal(10,2), unit_cost decimal(10,2), "
    "unit_weight_grams int, is_perishable boolean, shelf_life_days int, demand_weight int",
    "dark_stores": "store_id int, store_name string, city string, zone string, locality string, "
    "latitude decimal(9,6), longitude decimal(9,6), capacity_units int, opened_date date",
    "suppliers": "supplier_id int, supplier_name string, city string, avg_lead_time_days int",
    "product_suppliers": "sku_id int, supplier_id int, cost_price decimal(10,2)",
    "customers": "customer_id bigint, customer_name string, customer_email string, customer_phone string, "
    "zone string, locality string, signup_date date",
    "orders": "order_id bigint, customer_id bigint, store_id int, order_timestamp timestamp_ntz, "
    "order_status string, delivery_time_mins int, order_date date",
    "order_items": "order_item_id bigint, order_id bigint, sku_id int, quantity int, "
    "unit_price_at_sale decimal(10,2), discount_pct int, batch_id bigint",
    "purchase_orders": "batch_id bigint, po_line_id string, store_id int, sku_id int, supplier_id int, "
    "order_date date, expected_delivery_date date, actual_delivery_date date, quantity_ordered int, "
    "cost_price decimal(10,2)",
    "fact_ml_forecasts": "store_id int, sku_id int, snapshot_date date, target_sold_qty int, "
    "predicted_demand decimal(10,4)",
}

_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(9,6)": T.DecimalType(9, 6),
    "decimal(10,4)": T.DecimalType(10, 4),
}

SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])
    for table, columns in _COLUMNS.items()
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "products": ["sku_id"],
    "dark_stores": ["store_id"],
    "suppliers": ["supplier_id"],
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "purchase_orders": ["po_line_id"],
    "product_suppliers": ["sku_id", "supplier_id"],
}

# The same for the fact tables that are built.
FACT_KEYS: dict[str, list[str]] = {
    "fact_daily_sales": ["store_id", "sku_id", "order_date"],
    "fact_daily_movement": ["movement_date", "store_id", "sku_id"],
    "fact_wastage_log": ["batch_id", "store_id", "sku_id"],
}

# Columns that may not be NULL beside the keys.
NOT_NULL: dict[str, list[str]] = {"products": ["sku_name"]}

# (child table, column, parent table)
FOREIGN_KEYS: list[tuple[str, str, str]] = [
    ("product_suppliers", "sku_id", "products"),
    ("product_suppliers", "supplier_id", "suppliers"),
    ("orders", "customer_id", "customers"),
    ("orders", "store_id", "dark_stores"),
    ("order_items", "order_id", "orders"),
    ("order_items", "sku_id", "products"),
    ("purchase_orders", "store_id", "dark_stores"),
    ("purchase_orders", "supplier_id", "suppliers"),
    ("purchase_orders", "sku_id", "products"),
    ("fact_ml_forecasts", "store_id", "dark_stores"),
    ("fact_ml_forecasts", "sku_id", "products"),
]


@dataclass(frozen=True)
class Params:
    """Dates, lengths and thresholds of one analysis."""

    # The analysed quarter and the dates tied to it.
    start: date = date(2025, 1, 1)
    end: date = date(2025, 3, 31)
    period_days: int = 90
    wastage_as_of: date = date(2025, 3, 31)
    opening_date: date = date(2024, 12, 12)
    split_date: date = date(2025, 3, 1)
    split_quantile: float = 0.68
    # Class limits in percent of cumulative revenue.
    abc_a: float = 70.0
    abc_b: float = 90.0
    # Service-level factor per velocity class.
    z_scores: Mapping[str, float] = field(
        default_factory=lambda: {"Fast-moving": 2.33, "Medium-moving": 1.65, "Slow-moving": 1.28}
    )
    z_default: float = 1.28
    # Plausible bands of the data checks.
    sold_ratio_band: tuple[float, float] = (60.0, 85.0)
    order_rate_band: tuple[float, float] = (2.0, 6.0)
    months: int = 3
