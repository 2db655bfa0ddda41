import os
import sys
from datetime import date, datetime
from decimal import Decimal

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from pyspark.sql import SparkSession  # noqa: E402

from shelfflow.schemas import SCHEMAS  # noqa: E402
from shelfflow.sources.tables import LazyTables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        # A few rows per query: compiling every stage would take longer than running it.
        .config("spark.sql.codegen.wholeStage", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def d(text):
    """An ISO day; None stays None."""
    return None if text is None else date.fromisoformat(text)


def ts(text):
    return datetime.fromisoformat(text)


def money(x):
    return None if x is None else Decimal(str(x))


@pytest.fixture(scope="session")
def frame(spark):
    """frame(table, rows): a frame with the declared schema from dicts; missing columns are NULL."""

    def build(table, rows):
        schema = SCHEMAS[table]
        return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)

    return build


@pytest.fixture(scope="session")
def rows_of():
    """Rows as dicts, ordered by their text."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((r.asDict() for r in picked.collect()), key=repr)

    return collect


@pytest.fixture(scope="session")
def shop(frame):
    """Two stores, four SKUs, a handful of orders and deliveries with the awkward cases in them."""
    stores = [
        {"store_id": i, "store_name": f"S{i}", "zone": z, "capacity_units": c}
        for i, z, c in [(1, "South Delhi", 300), (2, "West Delhi", 200), (3, "Elsewhere", 100)]
    ]
    products = [
        {"sku_id": i, "sku_name": f"P{i}", "category": c, "mrp": money(m), "unit_cost": money(u), "shelf_life_days": s,
         "demand_weight": w}
        for i, c, m, u, s, w in [
            (1, "A", "10.00", "6.00", 3, 1),
            (2, "A", "20.00", "12.00", 30, 2),
            (3, "B", "5.50", "2.25", 30, 0),
            (4, "B", "1.00", "0.50", 5, 1),
        ]
    ]
    suppliers = [{"supplier_id": i, "supplier_name": f"V{i}"} for i in (1, 2, 3)]
    orders = [
        {"order_id": o, "customer_id": 1, "store_id": s, "order_timestamp": ts(t), "order_status": st,
         "delivery_time_mins": m, "order_date": d(t[:10])}
        for o, s, t, st, m in [
            (1, 1, "2025-01-02T09:00:00", "delivered", 10),
            (2, 1, "2025-01-02T10:00:00", "cancelled", None),
            (3, 1, "2025-01-04T10:00:00", "delivered", 31),
            (4, 2, "2025-01-05T10:00:00", "delivered", None),
            (5, 2, "2025-01-06T10:00:00", "placed", None),
            (6, 1, "2025-04-02T10:00:00", "delivered", 20),
        ]
    ]
    items = [
        {"order_item_id": i, "order_id": o, "sku_id": k, "quantity": q, "unit_price_at_sale": money(p), "batch_id": b}
        for i, o, k, q, p, b in [
            (1, 1, 1, 4, "9.00", 11),
            (2, 1, 2, 1, "18.00", 12),
            (3, 2, 1, 5, "9.00", None),
            (4, 3, 1, 2, "8.00", 11),
            (5, 4, 3, 7, "5.00", None),
            (6, 5, 3, 1, "5.00", None),
            (7, 6, 2, 1, "20.00", 12),
        ]
    ]
    po = [
        {"batch_id": b, "po_line_id": f"PO-{n}", "store_id": s, "sku_id": k, "supplier_id": v, "order_date": d(o),
         "expected_delivery_date": d(e), "actual_delivery_date": d(a), "quantity_ordered": q, "cost_price": money(c)}
        for n, (b, s, k, v, o, e, a, q, c) in enumerate(
            [
                (11, 1, 1, 1, "2024-12-20", "2024-12-28", "2024-12-30", 6, "5.00"),
                (11, 1, 1, 1, "2024-12-20", "2024-12-30", "2024-12-30", 4, "5.00"),
                (12, 1, 2, 2, "2024-12-20", "2024-12-31", "2025-01-01", 10, "11.00"),
                (13, 2, 3, 1, "2025-01-01", "2025-01-05", "2025-01-05", 5, "2.00"),
                (14, 2, 3, 3, "2025-01-01", "2025-01-09", None, 50, "2.00"),
                (15, 2, 4, 2, "2025-01-01", "2025-01-03", "2025-01-03", 8, "0.40"),
            ],
            1,
        )
    ]
    return LazyTables(
        {
            "dark_stores": lambda: frame("dark_stores", stores),
            "products": lambda: frame("products", products),
            "suppliers": lambda: frame("suppliers", suppliers),
            "customers": lambda: frame("customers", [{"customer_id": 1}, {"customer_id": 2}]),
            "orders": lambda: frame("orders", orders),
            "order_items": lambda: frame("order_items", items),
            "purchase_orders": lambda: frame("purchase_orders", po),
            "product_suppliers": lambda: frame(
                "product_suppliers", [{"sku_id": k, "supplier_id": v} for k, v in [(1, 1), (2, 2), (3, 1), (3, 3), (4, 2)]]
            ),
        }
    )
