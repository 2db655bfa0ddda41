"""The whole build: facts once, in order, then every KPI view on top of them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfflow.operators import facts, features, fifo, kpis, reorder, stores
from shelfflow.schemas import Params
from shelfflow.sources.files import register_views, write_fact
from shelfflow.sources.staging import stage
from shelfflow.sources.tables import LazyTables

# Fact -> the column its files are laid out by.
FACT_LAYOUT = {"fact_daily_sales": "order_date", "fact_daily_movement": "movement_date", "fact_wastage_log": "expiry_date"}


def allocate_batches(t: LazyTables) -> LazyTables:
    """The tables with ``order_items.batch_id`` filled in by the allocation.

    The tagged items are written once and read back: what is built on them doesn't allocate again.
    """
    allocation = fifo.fifo_allocate(t["order_items"], t["orders"], t["purchase_orders"], t["products"])
    return t.replaced(order_items=stage(fifo.with_batches(t["order_items"], allocation)))


def build_facts(t: LazyTables, p: Params = Params(), folder: str | None = None) -> LazyTables:
    """The three fact tables; with a ``folder`` they are rebuilt there and read back.

    Views read movement and wastage several times. Written facts make each of those a pruned scan
    instead of another run of the joins below.
    """
    built = LazyTables(
        {
            "fact_daily_sales": lambda: facts.daily_sales(t),
            "fact_daily_movement": lambda: facts.daily_movement(t),
            "fact_wastage_log": lambda: facts.wastage_log(t, t["order_items"], p),
        }
    )
    if folder is None:
        return built
    return LazyTables(
        {name: (lambda n=name: write_fact(built[n], f"{folder}/{n}", [FACT_LAYOUT[n]])) for name in built}
    )


def build_views(t: LazyTables, fact: LazyTables, p: Params = Params()) -> LazyTables:
    """Every view by name, built when asked for.

    The reorder points need ``fact_ml_forecasts`` among the tables.
    """

    def movement() -> DataFrame:
        return fact["fact_daily_movement"]

    def wastage() -> DataFrame:
        return fact["fact_wastage_log"]

    def on_grid(operator) -> DataFrame:
        snapshot = views["view_inventory_snapshot"]
        sold, days = features.sold_from_snapshot(snapshot), features.observed_dates(snapshot, p)
        return operator(t["dark_stores"], t["products"], sold, days)

    views = LazyTables(
        {
            "view_inventory_snapshot": lambda: facts.inventory_snapshot(movement(), p),
            "view_abc_classification": lambda: kpis.abc_classification(fact["fact_daily_sales"], p),
            "view_sales_velocity": lambda: kpis.sales_velocity(views["view_inventory_snapshot"], t, p),
            "view_inventory_turnover": lambda: kpis.inventory_turnover(views["view_inventory_snapshot"], p),
            "view_stock_out_incidents": lambda: kpis.stock_out_incidents(movement()),
            "view_store_movement": lambda: kpis.store_movement(movement(), t["products"], p),
            "view_wastage_info": lambda: kpis.wastage_info(wastage(), t["products"]),
            "view_supplier_reliability": lambda: kpis.supplier_reliability(t["purchase_orders"], t["suppliers"]),
            "view_store_sku_supplier_leadtime": lambda: kpis.store_sku_supplier_leadtime(t["purchase_orders"]),
            "view_store_performances": lambda: stores.store_performances(t, movement(), wastage(), p),
            "view_network_summary": lambda: stores.network_summary(t, movement(), wastage(), p),
            "view_forecast_base": lambda: on_grid(features.forecast_base),
            "view_forecast_features": lambda: on_grid(features.forecast_features),
            "view_forecast_features_clean": lambda: features.clean_features(views["view_forecast_features"]),
            "view_reorder_points": lambda: reorder.reorder_points(
                t["fact_ml_forecasts"], views["view_sales_velocity"], views["view_store_sku_supplier_leadtime"], p
            ),
        }
    )
    return views


def publish(t: LazyTables, p: Params = Params(), folder: str | None = None) -> LazyTables:
    """Build facts and views and register base tables, facts and views for SQL."""
    fact = build_facts(t, p, folder)
    views = build_views(t, fact, p)
    skipped = set() if "fact_ml_forecasts" in t else {"view_reorder_points"}
    register_views({name: t[name] for name in t})
    register_views({name: fact[name] for name in fact})
    register_views({name: views[name] for name in views if name not in skipped})
    return views
