"""Entry points: one flagship query, every registered query, and the SQL that checks them."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracle  # noqa: E402
from shelfflow.operators import facts, features, fifo, kpis, prep, quality, reorder, stores  # noqa: E402
from shelfflow.plans import demand, exchange  # noqa: E402
from shelfflow.schemas import Params  # noqa: E402
from shelfflow.sources.benchmark_tables import load_tables, product_feed  # noqa: E402
from shelfflow.sources.tables import LazyTables  # noqa: E402

try:
    import corpus_pipeline
    from shelfflow.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "shelfflow.llm", "shelfflow.llm.queries"):
        raise
    corpus_pipeline = corpus = None

Query = Callable[[SparkSession, str], DataFrame]
P = Params()
# The model whose training and prediction SQL can repeat.
SMALL_MODEL = demand.ModelParams(max_iter=2, max_depth=2, patience=None)

# Stand-ins for the category and zone rules, in terms of the benchmark's categories and zones.
BENCHMARK_RULES = {"SMALL": (True, 2, 7, 10), "PROMO": (True, 30, 180, 7), "LARGE": (False, 90, 270, 5)}
BENCHMARK_TIERS = {"Zone 0": 130, "Zone 1": 100, "Zone 2": 100, "Zone 3": 90}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, whole numbers as bigint, dates as ISO text: equal in every engine."""
    as_type = {T.DecimalType: "double", T.IntegerType: "bigint", T.DateType: "string"}
    kinds = {f.name: as_type.get(type(f.dataType)) for f in df.schema}
    return df.selectExpr(*[f"cast(`{c}` AS {kind}) AS `{c}`" if kind else f"`{c}`" for c, kind in kinds.items()])


def _movement(t):
    return facts.daily_movement(t)


def _snapshot(t):
    return facts.inventory_snapshot(_movement(t), P)


def _velocity(t):
    return kpis.sales_velocity(_snapshot(t), t, P)


def _allocation(t, use_expiry: bool = True):
    return fifo.fifo_allocate(t["order_items"], t["orders"], t["purchase_orders"], t["products"], use_expiry)


def _wastage(t):
    return facts.wastage_log(t, _allocation(t), P)


def _features(t):
    days = features.calendar(P.start, P.end)
    return features.forecast_features(t["dark_stores"], t["products"], features.daily_sold(t), days)


def _clean(t):
    return features.clean_features(_features(t))


def _forecasts(t):
    """March with a prediction between the rolling mean and four weeks ago, beside the features the baselines need."""
    test = features.split_by_date(_clean(t), P.split_date)[1]
    return test.withColumn("predicted_demand", ((F.col("rolling_7day_avg") + F.col("sales_lag_28")) / 2).cast("decimal(10,4)"))


def _reorder(t, forecasts: DataFrame | None = None):
    leadtimes = kpis.store_sku_supplier_leadtime(t["purchase_orders"])
    return reorder.reorder_points(_forecasts(t) if forecasts is None else forecasts, _velocity(t), leadtimes, P)


def _labelled(parts: tuple[DataFrame, DataFrame]) -> DataFrame:
    columns = ["store_id", "sku_id", "snapshot_date", "target_sold_qty"]
    train, test = (
        df.select(F.lit(name).alias("part"), *columns) for name, df in zip(("train", "test"), parts)
    )
    return train.unionByName(test)


def _date_spine(t):
    orders = t["orders"].groupBy(F.col("order_date").alias("snapshot_date")).agg(F.count("order_id").alias("orders"))
    spine = features.date_spine(t["orders"].sparkSession, P.start, P.end)
    return spine.join(orders, "snapshot_date", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


def _metrics(t):
    return features.forecast_metrics(_forecasts(t)).withColumn("mape_nonzero_pct", F.round("mape_nonzero_pct", 6))


def _batch_keys(t):
    delivered = t["purchase_orders"].filter(F.col("actual_delivery_date").isNotNull()).drop("batch_id")
    return prep.assign_batch_keys(delivered).select(
        "po_line_id", "store_id", "supplier_id", "actual_delivery_date", "batch_id"
    )


def _expiry(t):
    return prep.with_expiry(t["purchase_orders"], t["products"]).select(
        "po_line_id", "batch_id", "store_id", "sku_id", "actual_delivery_date", "shelf_life_days", "expiry_date"
    )


def _with_facts(t):
    """The tables and the facts built from them."""
    built = {"fact_daily_sales": facts.daily_sales(t), "fact_daily_movement": _movement(t), "fact_wastage_log": _wastage(t)}
    return t.replaced(**built)


def _loaded(name: str, **changed) -> Callable[[LazyTables], DataFrame]:
    """Base table ``name`` out to CSV and back; timestamps as text."""

    def run(t: LazyTables) -> DataFrame:
        back = exchange.reloaded(t[name].withColumns({c: F.expr(x) for c, x in changed.items()}), name)
        stamps = {f.name: F.col(f.name).cast("string") for f in back.schema if isinstance(f.dataType, T.TimestampNTZType)}
        return back.withColumns(stamps) if stamps else back

    return run


def _latin1(t):
    suppliers = t["suppliers"].withColumn("supplier_name", F.concat(F.lit("Épicerie "), "supplier_name"))
    return exchange.reloaded(suppliers, "suppliers", "ISO-8859-1")


def _loaded_forecasts(t):
    given = _forecasts(t).withColumn("target_sold_qty", F.col("target_sold_qty").cast("int"))
    return exchange.reloaded(given, "fact_ml_forecasts")


DAILY = "SELECT order_date, sum(total_quantity_sold) AS units, sum(total_revenue) AS revenue FROM {view} GROUP BY order_date"

ON_TABLES: dict[str, Callable[[LazyTables], DataFrame]] = {
    "dq_unique": quality.duplicate_keys,
    "dq_unique_lines": lambda t: quality.check_unique(t["order_items"], ["order_id", "sku_id"]),
    "dq_orphans": quality.orphan_counts,
    "dq_nulls": lambda t: quality.check_not_null(
        t["purchase_orders"], ["batch_id", "actual_delivery_date", "expected_delivery_date"]
    ),
    "dq_unique_facts": lambda t: quality.duplicate_keys(_with_facts(t)),
    "dq_unique_repeated": lambda t: quality.duplicate_keys(
        t, {"order_items": ["order_id"], "purchase_orders": ["batch_id", "actual_delivery_date"]}
    ),
    "dq_required": lambda t: quality.required_nulls(_with_facts(t)),
    **{
        f"load_{name}": _loaded(name)
        for name in ("products", "dark_stores", "suppliers", "product_suppliers", "customers", "orders", "purchase_orders")
    },
    # The files' item numbers are whole numbers.
    "load_order_items": _loaded("order_items", order_item_id="order_id"),
    "load_forecasts": _loaded_forecasts,
    "load_latin1": _latin1,
    "load_tsv": lambda t: exchange.through_tsv(t["purchase_orders"]),
    "write_quoted_csv": lambda t: exchange.through_quoted_csv(facts.daily_sales(t)),
    "read_pruned": lambda t: t["order_items"].groupBy("order_id").agg(F.sum("quantity").alias("units")),
    "rebuild_fact": lambda t: exchange.rebuilt(facts.daily_sales(t), "order_date"),
    "published_view": lambda t: exchange.published(facts.daily_sales(t), DAILY),
    "write_enforced": lambda t: exchange.enforced(t, ["products", "suppliers"], "product_suppliers"),
    "load_rejects": lambda t: exchange.sorted_out(
        t["purchase_orders"], "purchase_orders", "quantity_ordered", F.col("sku_id") % 7 == 0, "po_line_id"
    ),
    "catalog_stock_outs": lambda t: kpis.stock_out_incidents(
        exchange.through_catalog(_movement(t), "fact_daily_movement", facts.CELL)
    ),
    "prep_order_date": lambda t: prep.with_order_date(t["orders"].drop("order_date")).select("order_id", "order_date"),
    "prep_opening_batches": lambda t: prep.assign_batch_keys(
        t["purchase_orders"].filter(F.col("actual_delivery_date") <= F.lit(P.opening_date)).drop("batch_id"), opening=True
    ).select("po_line_id", "store_id", "supplier_id", "batch_id"),
    "features_capped": lambda t: features.cap_dates(_clean(t), date(2025, 3, 20), stray=["capacity_units"]),
    "prep_store_weights": lambda t: prep.store_demand_weights(t["dark_stores"], BENCHMARK_TIERS),
    "prep_batch_keys": _batch_keys,
    "prep_daily_receipts": lambda t: prep.daily_receipts(t["purchase_orders"]),
    "prep_opening_stock": lambda t: prep.opening_stock(
        t["purchase_orders"], t["dark_stores"], t["products"], P.opening_date
    ),
    "prep_supplier_multiplicity": lambda t: prep.supplier_multiplicity(t["product_suppliers"]),
    "prep_expiry": _expiry,
    "fifo_batch": _allocation,
    "fifo_noexpiry": lambda t: _allocation(t, use_expiry=False),
    "fifo_anomalies": lambda t: fifo.fifo_anomalies(_allocation(t)),
    "fifo_summary": lambda t: fifo.fifo_summary(_allocation(t)),
    "daily_sales": facts.daily_sales,
    "daily_movement": _movement,
    "wastage_log": _wastage,
    "inventory_snapshot": _snapshot,
    "abc_classification": lambda t: kpis.abc_classification(facts.daily_sales(t), P),
    "sales_velocity": _velocity,
    "wastage_info": lambda t: kpis.wastage_info(_wastage(t), t["products"]),
    "inventory_turnover": lambda t: kpis.inventory_turnover(_snapshot(t), P),
    "stock_out_incidents": lambda t: kpis.stock_out_incidents(_movement(t)),
    "store_movement": lambda t: kpis.store_movement(_movement(t), t["products"], P),
    "supplier_reliability": lambda t: kpis.supplier_reliability(t["purchase_orders"], t["suppliers"]),
    "store_sku_supplier_leadtime": lambda t: kpis.store_sku_supplier_leadtime(t["purchase_orders"]),
    "store_orders": stores.store_orders,
    "store_restocks": lambda t: stores.store_restocks(t["purchase_orders"]),
    "store_wastage": lambda t: stores.store_wastage(t, _wastage(t)),
    "store_velocity": lambda t: stores.store_velocity(_velocity(t), P),
    "store_top_category": lambda t: stores.store_top_category(_velocity(t)),
    "store_turnover": lambda t: stores.store_turnover(_movement(t), P),
    "store_stockouts": lambda t: stores.store_stockouts(_movement(t), P),
    "store_performances": lambda t: stores.store_performances(t, _movement(t), _wastage(t), P),
    "network_summary": lambda t: stores.network_summary(t, _movement(t), _wastage(t), P),
    "forecast_sigma": lambda t: reorder.forecast_sigma(_forecasts(t)),
    "blended_leadtime": lambda t: reorder.blended_leadtime(kpis.store_sku_supplier_leadtime(t["purchase_orders"])),
    "reorder_points": _reorder,
    "reorder_flags": lambda t: reorder.reorder_flags(_reorder(t), _snapshot(t)),
    "date_spine": _date_spine,
    "forecast_base": lambda t: features.forecast_base(
        t["dark_stores"], t["products"], features.daily_sold(t), features.calendar(P.start, P.end)
    ),
    "forecast_base_observed": lambda t: features.forecast_base(
        t["dark_stores"],
        t["products"],
        features.sold_from_snapshot(_snapshot(t)),
        features.observed_dates(_snapshot(t), P),
    ),
    "forecast_features": _features,
    "forecast_features_clean": _clean,
    "split_fixed": lambda t: _labelled(features.split_by_date(_clean(t), P.split_date)),
    "split_quantile": lambda t: _labelled(features.split_by_quantile(_clean(t), P.split_quantile)),
    "split_summary": lambda t: features.split_summary(*features.split_by_quantile(_clean(t), P.split_quantile)),
    "demand_model": lambda t: demand.model_report(_clean(t), P, demand.ModelParams(variance_power=1.5)),
    "forecasts": lambda t: demand.demand_forecasts(_clean(t), P),
    "forecasts_by_table": lambda t: demand.scored_by_table(_clean(t), P, demand.ModelParams(max_iter=20)),
    "demand_boosting": lambda t: demand.demand_forecasts(_clean(t), P, SMALL_MODEL),
    "reorder_points_model": lambda t: _reorder(t, demand.stored_forecasts(_clean(t), P)),
    "reorder_points_boosted": lambda t: _reorder(t, demand.stored_forecasts(_clean(t), P, SMALL_MODEL)),
    "forecast_metrics": _metrics,
    "naive_baselines": lambda t: features.naive_baselines(_forecasts(t)),
    "baseline_improvement": lambda t: features.baseline_improvement(_forecasts(t)),
    "target_distribution": lambda t: features.target_distribution(_forecasts(t)),
    "check_sold_ratio": lambda t: quality.sold_purchased_ratio(t, P),
    "check_order_rate": lambda t: quality.orders_per_customer_month(t, P),
    "check_quantity_distribution": lambda t: quality.quantity_distribution(t["order_items"]),
    "check_delivery_summary": lambda t: quality.delivery_summary(t["purchase_orders"]),
    "check_negative_stock": lambda t: quality.negative_stock(_snapshot(t)),
    "check_missing_opening": lambda t: quality.missing_opening(t, P.opening_date),
    "check_category_counts": lambda t: quality.category_counts(t["products"]),
    "sample_rows": lambda t: quality.sample_rows(
        t["orders"].select("order_id", "store_id", "order_date", "order_status"), "order_id", 10
    ),
}


def _on_tables(operator: Callable[[LazyTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: _plain(operator(load_tables(spark, sf_dir)))


def _importable(query: Query) -> Query:
    """Python workers started from here on find the library as this process does, wherever it was started."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        paths = environment.get("PYTHONPATH", "").split(os.pathsep)
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *[p for p in paths if p and p != ROOT]])
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    registered = {name: _importable(_on_tables(operator)) for name, operator in ON_TABLES.items()}
    registered["prep_products"] = lambda spark, sf_dir: _plain(
        prep.build_products(product_feed(spark, sf_dir), BENCHMARK_RULES)
    )
    if corpus:
        registered |= {name: _importable(q) for name, q in {**corpus.QUERIES, "pipeline": corpus_pipeline.run}.items()}
    return registered


def oracle_sql() -> dict[str, str]:
    sql = oracle.oracle_sql()
    if corpus:
        sql |= corpus.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql


def entry(spark: SparkSession) -> DataFrame:
    """Sales velocity and speed class of every SKU in every store."""
    return queries()["sales_velocity"](spark, "/root/testdata/sf0.001")
