"""The inventory tables derived from the TPC-H-like benchmark parquet (rules in FIXTURES.md).

Whole-number arithmetic only, so that another engine gets the same values. Every frame reads the
whole table it comes from: line items with status F are sales, those with status O are supply,
and every part is a SKU.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfflow.sources.tables import LazyTables

# Declared, not inferred: opening a table then needs no job.
BENCHMARK_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}

# Fixed values of the mapping. A batch number has room for 128 days per supplier.
SOLD_ON = "date_add(DATE'2025-01-01', datediff(to_date(o_orderdate), DATE'1995-01-01') % 90)"
SUPPLY_DAY = "datediff(to_date(l_shipdate), DATE'1995-01-01') % 120"
DUE = f"date_add(DATE'2024-12-12', {SUPPLY_DAY})"
LATE = "if((l_orderkey * 7 + l_partkey * 3 + l_linenumber) % 20 < 3, cast(1 + l_orderkey % 3 AS int), 0)"
SUPPLY_COST = "cast((mrp_cents * (52 + l_suppkey % 21) div 100) * 0.01BD AS decimal(10,2)) AS cost_price"
DISCOUNT = "cast(round(l_discount * 100) AS int)"
# The keys of a line together are its key: exact, and no numbering pass over the table.
LINE_KEY = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def read_benchmark(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(BENCHMARK_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


class _Benchmark:
    """Builds the inventory tables of one benchmark folder.

    Joins run from the large table outwards, each small table joined straight from its file, so
    that the planner sees the true size of what it may broadcast.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.read = lambda name: read_benchmark(spark, folder, name)

    def _skus(self) -> DataFrame:
        """A SKU per part; the list price in cents."""
        return self.read("part").selectExpr(
            "cast(p_partkey AS int) AS sku_id",
            "p_name AS sku_name",
            "p_type AS category",
            "cast(round(p_retailprice * 100) AS bigint) AS mrp_cents",
            "p_size AS size",
        )

    def _priced_lines(self, status: str) -> DataFrame:
        """Line items of one status with their SKU and its list price."""
        lines = self.read("lineitem").filter(f"l_linestatus = '{status}'")
        prices = self._skus().select("sku_id", "mrp_cents")
        return lines.selectExpr("*", "cast(l_partkey AS int) AS sku_id").join(prices, "sku_id")

    def _with_region(self, df: DataFrame, nation_key: str) -> DataFrame:
        nation = self.read("nation")
        return df.join(nation, df[nation_key] == nation["n_nationkey"])

    def products(self) -> DataFrame:
        return self._skus().selectExpr(
            "sku_id",
            "sku_name",
            "category",
            "cast(mrp_cents * 0.01BD AS decimal(10,2)) AS mrp",
            "cast((mrp_cents * (55 + sku_id % 21) div 100) * 0.01BD AS decimal(10,2)) AS unit_cost",
            "size * 10 AS unit_weight_grams",
            "size <= 10 AS is_perishable",
            "size AS shelf_life_days",
            "1 + size % 10 AS demand_weight",
        )

    def dark_stores(self) -> DataFrame:
        return self.read("region").selectExpr(
            "r_regionkey AS store_id",
            "r_name AS store_name",
            "'TEST' AS city",
            "concat('Zone ', r_regionkey % 4) AS zone",
            "r_name AS locality",
            "cast(0 AS decimal(9,6)) AS latitude",
            "cast(0 AS decimal(9,6)) AS longitude",
            "2000 + r_regionkey * 617 AS capacity_units",
            "date_add(DATE'2022-01-01', r_regionkey) AS opened_date",
        )

    def suppliers(self) -> DataFrame:
        return self._with_region(self.read("supplier"), "s_nationkey").selectExpr(
            "cast(s_suppkey AS int) AS supplier_id",
            "s_name AS supplier_name",
            "n_name AS city",
            "cast(2 + s_suppkey % 6 AS int) AS avg_lead_time_days",
        )

    def customers(self) -> DataFrame:
        return self._with_region(self.read("customer"), "c_nationkey").selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_name",
            "cast(NULL AS string) AS customer_email",
            "cast(NULL AS string) AS customer_phone",
            "concat('Zone ', n_regionkey % 4) AS zone",
            "n_name AS locality",
            "date_add(DATE'2024-01-01', cast(c_custkey % 365 AS int)) AS signup_date",
        )

    def orders(self) -> DataFrame:
        customer = self.read("customer").select("c_custkey", "c_nationkey")
        placed = self.read("orders").join(customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
        return self._with_region(placed, "c_nationkey").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "n_regionkey AS store_id",
            f"cast({SOLD_ON} AS timestamp_ntz) + make_dt_interval(0, 0, 0, o_orderkey * 37 % 86400) AS order_timestamp",
            "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'placed' WHEN 'P' THEN 'cancelled' END "
            "AS order_status",
            "CASE WHEN o_orderstatus = 'F' THEN cast(10 + o_orderkey % 36 AS int) END AS delivery_time_mins",
            f"{SOLD_ON} AS order_date",
        )

    def order_items(self) -> DataFrame:
        return self._priced_lines("F").selectExpr(
            f"{LINE_KEY} AS order_item_id",
            "l_orderkey AS order_id",
            "sku_id",
            "cast(l_quantity AS int) AS quantity",
            f"cast((mrp_cents * (100 - {DISCOUNT}) div 100) * 0.01BD AS decimal(10,2)) AS unit_price_at_sale",
            f"{DISCOUNT} AS discount_pct",
            "cast(NULL AS bigint) AS batch_id",
        )

    def purchase_orders(self) -> DataFrame:
        supplier = self.read("supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
        lines = self._priced_lines("O").join(supplier, "l_suppkey")
        return self._with_region(lines, "s_nationkey").selectExpr(
            f"l_suppkey * 128 + {SUPPLY_DAY} AS batch_id",
            f"concat('PO-', {LINE_KEY}) AS po_line_id",
            "n_regionkey AS store_id",
            "sku_id",
            "cast(l_suppkey AS int) AS supplier_id",
            f"date_sub({DUE}, {LATE} + cast(2 + l_suppkey % 6 AS int)) AS order_date",
            f"date_sub({DUE}, {LATE}) AS expected_delivery_date",
            f"CASE WHEN (l_orderkey + l_partkey) % 40 <> 0 THEN {DUE} END AS actual_delivery_date",
            "cast(1 + floor(l_quantity / 3) AS int) AS quantity_ordered",
            SUPPLY_COST,
        )

    def product_suppliers(self) -> DataFrame:
        links = self._priced_lines("O").selectExpr("sku_id", "cast(l_suppkey AS int) AS supplier_id", SUPPLY_COST)
        return links.distinct()


def load_tables(spark: SparkSession, folder: str) -> LazyTables:
    """The base tables of a benchmark folder."""
    source = _Benchmark(spark, folder)
    names = "products dark_stores suppliers product_suppliers customers orders order_items purchase_orders"
    return LazyTables({name: getattr(source, name) for name in names.split()})


def product_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A raw product feed in paise with padded names: one row per line item, so full of copies.

    ``feed_row`` is the place of the product in the feed; copies share it.
    """
    copies = read_benchmark(spark, folder, "lineitem").selectExpr("l_partkey AS p_partkey")
    return copies.join(read_benchmark(spark, folder, "part"), "p_partkey").selectExpr(
        "p_partkey AS feed_row",
        "p_type AS Category",
        "concat(' ', p_name, ' ') AS name",
        "cast(round(p_retailprice * 100) AS int) AS mrp",
        "p_size * 10 AS weightInGms",
    )
