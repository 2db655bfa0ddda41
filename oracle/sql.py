"""DuckDB SQL per query: shared CTEs (prefix ``inv_``) plus one select each.

The statements follow the plain definitions (unpartitioned windows, joins that repeat rows, a
recursive walk for the allocation), not the shape of the Spark plans they check.
"""

from __future__ import annotations

import re

START, END, DAYS = "DATE '2025-01-01'", "DATE '2025-03-31'", 90
OPENING, SPLIT, QUANTILE = "DATE '2024-12-12'", "DATE '2025-03-01'", 0.68


def ratio(num: str, den: str, scale: int) -> str:
    """round(num / den, scale) for whole numbers, half away from zero; NULL on zero."""
    n, d = f"({num})::HUGEINT", f"({den})::HUGEINT"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE (CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END"
        f" * ((abs({n}) * {2 * 10**scale} + abs({d})) // (2 * abs({d}))))::DOUBLE / {10**scale}::DOUBLE END)"
    )


def fraction(num: str, den: str) -> str:
    return f"(({num})::DOUBLE / nullif(({den})::DOUBLE, 0))"


def std_pop(n: str, total: str, squares: str) -> str:
    return f"(sqrt((({n})::HUGEINT * ({squares})::HUGEINT - ({total})::HUGEINT * ({total})::HUGEINT)::DOUBLE) / ({n}))"


def half_up(x: str, scale: int) -> str:
    return f"(floor({x} * {10**scale}::DOUBLE + 0.5) / {10**scale}::DOUBLE)"


def cents(x: str) -> str:
    return f"CAST(({x}) * 100 AS HUGEINT)"


CTES: dict[str, str] = {
    "inv_parts": """
        SELECT p_partkey AS sku_id, p_name AS sku_name, p_type AS category,
               CAST(round(p_retailprice * 100) AS BIGINT) AS c, p_size AS size
        FROM part""",
    "inv_products": """
        SELECT sku_id, sku_name, category, CAST(c AS DECIMAL(18,2)) / 100 AS mrp_raw,
               CAST(c * 0.01 AS DECIMAL(10,2)) AS mrp,
               CAST(((c * (55 + sku_id % 21)) // 100) * 0.01 AS DECIMAL(10,2)) AS unit_cost,
               size <= 10 AS is_perishable, size AS shelf_life_days, 1 + size % 10 AS demand_weight
        FROM inv_parts""",
    "inv_stores": """
        SELECT r_regionkey AS store_id, r_name AS store_name, 'Zone ' || (r_regionkey % 4) AS zone,
               2000 + 617 * r_regionkey AS capacity_units
        FROM region""",
    "inv_suppliers": """
        SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_regionkey AS store_id, 2 + s_suppkey % 6 AS lead
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "inv_customers": "SELECT c_custkey AS customer_id, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "inv_orders": """
        SELECT o_orderkey AS order_id, customer_id, n_regionkey AS store_id,
               CAST(DATE '2025-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 90 AS INTEGER)
                    AS DATE) AS order_date,
               (o_orderkey * 37) % 86400 AS second,
               CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'placed' WHEN 'P' THEN 'cancelled' END AS status,
               CASE WHEN o_orderstatus = 'F' THEN 10 + o_orderkey % 36 END AS minutes
        FROM orders JOIN inv_customers ON o_custkey = customer_id""",
    "inv_items": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS order_item_id,
               l_orderkey AS order_id, sku_id, CAST(l_quantity AS BIGINT) AS quantity,
               CAST(((c * (100 - CAST(round(l_discount * 100) AS BIGINT))) // 100) * 0.01 AS DECIMAL(10,2)) AS price
        FROM lineitem JOIN inv_parts ON l_partkey = sku_id
        WHERE l_linestatus = 'F'""",
    "inv_lines": """
        SELECT *, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 120 AS k,
               CASE WHEN (7 * l_orderkey + 3 * l_partkey + l_linenumber) % 20 < 3 THEN 1 + l_orderkey % 3 ELSE 0 END AS late
        FROM lineitem JOIN inv_parts ON l_partkey = sku_id JOIN inv_suppliers ON l_suppkey = supplier_id
        WHERE l_linestatus = 'O'""",
    "inv_po": """
        SELECT supplier_id * 128 + k AS batch_id, concat_ws('-', 'PO', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS po_line_id,
               store_id, sku_id, supplier_id,
               DATE '2024-12-12' + CAST(k - late - lead AS INTEGER) AS order_date,
               DATE '2024-12-12' + CAST(k - late AS INTEGER) AS expected,
               CASE WHEN (l_orderkey + l_partkey) % 40 <> 0 THEN DATE '2024-12-12' + CAST(k AS INTEGER) END AS actual,
               1 + CAST(l_quantity AS BIGINT) // 3 AS quantity,
               CAST(((c * (52 + l_suppkey % 21)) // 100) * 0.01 AS DECIMAL(10,2)) AS cost
        FROM inv_lines""",
    "inv_product_suppliers": "SELECT DISTINCT sku_id, supplier_id FROM inv_po",
    "inv_sold": """
        SELECT i.*, o.store_id, o.order_date, o.status FROM inv_items i JOIN inv_orders o USING (order_id)
        WHERE o.status = 'delivered'""",
    "inv_daily_sales": """
        SELECT s.store_id, s.store_name, x.order_date, p.sku_id, p.sku_name, p.category,
               sum(x.quantity) AS total_quantity_sold, sum(x.quantity * x.price) AS total_revenue,
               sum(x.quantity * (x.price - p.unit_cost)) AS total_profit
        FROM inv_sold x JOIN inv_stores s USING (store_id) JOIN inv_products p USING (sku_id)
        GROUP BY ALL""",
    "inv_moves": """
        SELECT store_id, sku_id, order_date AS d, sum(quantity) AS sold, sum(quantity * price) AS sold_value,
               0 AS bought, CAST(0 AS DECIMAL(38,2)) AS bought_value
        FROM inv_sold GROUP BY ALL
        UNION ALL
        SELECT store_id, sku_id, actual, 0, CAST(0 AS DECIMAL(38,2)), sum(quantity), sum(quantity * cost)
        FROM inv_po WHERE actual IS NOT NULL GROUP BY ALL""",
    "inv_movement": """
        SELECT m.store_id, s.store_name, d AS movement_date, m.sku_id, p.sku_name, sum(sold) AS sold,
               round(sum(sold_value), 2) AS sold_value, sum(bought) AS bought, round(sum(bought_value), 2) AS bought_value
        FROM inv_moves m JOIN inv_stores s USING (store_id) JOIN inv_products p USING (sku_id) GROUP BY ALL""",
    "inv_running": """
        SELECT *, sum(bought - sold) OVER w AS closing, sum(bought) OVER w AS cum_bought, sum(sold) OVER w AS cum_sold
        FROM inv_movement
        WINDOW w AS (PARTITION BY store_id, sku_id ORDER BY movement_date ROWS UNBOUNDED PRECEDING)""",
    "inv_snapshot": f"""
        SELECT *, closing + sold - bought AS opening FROM inv_running WHERE movement_date >= {START}""",
    "inv_stockouts": "SELECT * FROM inv_running WHERE closing <= 0",
    "inv_velocity": f"""
        SELECT *, ntile(10) OVER (PARTITION BY store_id ORDER BY units DESC, sku_id) AS decile FROM (
            SELECT store_id, sku_id, sum(sold) AS units,
                   sum(CASE WHEN opening + bought > 0 THEN 1 ELSE 0 END) AS days_available
            FROM inv_snapshot WHERE movement_date BETWEEN {START} AND {END} GROUP BY ALL)""",
    "inv_sales_velocity": f"""
        SELECT v.store_id, s.store_name, v.sku_id, p.sku_name, p.category, units AS total_units_sold, days_available,
               units::DOUBLE / {DAYS} AS sales_velocity,
               {fraction("units", "days_available")} AS adjusted_velocity_days_available,
               CASE WHEN decile <= 3 THEN 'Fast-moving' WHEN decile <= 7 THEN 'Medium-moving' ELSE 'Slow-moving' END AS classification
        FROM inv_velocity v JOIN inv_stores s USING (store_id) JOIN inv_products p USING (sku_id)""",
    "inv_turnover": f"""
        SELECT store_id, store_name, sku_id, sku_name, sum(sold) AS units, sum(opening + closing) AS stock, count(*) AS n
        FROM inv_snapshot WHERE movement_date BETWEEN {START} AND {END} GROUP BY ALL""",
    "inv_turnover_avg": f"SELECT *, {ratio('stock', '2 * n', 9)} * 1e9 AS average FROM inv_turnover",
    # The allocation, walked day by day along one unit sequence per store and SKU.
    "inv_fifo_sales": """
        SELECT order_item_id, order_id, store_id, sku_id, order_date AS d, second, quantity
        FROM inv_items JOIN inv_orders USING (order_id) WHERE status <> 'cancelled' AND quantity > 0""",
    "inv_fifo_lots": """
        SELECT *, sum(units) OVER (PARTITION BY store_id, sku_id ORDER BY d, batch_id ROWS UNBOUNDED PRECEDING) AS hi
        FROM (SELECT store_id, sku_id, actual AS d, batch_id, any_value(shelf_life_days) AS life, sum(quantity) AS units
              FROM inv_po JOIN inv_products USING (sku_id) WHERE actual IS NOT NULL GROUP BY ALL)""",
}


def _fifo(name: str, expired: str) -> None:
    CTES[f"inv_{name}_days"] = f"""
        SELECT s.store_id, s.sku_id, s.d, s.demand,
               row_number() OVER (PARTITION BY s.store_id, s.sku_id ORDER BY s.d) AS i,
               coalesce(sum(l.units), 0) AS arrived, {expired} AS expired
        FROM (SELECT store_id, sku_id, d, sum(quantity) AS demand FROM inv_fifo_sales GROUP BY ALL) s
        LEFT JOIN inv_fifo_lots l ON l.store_id = s.store_id AND l.sku_id = s.sku_id AND l.d <= s.d
        GROUP BY s.store_id, s.sku_id, s.d, s.demand"""
    CTES[f"inv_{name}_walk"] = f"""
        SELECT store_id, sku_id, d, i, arrived, greatest(0, expired) AS first_unit,
               least(arrived, greatest(0, expired) + demand) AS last_unit
        FROM inv_{name}_days WHERE i = 1
        UNION ALL
        SELECT n.store_id, n.sku_id, n.d, n.i, n.arrived, greatest(w.last_unit, n.expired),
               least(n.arrived, greatest(w.last_unit, n.expired) + n.demand)
        FROM inv_{name}_walk w JOIN inv_{name}_days n
          ON n.store_id = w.store_id AND n.sku_id = w.sku_id AND n.i = w.i + 1"""
    CTES[f"inv_{name}_spans"] = f"""
        SELECT s.*, arrived, first_unit + sum(quantity) OVER (
                 PARTITION BY s.store_id, s.sku_id, s.d ORDER BY second, order_item_id, quantity ROWS UNBOUNDED PRECEDING) AS hi
        FROM inv_fifo_sales s JOIN inv_{name}_walk w ON s.store_id = w.store_id AND s.sku_id = w.sku_id AND s.d = w.d"""
    CTES[f"inv_{name}_parts"] = f"""
        SELECT s.order_item_id, s.hi, l.batch_id,
               count(*) OVER (PARTITION BY s.order_item_id, s.hi) AS n,
               row_number() OVER (PARTITION BY s.order_item_id, s.hi
                   ORDER BY least(l.hi, s.hi) - greatest(l.hi - l.units, s.hi - s.quantity) DESC, l.hi) AS choice
        FROM inv_{name}_spans s JOIN inv_fifo_lots l
          ON l.store_id = s.store_id AND l.sku_id = s.sku_id AND l.hi > s.hi - s.quantity AND l.hi - l.units < s.hi
        WHERE s.hi <= s.arrived"""
    CTES[f"inv_{name}"] = f"""
        SELECT s.order_item_id, s.order_id, s.store_id, s.sku_id, s.d AS order_date, s.quantity, p.batch_id,
               coalesce(p.n, 0) AS batches_used
        FROM inv_{name}_spans s LEFT JOIN inv_{name}_parts p
          ON p.order_item_id = s.order_item_id AND p.hi = s.hi AND p.choice = 1"""


_fifo("fifo", "coalesce(sum(CASE WHEN l.d + CAST(l.life AS INTEGER) < s.d THEN l.units END), 0)")
_fifo("fifo_plain", "0")

CTES |= {
    "inv_wastage": f"""
        SELECT b.batch_id, b.store_id, s.store_name, b.sku_id, p.sku_name, b.actual,
               b.actual + CAST(p.shelf_life_days AS INTEGER) AS expiry_date, b.bought, coalesce(x.sold, 0) AS sold,
               b.bought - coalesce(x.sold, 0) AS wasted
        FROM (SELECT batch_id, store_id, sku_id, actual, sum(quantity) AS bought FROM inv_po
              WHERE actual IS NOT NULL GROUP BY ALL) b
        JOIN inv_products p USING (sku_id) JOIN inv_stores s USING (store_id)
        LEFT JOIN (SELECT f.batch_id, f.store_id, f.sku_id, sum(f.quantity) AS sold
                   FROM inv_fifo f JOIN inv_orders o USING (order_id) WHERE o.status = 'delivered' GROUP BY ALL) x
          ON x.batch_id = b.batch_id AND x.store_id = b.store_id AND x.sku_id = b.sku_id
        WHERE b.actual + CAST(p.shelf_life_days AS INTEGER) <= {END} AND b.bought - coalesce(x.sold, 0) > 0""",
    "inv_leadtime": f"""
        SELECT store_id, sku_id, supplier_id, count(*) AS total_orders,
               {fraction("sum(lead)", "count(lead)")} AS avg_lead_time_days,
               {std_pop("count(lead)", "sum(lead)", "sum(lead * lead)")} AS lead_time_stddev_days
        FROM (SELECT *, date_diff('day', order_date, actual) AS lead FROM inv_po WHERE actual IS NOT NULL)
        GROUP BY ALL""",
    "inv_store_orders": f"""
        SELECT o.store_id, count(DISTINCT order_id) AS total_orders,
               count(DISTINCT CASE WHEN status = 'cancelled' THEN order_id END) AS cancelled_orders,
               count(DISTINCT CASE WHEN status = 'delivered' THEN order_id END) AS delivered_orders,
               sum(CASE WHEN status = 'delivered' THEN price * quantity ELSE 0 END) AS total_revenue,
               sum(CASE WHEN status = 'delivered' THEN (price - unit_cost) * quantity ELSE 0 END) AS gross_profit,
               {ratio("100 * count(DISTINCT CASE WHEN status = 'cancelled' THEN order_id END)", "count(DISTINCT order_id)", 2)}
                   AS cancellation_rate_pct,
               {ratio("sum(minutes)", "count(minutes)", 1)} AS avg_delivery_time_mins
        FROM inv_orders o JOIN inv_items i USING (order_id) JOIN inv_products p USING (sku_id)
        GROUP BY o.store_id""",
    "inv_store_restocks": f"""
        SELECT store_id, count(po_line_id) AS total_restocks,
               sum(CASE WHEN actual <= expected THEN 1 ELSE 0 END) AS on_time_restocks,
               {ratio("100 * sum(CASE WHEN actual <= expected THEN 1 ELSE 0 END)", "count(po_line_id)", 2)} AS on_time_restock_pct
        FROM inv_po GROUP BY store_id""",
    "inv_store_wastage": f"""
        SELECT po.store_id, {ratio("100 * coalesce(sum(w.wasted), 0)", "sum(po.quantity)", 2)} AS wastage_pct,
               coalesce(sum(w.wasted * p.unit_cost), 0) AS wastage_value
        FROM inv_po po JOIN inv_products p USING (sku_id)
        LEFT JOIN inv_wastage w ON po.batch_id = w.batch_id AND po.sku_id = w.sku_id
        GROUP BY po.store_id""",
    "inv_store_velocity": f"""
        SELECT store_id, {ratio("sum(total_units_sold)", str(DAYS), 2)} AS store_sales_velocity
        FROM inv_sales_velocity GROUP BY store_id""",
    "inv_store_top": """
        SELECT store_id, category AS top_performing_category FROM (
            SELECT store_id, category,
                   row_number() OVER (PARTITION BY store_id ORDER BY sum(total_units_sold) DESC, category) AS rn
            FROM inv_sales_velocity GROUP BY store_id, category) WHERE rn = 1""",
    "inv_store_turnover": f"""
        SELECT store_id, {ratio("sum(units) * 1000000000", "sum(average)", 2)} AS store_inventory_turnover_ratio,
               CASE WHEN sum(average) <> 0 THEN {ratio(f"sum(average) * {DAYS}", "sum(units) * 1000000000", 1)} END
                   AS store_days_of_inventory_on_hand
        FROM inv_turnover_avg GROUP BY store_id""",
    "inv_store_stockouts": f"""
        SELECT v.store_id, {ratio("100 * count(*)", f"any_value(k.skus) * {DAYS}", 2)} AS stockout_rate_pct
        FROM inv_stockouts v
        JOIN (SELECT store_id, count(DISTINCT sku_id) AS skus FROM inv_movement GROUP BY store_id) k USING (store_id)
        GROUP BY v.store_id""",
    "inv_features": f"""
        SELECT *, lag(sold_qty, 1) OVER w AS sales_lag_1, lag(sold_qty, 7) OVER w AS sales_lag_7,
               lag(sold_qty, 28) OVER w AS sales_lag_28,
               {fraction("sum(sold_qty) OVER r", "count(sold_qty) OVER r")} AS rolling_7day_avg,
               CASE WHEN count(sold_qty) OVER r > 0 THEN
                 {std_pop("count(sold_qty) OVER r", "sum(sold_qty) OVER r", "sum(sold_qty * sold_qty) OVER r")} END
                   AS rolling_7day_stddev
        FROM inv_base
        WINDOW w AS (PARTITION BY store_id, sku_id ORDER BY snapshot_date),
               r AS (PARTITION BY store_id, sku_id ORDER BY snapshot_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "inv_grid_days": f"SELECT CAST(unnest(generate_series({START}, {END}, INTERVAL 1 DAY)) AS DATE) AS snapshot_date",
    "inv_base": """
        SELECT s.store_id, p.sku_id, g.snapshot_date, coalesce(x.q, 0) AS sold_qty
        FROM inv_stores s CROSS JOIN inv_products p CROSS JOIN inv_grid_days g
        LEFT JOIN (SELECT store_id, sku_id, order_date, sum(quantity) AS q FROM inv_sold GROUP BY ALL) x
          ON x.store_id = s.store_id AND x.sku_id = p.sku_id AND x.order_date = g.snapshot_date""",
    "inv_base_observed": f"""
        SELECT s.store_id, p.sku_id, g.d AS snapshot_date, coalesce(x.sold, 0) AS sold_qty
        FROM inv_stores s CROSS JOIN inv_products p
        CROSS JOIN (SELECT DISTINCT movement_date AS d FROM inv_snapshot WHERE movement_date >= {START}) g
        LEFT JOIN inv_snapshot x ON x.store_id = s.store_id AND x.sku_id = p.sku_id AND x.movement_date = g.d""",
    "inv_feature_rows": """
        SELECT f.store_id, f.sku_id, f.snapshot_date, 1 + dayofweek(f.snapshot_date) AS day_of_week,
               CASE WHEN dayofweek(f.snapshot_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
               day(f.snapshot_date) AS day_of_month, sales_lag_1, sales_lag_7, sales_lag_28, rolling_7day_avg,
               rolling_7day_stddev, p.category, s.zone, s.capacity_units, p.unit_cost, p.mrp, sold_qty AS target_sold_qty
        FROM inv_features f JOIN inv_stores s USING (store_id) JOIN inv_products p USING (sku_id)""",
    "inv_clean": "SELECT * FROM inv_feature_rows WHERE sales_lag_28 IS NOT NULL AND rolling_7day_avg IS NOT NULL",
    "inv_forecasts": f"""
        SELECT store_id, sku_id, snapshot_date, target_sold_qty, CAST((rolling_7day_avg + sales_lag_28) / 2 AS DECIMAL(10,4)) AS predicted_demand,
               sales_lag_1, sales_lag_7, rolling_7day_avg
        FROM inv_clean WHERE snapshot_date >= {SPLIT}""",
    "inv_sigma": f"""
        SELECT store_id, sku_id, snapshot_date, target_sold_qty, predicted_demand,
               coalesce({std_pop("count(e) OVER w", "sum(e) OVER w", "sum(e * e) OVER w")} / 10000.0::DOUBLE, 0) AS sigma
        FROM (SELECT *, CAST((target_sold_qty - predicted_demand) * 10000 AS BIGINT) AS e FROM inv_forecasts)
        WINDOW w AS (PARTITION BY store_id, sku_id)""",
    "inv_blended": f"""
        SELECT store_id, sku_id,
               coalesce({fraction("sum(CAST(round(avg_lead_time_days * total_orders) AS BIGINT))", "sum(total_orders)")}, 1) AS lead_time_avg,
               coalesce({fraction("sum(CAST(lead_time_stddev_days * total_orders AS DECIMAL(28,9)))", "sum(total_orders)")}, 0)
                   AS lead_time_stddev
        FROM inv_leadtime GROUP BY store_id, sku_id""",
    "inv_reorder": """
        SELECT *, ceil(safety) AS safety_stock, ceil(predicted_demand::DOUBLE * lead_time_avg + safety) AS reorder_point FROM (
            SELECT *, z_score * sqrt(lead_time_avg * (sigma * sigma)
                     + (predicted_demand::DOUBLE * predicted_demand::DOUBLE) * (lead_time_stddev * lead_time_stddev)) AS safety
            FROM (SELECT f.*, v.classification AS velocity_class,
                         CASE v.classification WHEN 'Fast-moving' THEN 2.33::DOUBLE WHEN 'Medium-moving' THEN 1.65::DOUBLE
                              WHEN 'Slow-moving' THEN 1.28::DOUBLE END AS z_score,
                         coalesce(l.lead_time_avg, 1::DOUBLE) AS lead_time_avg,
                         coalesce(l.lead_time_stddev, 0::DOUBLE) AS lead_time_stddev
                  FROM inv_sigma f
                  LEFT JOIN inv_sales_velocity v ON v.store_id = f.store_id AND v.sku_id = f.sku_id
                  LEFT JOIN inv_blended l ON l.store_id = f.store_id AND l.sku_id = f.sku_id))""",
    "inv_errors": f"""
        SELECT {fraction("sum(abs(target_sold_qty)::DECIMAL(28,10))", "count(*)")} AS naive_zero_mae,
               {fraction("sum(abs(target_sold_qty - coalesce(sales_lag_1, 0))::DECIMAL(28,10))", "count(*)")} AS naive_lag_1_mae,
               {fraction("sum(abs(target_sold_qty - coalesce(sales_lag_7, 0))::DECIMAL(28,10))", "count(*)")} AS naive_lag_7_mae,
               {fraction("sum(abs(target_sold_qty - coalesce(rolling_7day_avg, 0))::DECIMAL(28,10))", "count(*)")} AS naive_rolling_mae,
               {fraction("sum(abs(target_sold_qty - predicted_demand)::DECIMAL(28,10))", "count(*)")} AS model_mae
        FROM inv_forecasts""",
    "inv_days": """
        SELECT snapshot_date, sum(count(*)) OVER (ORDER BY snapshot_date) AS through, sum(count(*)) OVER () AS n
        FROM inv_clean GROUP BY snapshot_date""",
    "inv_split": f"""
        SELECT min(snapshot_date) AS split_date FROM inv_days WHERE through > CAST(round_even({QUANTILE}::DOUBLE * (n - 1)::DOUBLE, 0) AS BIGINT)""",
    "inv_feed": """
        SELECT p_partkey AS feed_row, trim(p_type) AS category, trim(' ' || p_name || ' ') AS sku_name,
               CAST(CAST(round(p_retailprice * 100) AS BIGINT) * 0.01 AS DECIMAL(12,2)) AS mrp, p_size * 10 AS unit_weight_grams
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
}


BOOST_ROUNDS, BOOST_DEPTH, STEP = 2, 2, 0.05
# One and two less the variance power, as the doubles they are.
P1, P2 = f"'{1 - 1.9!r}'::DOUBLE", f"'{2 - 1.9!r}'::DOUBLE"
NUMERIC = (
    "store_id sku_id day_of_week is_weekend day_of_month sales_lag_1 sales_lag_7 sales_lag_28 rolling_7day_avg rolling_7day_stddev "
    "capacity_units unit_cost mrp"
).split()


def boosted() -> dict[str, str]:
    """Two rounds of boosted trees of depth two on the rows before the split date, scored on all rows; ``inv_bt_end`` has the scores."""

    def labels(column: str) -> str:
        return f"""SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS i
            FROM inv_clean WHERE snapshot_date < {SPLIT} GROUP BY {column}"""

    ctes = {
        "inv_bt_category": labels("category"),
        "inv_bt_zone": labels("zone"),
        "inv_bt_labels": """SELECT 13 AS f, unnest(range(0, count(*) + 1))::DOUBLE AS upper FROM inv_bt_category
            UNION ALL SELECT 14, unnest(range(0, count(*) + 1))::DOUBLE FROM inv_bt_zone""",
        "inv_bt_rows": f"""
            SELECT row_number() OVER () AS id, c.store_id, c.sku_id, c.snapshot_date, c.target_sold_qty, c.snapshot_date < {SPLIT} AS train,
                   target_sold_qty::DOUBLE AS y,
                   [{", ".join(f"coalesce({c}::DOUBLE, 0)" for c in NUMERIC)},
                    coalesce(k.i, (SELECT count(*) FROM inv_bt_category))::DOUBLE,
                    coalesce(z.i, (SELECT count(*) FROM inv_bt_zone))::DOUBLE] AS x
            FROM inv_clean c LEFT JOIN inv_bt_category k ON k.category = c.category LEFT JOIN inv_bt_zone z ON z.zone = c.zone""",
        "inv_bt_long": "SELECT id, unnest(x) AS value, unnest(range(0, 15)) AS f FROM inv_bt_rows WHERE train",
        "inv_bt_placed": """
            SELECT f, value, sum(n) OVER (PARTITION BY f ORDER BY value) - n AS below, sum(n) OVER (PARTITION BY f) AS total,
                   row_number() OVER (PARTITION BY f ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY f) AS distinct_values
            FROM (SELECT f, value, count(*) AS n FROM inv_bt_long WHERE f < 13 GROUP BY ALL)""",
        "inv_bt_bins": """
            SELECT f, value, max(value) OVER (PARTITION BY f, CASE WHEN distinct_values <= 256 THEN i ELSE below * 256 // total END) AS upper
            FROM inv_bt_placed""",
        "inv_bt_codes": """
            SELECT id, f, upper FROM inv_bt_long JOIN inv_bt_bins USING (f, value)
            UNION ALL SELECT id, f, value FROM inv_bt_long WHERE f >= 13""",
        "inv_bt_bits": "SELECT least(36, 62 - length(bin(count(*)))) AS bits FROM inv_bt_rows WHERE train",
        "inv_bt_score0": """
            SELECT id, train, y, x, (SELECT ln(greatest(sum(y) / count(*), 1e-6)) FROM inv_bt_rows WHERE train) AS score FROM inv_bt_rows""",
        "inv_bt_bound1": f"""SELECT max(y * exp({P1} * score)) AS a, max(exp({P2} * score)) AS b
            FROM inv_bt_score0 WHERE train""",
    }
    for r in range(1, BOOST_ROUNDS + 1):
        unit = f"(SELECT 2::DOUBLE ** (ceil(log2(2 * (a + b))) - bits) FROM inv_bt_bound{r}, inv_bt_bits)"
        low, high = f"exp({P1} * score)", f"exp({P2} * score)"
        ctes[f"inv_bt_unit{r}"] = f"SELECT {unit} AS u"
        ctes[f"inv_bt_grad{r}"] = f"""
            SELECT id, round_even(({high} - y * {low}) / u, 0)::BIGINT AS g,
                   round_even(({P2} * {high} - {P1} * y * {low}) / u, 0)::BIGINT AS h
            FROM inv_bt_score{r - 1}, inv_bt_unit{r} WHERE train"""
        ctes[f"inv_bt_node{r}0"] = f"SELECT id, x, 0 AS node, 0::DOUBLE AS leaf FROM inv_bt_score{r - 1}"
        for level in range(BOOST_DEPTH):
            k = f"{r}{level}"
            ctes[f"inv_bt_hist{k}"] = f"""
                SELECT node, f, upper, sum(g) AS g, sum(h) AS h FROM inv_bt_codes JOIN inv_bt_grad{r} USING (id)
                JOIN inv_bt_node{k} USING (id) WHERE node >= {2**level - 1} GROUP BY ALL"""
            ctes[f"inv_bt_all{k}"] = f"SELECT node, sum(g) AS tg, sum(h) AS th FROM inv_bt_hist{k} WHERE f = 0 GROUP BY node"
            ctes[f"inv_bt_pos{k}"] = f"""
                SELECT node, f, upper, g, h, row_number() OVER (PARTITION BY node, f ORDER BY upper) AS pos FROM inv_bt_hist{k} WHERE f < 13
                UNION ALL
                SELECT node, f, upper, g, h, row_number() OVER (PARTITION BY node, f ORDER BY (g::DOUBLE * u) / (h::DOUBLE * u + 1), upper)
                FROM (SELECT a.node, l.f, l.upper, coalesce(h.g, 0) AS g, coalesce(h.h, 0) AS h FROM inv_bt_all{k} a CROSS JOIN inv_bt_labels l
                      LEFT JOIN inv_bt_hist{k} h ON h.node = a.node AND h.f = l.f AND h.upper = l.upper), inv_bt_unit{r}"""
            ctes[f"inv_bt_cuts{k}"] = f"""
                SELECT node, f, upper, pos, lg::DOUBLE * u AS lg, lh::DOUBLE * u AS lh, (tg - lg)::DOUBLE * u AS rg, (th - lh)::DOUBLE * u AS rh,
                       tg::DOUBLE * u AS tg, th::DOUBLE * u AS th
                FROM (SELECT *, sum(g) OVER w AS lg, sum(h) OVER w AS lh FROM inv_bt_pos{k}
                      WINDOW w AS (PARTITION BY node, f ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
                JOIN inv_bt_all{k} USING (node), inv_bt_unit{r}"""
            ctes[f"inv_bt_best{k}"] = f"""
                SELECT *, (SELECT list(upper) FROM inv_bt_pos{k} p WHERE p.node = b.node AND p.f = b.f AND p.pos <= b.pos) AS listed
                FROM (SELECT *, lg * lg / (lh + 1) + rg * rg / (rh + 1) - tg * tg / (th + 1) AS gain FROM inv_bt_cuts{k}
                      WHERE lh >= 1 AND rh >= 1) b
                WHERE gain > 1e-6
                QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, pos) = 1"""
            goes_left = "CASE WHEN b.f < 13 THEN n.x[b.f + 1] <= b.upper ELSE list_contains(b.listed, n.x[b.f + 1]) END"
            ctes[f"inv_bt_node{r}{level + 1}"] = f"""
                SELECT n.id, n.x, CASE WHEN b.node IS NULL THEN n.node WHEN {goes_left} THEN 2 * n.node + 1 ELSE 2 * n.node + 2 END AS node,
                       CASE WHEN b.node IS NULL THEN n.leaf WHEN {goes_left} THEN {STEP} * (-lg / (lh + 1)) ELSE {STEP} * (-rg / (rh + 1)) END
                           AS leaf
                FROM inv_bt_node{k} n LEFT JOIN inv_bt_best{k} b ON b.node = n.node"""
        last = f"inv_bt_node{r}{BOOST_DEPTH}"
        ctes[f"inv_bt_score{r}"] = f"""
            SELECT s.id, s.train, s.y, s.x, s.score + n.leaf AS score FROM inv_bt_score{r - 1} s JOIN {last} n USING (id)"""
        ctes[f"inv_bt_bound{r + 1}"] = f"""
            SELECT a * exp(greatest(0, (SELECT max({P1} * leaf) FROM {last} JOIN inv_bt_rows USING (id) WHERE train))) AS a,
                   b * exp(greatest(0, (SELECT max({P2} * leaf) FROM {last} JOIN inv_bt_rows USING (id) WHERE train))) AS b
            FROM (SELECT max(y * {low}) AS a, max({high}) AS b FROM inv_bt_score{r - 1} WHERE train)"""
    ctes["inv_bt_end"] = f"""
        SELECT store_id, sku_id, snapshot_date, target_sold_qty, CAST(exp(score) AS DECIMAL(10,4)) AS predicted_demand, sales_lag_1,
               sales_lag_7, rolling_7day_avg
        FROM inv_bt_score{BOOST_ROUNDS} JOIN inv_bt_rows USING (id) JOIN inv_clean USING (store_id, sku_id, snapshot_date, target_sold_qty)
        WHERE NOT inv_bt_score{BOOST_ROUNDS}.train"""
    return ctes


CTES |= boosted()
# The chain from forecasts to reorder points, on the trees' forecasts.
for _name in ("inv_sigma", "inv_reorder"):
    CTES[f"{_name}_bt"] = CTES[_name].replace("inv_forecasts", "inv_bt_end").replace("inv_sigma ", "inv_sigma_bt ")

FEATURES = (
    "store_id i, sku_id i, snapshot_date s, day_of_week i, is_weekend i, day_of_month i, sales_lag_1 i, sales_lag_7 i, "
    "sales_lag_28 i, rolling_7day_avg f, rolling_7day_stddev f, category s, zone s, capacity_units i, unit_cost f, mrp f, "
    "target_sold_qty i"
)
ALLOCATION = "order_item_id s, order_id i, store_id i, sku_id i, order_date s, quantity i, batch_id i, batches_used i"
CAPPED = FEATURES.replace("capacity_units i, ", "")
DAILY_SALES = (
    "store_id i, store_name s, order_date s, sku_id i, sku_name s, category s, total_quantity_sold i, total_revenue f, "
    "total_profit f"
)
REORDER = (
    "store_id i, sku_id i, snapshot_date s, target_sold_qty i, predicted_demand f, sigma f, velocity_class s, z_score f, "
    "lead_time_avg f, lead_time_stddev f, safety_stock i, reorder_point i"
)
TYPES = {"i": "BIGINT", "f": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN"}

# key -> (output columns with their type, select)
QUERIES: dict[str, tuple[str, str]] = {
    "daily_sales": (
        "store_id i, store_name s, order_date s, sku_id i, sku_name s, category s, total_quantity_sold i, total_revenue f, "
        "total_profit f",
        "SELECT * FROM inv_daily_sales",
    ),
    "daily_movement": (
        "store_id i, store_name s, movement_date s, sku_id i, sku_name s, total_quantity_sold i, total_sold_value f, "
        "total_quantity_purchased i, total_purchased_value f",
        """SELECT *, sold AS total_quantity_sold, sold_value AS total_sold_value, bought AS total_quantity_purchased,
                  bought_value AS total_purchased_value FROM inv_movement""",
    ),
    "inventory_snapshot": (
        "store_id i, store_name s, sku_id i, sku_name s, movement_date s, opening_stock i, total_quantity_purchased i, "
        "total_quantity_sold i, closing_stock i",
        """SELECT *, opening AS opening_stock, bought AS total_quantity_purchased, sold AS total_quantity_sold,
                  closing AS closing_stock FROM inv_snapshot""",
    ),
    "wastage_log": (
        "batch_id i, store_id i, sku_id i, store_name s, sku_name s, actual_delivery_date s, expiry_date s, "
        "quantity_purchased i, quantity_sold i, quantity_wasted i",
        """SELECT *, actual AS actual_delivery_date, bought AS quantity_purchased, sold AS quantity_sold,
                  wasted AS quantity_wasted FROM inv_wastage""",
    ),
    "abc_classification": (
        "sku_id i, sku_name s, total_revenue f, sku_revenue_pct f, cumulative_revenue_pct f, sku_pct f, cumulative_sku_pct f, "
        "abc_class s",
        f"""SELECT *, CASE WHEN cumulative_revenue_pct <= 70 THEN 'A' WHEN cumulative_revenue_pct <= 90 THEN 'B' ELSE 'C' END AS abc_class
            FROM (SELECT sku_id, sku_name, total_revenue,
                    {ratio("100 * r", "sum(r) OVER ()", 2)} AS sku_revenue_pct,
                    {ratio("100 * sum(r) OVER (ORDER BY r DESC)", "sum(r) OVER ()", 2)} AS cumulative_revenue_pct,
                    {ratio("100", "count(*) OVER ()", 4)} AS sku_pct,
                    {ratio("100 * count(*) OVER (ORDER BY r DESC)", "count(*) OVER ()", 4)} AS cumulative_sku_pct
                  FROM (SELECT sku_id, sku_name, sum(total_revenue) AS total_revenue, {cents("sum(total_revenue)")} AS r
                        FROM inv_daily_sales GROUP BY sku_id, sku_name))""",
    ),
    "sales_velocity": (
        "store_id i, store_name s, sku_id i, sku_name s, category s, total_units_sold i, days_available i, sales_velocity f, "
        "adjusted_velocity_days_available f, classification s",
        "SELECT * FROM inv_sales_velocity",
    ),
    "wastage_info": (
        "store_id i, store_name s, sku_id i, sku_name s, category s, total_quantity_purchased i, total_quantity_sold i, "
        "total_quantity_wasted i, wastage_pct f, unit_cost f, wastage_value_cost f, wastage_value_mrp_equivalent f",
        f"""SELECT w.store_id, w.store_name, w.sku_id, w.sku_name, p.category, sum(w.bought) AS total_quantity_purchased,
                  sum(w.sold) AS total_quantity_sold, sum(w.wasted) AS total_quantity_wasted,
                  {ratio("100 * sum(w.wasted)", "sum(w.bought)", 2)} AS wastage_pct, p.unit_cost,
                  sum(w.wasted) * p.unit_cost AS wastage_value_cost, sum(w.wasted) * p.mrp AS wastage_value_mrp_equivalent
            FROM inv_wastage w JOIN inv_products p USING (sku_id)
            GROUP BY w.store_id, w.store_name, w.sku_id, w.sku_name, p.category, p.unit_cost, p.mrp""",
    ),
    "inventory_turnover": (
        "store_id i, store_name s, sku_id i, sku_name s, total_units_sold i, avg_inventory f, inventory_turnover_ratio f, "
        "days_of_inventory_on_hand f",
        f"""SELECT *, units AS total_units_sold, {fraction("stock", "2 * n")} AS avg_inventory,
                  {ratio("units * 2 * n", "stock", 2)} AS inventory_turnover_ratio,
                  CASE WHEN stock <> 0 THEN {ratio(f"{DAYS} * stock", "units * 2 * n", 1)} END AS days_of_inventory_on_hand
            FROM inv_turnover""",
    ),
    "stock_out_incidents": (
        "store_id i, store_name s, sku_id i, sku_name s, stock_out_date s, cumulative_purchased i, cumulative_sold i, closing_stock i",
        """SELECT *, movement_date AS stock_out_date, cum_bought AS cumulative_purchased, cum_sold AS cumulative_sold,
                  closing AS closing_stock FROM inv_stockouts""",
    ),
    "store_movement": (
        "store_id i, store_name s, movement_date s, sales_value f, purchase_value f, inventory_value f, stockout_flag i",
        """SELECT m.store_id, m.store_name, m.movement_date, sum(m.sold_value) AS sales_value,
                  sum(m.bought_value) AS purchase_value, sum(coalesce(i.closing, 0) * p.unit_cost) AS inventory_value,
                  max(CASE WHEN i.closing = 0 THEN 1 ELSE 0 END) AS stockout_flag
           FROM inv_movement m LEFT JOIN inv_snapshot i
             ON i.store_id = m.store_id AND i.sku_id = m.sku_id AND i.movement_date = m.movement_date
           JOIN inv_products p ON p.sku_id = m.sku_id GROUP BY m.store_id, m.store_name, m.movement_date""",
    ),
    "supplier_reliability": (
        "supplier_id i, supplier_name s, total_orders i, avg_promised_lead_time_days f, avg_actual_lead_time_days f, "
        "lead_time_stddev_days f, avg_lead_time_deviation_days f, on_time_pct f, avg_delay_days_when_late f",
        f"""SELECT supplier_id, supplier_name, count(*) AS total_orders,
                  {ratio("sum(e)", "count(e)", 2)} AS avg_promised_lead_time_days,
                  {ratio("sum(a)", "count(a)", 2)} AS avg_actual_lead_time_days,
                  {half_up(std_pop("count(a)", "sum(a)", "sum(a * a)"), 2)} AS lead_time_stddev_days,
                  {ratio("sum(a) * count(e) - sum(e) * count(a)", "count(a) * count(e)", 2)} AS avg_lead_time_deviation_days,
                  {ratio("100 * sum(CASE WHEN actual <= expected THEN 1 ELSE 0 END)", "count(*)", 2)} AS on_time_pct,
                  {ratio("sum(CASE WHEN actual > expected THEN a - e END)", "count(CASE WHEN actual > expected THEN 1 END)", 2)}
                      AS avg_delay_days_when_late
            FROM (SELECT *, date_diff('day', order_date, expected) AS e, date_diff('day', order_date, actual) AS a FROM inv_po)
            JOIN inv_suppliers s USING (supplier_id) GROUP BY supplier_id, supplier_name""",
    ),
    "store_sku_supplier_leadtime": (
        "store_id i, sku_id i, supplier_id i, total_orders i, avg_lead_time_days f, lead_time_stddev_days f",
        "SELECT * FROM inv_leadtime",
    ),
    "store_orders": (
        "store_id i, total_orders i, cancelled_orders i, delivered_orders i, total_revenue f, gross_profit f, "
        "cancellation_rate_pct f, avg_delivery_time_mins f",
        "SELECT * FROM inv_store_orders",
    ),
    "store_restocks": ("store_id i, total_restocks i, on_time_restocks i, on_time_restock_pct f", "SELECT * FROM inv_store_restocks"),
    "store_wastage": ("store_id i, wastage_pct f, wastage_value f", "SELECT * FROM inv_store_wastage"),
    "store_velocity": ("store_id i, store_sales_velocity f", "SELECT * FROM inv_store_velocity"),
    "store_top_category": ("store_id i, top_performing_category s", "SELECT * FROM inv_store_top"),
    "store_turnover": (
        "store_id i, store_inventory_turnover_ratio f, store_days_of_inventory_on_hand f",
        "SELECT * FROM inv_store_turnover",
    ),
    "store_stockouts": ("store_id i, stockout_rate_pct f", "SELECT * FROM inv_store_stockouts"),
    "store_performances": (
        "store_id i, store_name s, zone s, total_orders i, delivered_orders i, cancelled_orders i, total_revenue f, "
        "gross_profit f, cancellation_rate_pct f, avg_delivery_time_mins f, on_time_restock_pct f, wastage_pct f, "
        "wastage_value f, store_sales_velocity f, top_performing_category s, store_inventory_turnover_ratio f, "
        "store_days_of_inventory_on_hand f, stockout_rate_pct f",
        """SELECT * FROM inv_stores JOIN inv_store_orders USING (store_id) LEFT JOIN inv_store_restocks USING (store_id)
           LEFT JOIN inv_store_wastage USING (store_id) LEFT JOIN inv_store_velocity USING (store_id)
           LEFT JOIN inv_store_top USING (store_id) LEFT JOIN inv_store_turnover USING (store_id)
           LEFT JOIN inv_store_stockouts USING (store_id)""",
    ),
    "network_summary": (
        "total_network_revenue f, total_network_profit f, network_stockout_rate_pct f, network_wastage_pct f, "
        "network_inventory_turnover_ratio f, network_days_of_inventory_on_hand f",
        f"""SELECT * FROM
            (SELECT sum(CASE WHEN status = 'delivered' THEN price * quantity ELSE 0 END) AS total_network_revenue,
                    sum(CASE WHEN status = 'delivered' THEN (price - unit_cost) * quantity ELSE 0 END) AS total_network_profit
             FROM inv_orders JOIN inv_items USING (order_id) JOIN inv_products USING (sku_id)),
            (SELECT {ratio("100 * (SELECT count(*) FROM inv_stockouts)",
                    f"(SELECT count(DISTINCT (store_id, sku_id)) FROM inv_movement) * {DAYS}", 2)} AS network_stockout_rate_pct),
            (SELECT {ratio("100 * coalesce(sum(w.wasted), 0)", "sum(po.quantity)", 2)} AS network_wastage_pct
             FROM inv_po po LEFT JOIN inv_wastage w ON po.batch_id = w.batch_id AND po.sku_id = w.sku_id),
            (SELECT {ratio("sum(units) * 1000000000", "sum(average)", 2)} AS network_inventory_turnover_ratio,
                    CASE WHEN sum(average) <> 0 THEN {ratio(f"sum(average) * {DAYS}", "sum(units) * 1000000000", 1)} END
                        AS network_days_of_inventory_on_hand FROM inv_turnover_avg)""",
    ),
    "forecast_sigma": (
        "store_id i, sku_id i, snapshot_date s, target_sold_qty i, predicted_demand f, sigma f",
        "SELECT * FROM inv_sigma",
    ),
    "blended_leadtime": ("store_id i, sku_id i, lead_time_avg f, lead_time_stddev f", "SELECT * FROM inv_blended"),
    "reorder_points": (
        REORDER,
        "SELECT * FROM inv_reorder",
    ),
    "reorder_flags": (
        "store_id i, sku_id i, snapshot_date s, reorder_point i, current_stock i, needs_reorder b",
        """SELECT r.store_id, r.sku_id, r.snapshot_date, r.reorder_point, coalesce(c.closing, 0) AS current_stock,
                  coalesce(c.closing, 0) <= r.reorder_point AS needs_reorder
           FROM inv_reorder r LEFT JOIN (
               SELECT store_id, sku_id, closing FROM inv_snapshot
               QUALIFY row_number() OVER (PARTITION BY store_id, sku_id ORDER BY movement_date DESC) = 1) c
             ON c.store_id = r.store_id AND c.sku_id = r.sku_id""",
    ),
    "fifo_batch": (ALLOCATION, "SELECT * FROM inv_fifo"),
    "fifo_noexpiry": (ALLOCATION, "SELECT * FROM inv_fifo_plain"),
    "fifo_anomalies": (
        "order_item_id s, order_id i, store_id i, sku_id i, order_date s, quantity i",
        "SELECT * FROM inv_fifo WHERE batch_id IS NULL",
    ),
    "fifo_summary": (
        "total_items i, assigned_items i, split_items i, anomaly_items i, success_pct f, split_pct f, anomaly_pct f",
        f"""SELECT *, coalesce({ratio("100 * assigned_items", "total_items", 2)}, 0) AS success_pct,
                  coalesce({ratio("100 * split_items", "assigned_items", 2)}, 0) AS split_pct,
                  coalesce({ratio("100 * anomaly_items", "total_items", 2)}, 0) AS anomaly_pct
            FROM (SELECT count(*) AS total_items, count(batch_id) AS assigned_items,
                         count(CASE WHEN batches_used > 1 THEN 1 END) AS split_items,
                         count(*) - count(batch_id) AS anomaly_items FROM inv_fifo)""",
    ),
    "prep_products": (
        "sku_id i, sku_name s, category s, mrp f, unit_weight_grams i, is_perishable b, shelf_life_min_days i, "
        "shelf_life_max_days i, demand_weight i",
        """SELECT row_number() OVER (ORDER BY min(feed_row)) AS sku_id, sku_name, category, mrp, unit_weight_grams,
                  category IN ('SMALL', 'PROMO') AS is_perishable,
                  CASE category WHEN 'SMALL' THEN 2 WHEN 'PROMO' THEN 30 WHEN 'LARGE' THEN 90 ELSE 180 END AS shelf_life_min_days,
                  CASE category WHEN 'SMALL' THEN 7 WHEN 'PROMO' THEN 180 WHEN 'LARGE' THEN 270 ELSE 180 END AS shelf_life_max_days,
                  CASE category WHEN 'SMALL' THEN 10 WHEN 'PROMO' THEN 7 WHEN 'LARGE' THEN 5 ELSE 1 END AS demand_weight
           FROM inv_feed GROUP BY category, sku_name, mrp, unit_weight_grams""",
    ),
    "prep_store_weights": (
        "store_id i, demand_weight f",
        f"""SELECT store_id, {ratio('''6 * CASE zone WHEN 'Zone 0' THEN 130 WHEN 'Zone 3' THEN 90 ELSE 100 END
                 + 4 * CASE WHEN i < n // 3 THEN 130 WHEN i < 2 * n // 3 THEN 100 ELSE 80 END''', "1000", 2)} AS demand_weight
            FROM (SELECT *, row_number() OVER (ORDER BY capacity_units DESC, store_id) - 1 AS i, count(*) OVER () AS n FROM inv_stores)""",
    ),
    "prep_batch_keys": (
        "po_line_id s, store_id i, supplier_id i, actual_delivery_date s, batch_id i",
        """SELECT po_line_id, store_id, supplier_id, actual AS actual_delivery_date,
                  dense_rank() OVER (ORDER BY store_id, supplier_id, actual) AS batch_id
           FROM inv_po WHERE actual IS NOT NULL""",
    ),
    "prep_order_date": ("order_id i, order_date s", "SELECT order_id, order_date FROM inv_orders"),
    "prep_opening_batches": (
        "po_line_id s, store_id i, supplier_id i, batch_id i",
        f"""SELECT po_line_id, store_id, supplier_id, dense_rank() OVER (ORDER BY store_id, supplier_id) AS batch_id
            FROM inv_po WHERE actual <= {OPENING}""",
    ),
    "features_capped": (CAPPED, "SELECT * FROM inv_clean WHERE snapshot_date <= DATE '2025-03-20'"),
    "load_products": (
        "sku_id i, sku_name s, category s, mrp f, unit_cost f, unit_weight_grams i, is_perishable b, shelf_life_days i, "
        "demand_weight i",
        "SELECT p.*, 10 * r.size AS unit_weight_grams FROM inv_products p JOIN inv_parts r ON r.sku_id = p.sku_id",
    ),
    "load_dark_stores": (
        "store_id i, store_name s, city s, zone s, locality s, latitude f, longitude f, capacity_units i, opened_date s",
        """SELECT *, 'TEST' AS city, store_name AS locality, 0 AS latitude, 0 AS longitude,
                  DATE '2022-01-01' + CAST(store_id AS INTEGER) AS opened_date FROM inv_stores""",
    ),
    "load_suppliers": (
        "supplier_id i, supplier_name s, city s, avg_lead_time_days i",
        """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, n_name AS city, lead AS avg_lead_time_days
           FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN inv_suppliers ON supplier_id = s_suppkey""",
    ),
    "load_latin1": (
        "supplier_id i, supplier_name s, city s, avg_lead_time_days i",
        """SELECT s_suppkey AS supplier_id, 'Épicerie ' || s_name AS supplier_name, n_name AS city, lead AS avg_lead_time_days
           FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN inv_suppliers ON supplier_id = s_suppkey""",
    ),
    "load_product_suppliers": (
        "sku_id i, supplier_id i, cost_price f",
        "SELECT DISTINCT sku_id, supplier_id, cost AS cost_price FROM inv_po",
    ),
    "write_enforced": (
        "sku_id i, supplier_id i, cost_price f",
        "SELECT DISTINCT sku_id, supplier_id, cost AS cost_price FROM inv_po",
    ),
    "load_rejects": (
        "po_line_id s, reason s",
        "SELECT po_line_id, CASE WHEN sku_id % 7 = 0 THEN 'quantity_ordered is not int' END AS reason FROM inv_po",
    ),
    "catalog_stock_outs": (
        "store_id i, store_name s, sku_id i, sku_name s, stock_out_date s, cumulative_purchased i, cumulative_sold i, closing_stock i",
        """SELECT *, movement_date AS stock_out_date, cum_bought AS cumulative_purchased, cum_sold AS cumulative_sold,
                  closing AS closing_stock FROM inv_stockouts""",
    ),
    "load_customers": (
        "customer_id i, customer_name s, customer_email s, customer_phone s, zone s, locality s, signup_date s",
        """SELECT c_custkey AS customer_id, c_name AS customer_name, NULL AS customer_email, NULL AS customer_phone,
                  'Zone ' || (nation.n_regionkey % 4) AS zone, n_name AS locality,
                  DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup_date
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN inv_customers ON customer_id = c_custkey""",
    ),
    "load_orders": (
        "order_id i, customer_id i, store_id i, order_timestamp s, order_status s, delivery_time_mins i, order_date s",
        """SELECT *, order_date + to_seconds(CAST(second AS BIGINT)) AS order_timestamp, status AS order_status,
                  minutes AS delivery_time_mins FROM inv_orders""",
    ),
    "load_order_items": (
        "order_item_id i, order_id i, sku_id i, quantity i, unit_price_at_sale f, discount_pct i, batch_id i",
        """SELECT l_orderkey AS order_item_id, l_orderkey AS order_id, sku_id, CAST(l_quantity AS BIGINT) AS quantity,
                  ((c * (100 - CAST(round(l_discount * 100) AS BIGINT))) // 100) / 100.0 AS unit_price_at_sale,
                  CAST(round(l_discount * 100) AS BIGINT) AS discount_pct, NULL AS batch_id
           FROM lineitem JOIN inv_parts ON l_partkey = sku_id WHERE l_linestatus = 'F'""",
    ),
    "load_purchase_orders": (
        "batch_id i, po_line_id s, store_id i, sku_id i, supplier_id i, order_date s, expected_delivery_date s, "
        "actual_delivery_date s, quantity_ordered i, cost_price f",
        """SELECT *, expected AS expected_delivery_date, actual AS actual_delivery_date, quantity AS quantity_ordered,
                  cost AS cost_price FROM inv_po""",
    ),
    "load_tsv": (
        "batch_id i, po_line_id s, store_id i, sku_id i, supplier_id i, order_date s, expected_delivery_date s, "
        "actual_delivery_date s, quantity_ordered i, cost_price f",
        """SELECT *, expected AS expected_delivery_date, actual AS actual_delivery_date, quantity AS quantity_ordered,
                  cost AS cost_price FROM inv_po""",
    ),
    "load_forecasts": (
        "store_id i, sku_id i, snapshot_date s, target_sold_qty i, predicted_demand f",
        "SELECT store_id, sku_id, snapshot_date, target_sold_qty, predicted_demand FROM inv_forecasts",
    ),
    "write_quoted_csv": (DAILY_SALES, "SELECT * FROM inv_daily_sales"),
    "rebuild_fact": (DAILY_SALES, "SELECT * FROM inv_daily_sales"),
    "read_pruned": ("order_id i, units i", "SELECT order_id, sum(quantity) AS units FROM inv_items GROUP BY order_id"),
    "published_view": (
        "order_date s, units i, revenue f",
        """SELECT order_date, sum(total_quantity_sold) AS units, sum(total_revenue) AS revenue
           FROM inv_daily_sales GROUP BY order_date""",
    ),
    "dq_unique_facts": (
        "table_name s, key_value s, occurrences i",
        """SELECT * FROM (
             SELECT 'fact_daily_sales' AS table_name, concat_ws('/', store_id, sku_id, order_date) AS key_value, count(*) AS occurrences
             FROM inv_daily_sales GROUP BY ALL
             UNION ALL SELECT 'fact_daily_movement', concat_ws('/', movement_date, store_id, sku_id), count(*) FROM inv_movement GROUP BY ALL
             UNION ALL SELECT 'fact_wastage_log', concat_ws('/', batch_id, store_id, sku_id), count(*) FROM inv_wastage GROUP BY ALL)
           WHERE occurrences > 1""",
    ),
    "dq_unique_repeated": (
        "table_name s, key_value s, occurrences i",
        """SELECT * FROM (
             SELECT 'order_items' AS table_name, order_id::VARCHAR AS key_value, count(*) AS occurrences FROM inv_items GROUP BY ALL
             UNION ALL SELECT 'purchase_orders', batch_id || '/' || coalesce(actual::VARCHAR, 'NULL'), count(*) FROM inv_po GROUP BY ALL)
           WHERE occurrences > 1""",
    ),
    "dq_required": (
        "table_name s, column s, nulls i",
        "\nUNION ALL ".join(
            f"""SELECT '{name}' AS table_name, '{column}' AS "column", count(*) - count({column}) AS nulls FROM {table}"""
            for name, table, columns in [
                ("products", "inv_products", "sku_id sku_name"),
                ("dark_stores", "inv_stores", "store_id"),
                ("suppliers", "inv_suppliers", "supplier_id"),
                ("customers", "inv_customers", "customer_id"),
                ("orders", "inv_orders", "order_id"),
                ("order_items", "inv_items", "order_item_id"),
                ("purchase_orders", "inv_po", "po_line_id"),
                ("product_suppliers", "inv_product_suppliers", "sku_id supplier_id"),
                ("fact_daily_sales", "inv_daily_sales", "store_id sku_id order_date"),
                ("fact_daily_movement", "inv_movement", "movement_date store_id sku_id"),
                ("fact_wastage_log", "inv_wastage", "batch_id store_id sku_id"),
            ]
            for column in columns.split()
        ),
    ),
    "prep_daily_receipts": (
        "store_id i, sku_id i, actual_delivery_date s, quantity_received i",
        """SELECT store_id, sku_id, actual AS actual_delivery_date, sum(quantity) AS quantity_received
           FROM inv_po WHERE actual IS NOT NULL GROUP BY ALL""",
    ),
    "prep_opening_stock": (
        "store_id i, sku_id i, opening_stock i",
        f"""SELECT s.store_id, p.sku_id, coalesce(sum(po.quantity), 0) AS opening_stock
            FROM inv_stores s CROSS JOIN inv_products p
            LEFT JOIN inv_po po ON po.store_id = s.store_id AND po.sku_id = p.sku_id AND po.actual = {OPENING}
            GROUP BY ALL""",
    ),
    "prep_supplier_multiplicity": (
        "suppliers i, skus i",
        "SELECT n AS suppliers, count(*) AS skus FROM (SELECT sku_id, count(*) AS n FROM inv_product_suppliers GROUP BY 1) GROUP BY 1",
    ),
    "prep_expiry": (
        "po_line_id s, batch_id i, store_id i, sku_id i, actual_delivery_date s, shelf_life_days i, expiry_date s",
        """SELECT *, actual AS actual_delivery_date, actual + CAST(shelf_life_days AS INTEGER) AS expiry_date
           FROM inv_po LEFT JOIN inv_products USING (sku_id)""",
    ),
    "date_spine": ("snapshot_date s, orders i",
        """SELECT snapshot_date, count(order_id) AS orders FROM inv_grid_days LEFT JOIN inv_orders ON order_date = snapshot_date
           GROUP BY snapshot_date"""),
    "forecast_base": ("store_id i, sku_id i, snapshot_date s, sold_qty i", "SELECT * FROM inv_base"),
    "forecast_base_observed": ("store_id i, sku_id i, snapshot_date s, sold_qty i", "SELECT * FROM inv_base_observed"),
    "forecast_features": (FEATURES, "SELECT * FROM inv_feature_rows"),
    "forecast_features_clean": (FEATURES, "SELECT * FROM inv_clean"),
    "split_fixed": (
        "part s, store_id i, sku_id i, snapshot_date s, target_sold_qty i",
        f"SELECT CASE WHEN snapshot_date < {SPLIT} THEN 'train' ELSE 'test' END AS part, * FROM inv_clean",
    ),
    "split_quantile": (
        "part s, store_id i, sku_id i, snapshot_date s, target_sold_qty i",
        """SELECT CASE WHEN snapshot_date <= (SELECT split_date FROM inv_split) THEN 'train' ELSE 'test' END AS part, *
           FROM inv_clean""",
    ),
    "split_summary": (
        "part s, rows i, days i, first_date s, last_date s",
        """SELECT CASE WHEN snapshot_date <= (SELECT split_date FROM inv_split) THEN 'train' ELSE 'test' END AS part,
                  count(*) AS rows, count(DISTINCT snapshot_date) AS days, min(snapshot_date) AS first_date,
                  max(snapshot_date) AS last_date
           FROM inv_clean GROUP BY 1""",
    ),
    "forecast_metrics": (
        "rows i, mae f, mape_nonzero_pct f",
        f"""SELECT count(*) AS rows, {fraction("sum(abs(target_sold_qty - predicted_demand)::DECIMAL(28,10))", "count(*)")} AS mae,
                  round({fraction('''sum(CASE WHEN target_sold_qty > 0 THEN
                      (abs(target_sold_qty - predicted_demand)::DOUBLE / target_sold_qty::DOUBLE)::DECIMAL(28,12) END)''',
                      "count(CASE WHEN target_sold_qty > 0 THEN 1 END)")} * 100, 6) AS mape_nonzero_pct
            FROM inv_forecasts""",
    ),
    "naive_baselines": (
        "naive_zero_mae f, naive_lag_1_mae f, naive_lag_7_mae f, naive_rolling_mae f",
        "SELECT * FROM inv_errors",
    ),
    "baseline_improvement": (
        "model_mae f, best_naive_mae f, improvement_pct f",
        """SELECT model_mae, best AS best_naive_mae, (best - model_mae) / best * 100 AS improvement_pct
           FROM (SELECT *, least(naive_zero_mae, naive_lag_1_mae, naive_lag_7_mae, naive_rolling_mae) AS best FROM inv_errors)""",
    ),
    "demand_boosting": (
        "store_id i, sku_id i, snapshot_date s, target_sold_qty i, predicted_demand f",
        "SELECT * FROM inv_bt_end",
    ),
    "forecasts_by_table": (
        "rows i, differing i",
        f"SELECT count(*) AS rows, 0 AS differing FROM inv_clean WHERE snapshot_date >= {SPLIT}",
    ),
    "reorder_points_boosted": (REORDER, "SELECT * FROM inv_reorder_bt"),
    "target_distribution": (
        "target_sold_qty i, rows i, share f, zero_pct f",
        f"""SELECT target_sold_qty, count(*) AS rows, {fraction("count(*)", "(SELECT count(*) FROM inv_forecasts)")} AS share,
                  {ratio("100 * (SELECT count(*) FROM inv_forecasts WHERE target_sold_qty = 0)",
                         "(SELECT count(*) FROM inv_forecasts)", 1)} AS zero_pct
            FROM inv_forecasts GROUP BY target_sold_qty ORDER BY rows DESC, target_sold_qty LIMIT 10""",
    ),
    "dq_unique": (
        "table_name s, key_value s, occurrences i",
        """SELECT * FROM (
             SELECT 'products' AS table_name, sku_id::VARCHAR AS key_value, count(*) AS occurrences FROM inv_products GROUP BY ALL
             UNION ALL SELECT 'dark_stores', store_id::VARCHAR, count(*) FROM inv_stores GROUP BY ALL
             UNION ALL SELECT 'suppliers', supplier_id::VARCHAR, count(*) FROM inv_suppliers GROUP BY ALL
             UNION ALL SELECT 'customers', customer_id::VARCHAR, count(*) FROM inv_customers GROUP BY ALL
             UNION ALL SELECT 'orders', order_id::VARCHAR, count(*) FROM inv_orders GROUP BY ALL
             UNION ALL SELECT 'order_items', order_item_id::VARCHAR, count(*) FROM inv_items GROUP BY ALL
             UNION ALL SELECT 'purchase_orders', po_line_id, count(*) FROM inv_po GROUP BY ALL
             UNION ALL SELECT 'product_suppliers', sku_id || '/' || supplier_id, count(*) FROM inv_product_suppliers GROUP BY ALL)
           WHERE occurrences > 1""",
    ),
    "dq_unique_lines": (
        "order_id i, sku_id i, occurrences i",
        "SELECT order_id, sku_id, count(*) AS occurrences FROM inv_items GROUP BY ALL HAVING count(*) > 1",
    ),
    "dq_orphans": (
        "child s, key_column s, parent s, orphans i",
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS child, '{k}' AS key_column, '{p}' AS parent, count(*) AS orphans FROM {ct} x
                WHERE {k} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {pt} y WHERE y.{k} = x.{k})"""
            for c, k, p, ct, pt in [
                ("product_suppliers", "sku_id", "products", "inv_product_suppliers", "inv_products"),
                ("product_suppliers", "supplier_id", "suppliers", "inv_product_suppliers", "inv_suppliers"),
                ("orders", "customer_id", "customers", "inv_orders", "inv_customers"),
                ("orders", "store_id", "dark_stores", "inv_orders", "inv_stores"),
                ("order_items", "order_id", "orders", "inv_items", "inv_orders"),
                ("order_items", "sku_id", "products", "inv_items", "inv_products"),
                ("purchase_orders", "store_id", "dark_stores", "inv_po", "inv_stores"),
                ("purchase_orders", "supplier_id", "suppliers", "inv_po", "inv_suppliers"),
                ("purchase_orders", "sku_id", "products", "inv_po", "inv_products"),
            ]
        ),
    ),
    "dq_nulls": (
        "column s, nulls i",
        """SELECT 'batch_id' AS "column", count(*) - count(batch_id) AS nulls FROM inv_po
           UNION ALL SELECT 'actual_delivery_date', count(*) - count(actual) FROM inv_po
           UNION ALL SELECT 'expected_delivery_date', count(*) - count(expected) FROM inv_po""",
    ),
    "check_sold_ratio": (
        "total_sold i, total_purchased i, ratio_pct f, in_band b",
        f"""SELECT *, ratio_pct BETWEEN 60 AND 85 AS in_band FROM (
              SELECT s AS total_sold, b AS total_purchased, {ratio("100 * s", "b", 2)} AS ratio_pct
              FROM (SELECT sum(quantity) AS s FROM inv_items), (SELECT sum(quantity) AS b FROM inv_po))""",
    ),
    "check_order_rate": (
        "delivered_orders i, customers i, orders_per_month f, in_band b",
        f"""SELECT *, orders_per_month BETWEEN 2 AND 6 AS in_band FROM (
              SELECT n AS delivered_orders, c AS customers, {ratio("n", "c * 3", 2)} AS orders_per_month
              FROM (SELECT count(*) AS n FROM inv_orders WHERE status = 'delivered'), (SELECT count(*) AS c FROM inv_customers))""",
    ),
    "check_quantity_distribution": (
        "quantity i, items i, share f",
        f"""SELECT quantity, count(*) AS items, {fraction("count(*)", "(SELECT count(*) FROM inv_items)")} AS share
            FROM inv_items GROUP BY quantity""",
    ),
    "check_delivery_summary": (
        "lines i, units i, on_time i, late i, on_time_pct f, late_pct f",
        f"""SELECT *, {ratio("100 * on_time", "on_time + late", 1)} AS on_time_pct, {ratio("100 * late", "on_time + late", 1)} AS late_pct
            FROM (SELECT count(*) AS lines, sum(quantity) AS units, count(CASE WHEN actual <= expected THEN 1 END) AS on_time,
                         count(CASE WHEN actual > expected THEN 1 END) AS late FROM inv_po)""",
    ),
    "check_negative_stock": (
        "store_id i, sku_id i, movement_date s, closing_stock i",
        "SELECT *, closing AS closing_stock FROM inv_snapshot WHERE closing < 0",
    ),
    "check_missing_opening": (
        "store_id i, sku_id i",
        f"""SELECT s.store_id, p.sku_id FROM inv_stores s CROSS JOIN inv_products p
            WHERE p.demand_weight > 0 AND NOT EXISTS (SELECT 1 FROM inv_po po
              WHERE po.store_id = s.store_id AND po.sku_id = p.sku_id AND po.actual = {OPENING})""",
    ),
    "check_category_counts": ("category s, products i", "SELECT category, count(*) AS products FROM inv_products GROUP BY category"),
    "sample_rows": (
        "order_id i, store_id i, order_date s, order_status s",
        """SELECT *, status AS order_status FROM inv_orders ORDER BY md5('42:' || order_id), order_id LIMIT 10""",
    ),
}

# Read several times by one statement.
KEPT = {"inv_clean"}

_NAME = re.compile(r"\binv_\w+")


def _needed(sql: str, seen: dict[str, None]) -> dict[str, None]:
    """CTE names in dependency order."""
    for name in dict.fromkeys(_NAME.findall(sql)):
        if name not in seen and name in CTES:
            own = CTES[name]
            # A walk refers to itself: do not follow that edge.
            _needed(re.sub(rf"\b{name}\b", "", own), seen)
            seen[name] = None
    return seen


def statement(key: str) -> str:
    columns, sql = QUERIES[key]
    select = ", ".join(
        f'CAST("{name}" AS {TYPES[kind]}) AS "{name}"' for name, kind in (c.split() for c in columns.split(", "))
    )
    names = _needed(sql, {})
    ctes = ",\n".join(f"{n} AS {'MATERIALIZED ' if n in KEPT or n.startswith('inv_bt_') else ''}({CTES[n]})" for n in names)
    return f"WITH RECURSIVE {ctes}\nSELECT {select} FROM ({sql}) AS answer"


def oracle_sql() -> dict[str, str]:
    return {key: statement(key) for key in QUERIES}
