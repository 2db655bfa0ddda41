"""The allocation against a plain loop over the written rules."""

import random
from datetime import date, datetime, timedelta

import pytest

from shelfflow.operators import fifo
from shelfflow.schemas import Params
from shelfflow.operators import facts

DAY0 = date(2025, 1, 1)


def on(n):
    return DAY0 + timedelta(days=n)


def at(n, second=0):
    return datetime(2025, 1, 1) + timedelta(days=n, seconds=second)


def greedy(items, orders, po, life, use_expiry=True):
    """order_item_id -> (batch or None, number of batches), straight from the rules."""
    order = {o["order_id"]: o for o in orders}
    result = {}
    keys = {(order[i["order_id"]]["store_id"], i["sku_id"]) for i in items}
    for store, sku in keys:
        lots = {}
        for line in po:
            if (line["store_id"], line["sku_id"]) == (store, sku) and line["actual_delivery_date"] is not None:
                k = (line["actual_delivery_date"], line["batch_id"])
                lots[k] = lots.get(k, 0) + line["quantity_ordered"]
        sales = [
            i for i in items
            if (order[i["order_id"]]["store_id"], i["sku_id"]) == (store, sku)
            and order[i["order_id"]]["order_status"] != "cancelled"
        ]
        for i in sorted(sales, key=lambda i: (order[i["order_id"]]["order_timestamp"], i["order_item_id"])):
            today = order[i["order_id"]]["order_timestamp"].date()
            need, parts = i["quantity"], []
            for delivered, batch in sorted(lots):
                fresh = not use_expiry or delivered + timedelta(days=life[sku]) >= today
                if delivered <= today and fresh and need and lots[delivered, batch]:
                    take = min(need, lots[delivered, batch])
                    lots[delivered, batch] -= take
                    need -= take
                    parts.append((take, batch))
            if need:
                result[i["order_item_id"]] = (None, 0)
            else:
                best = max(take for take, _ in parts)
                result[i["order_item_id"]] = (next(b for take, b in parts if take == best), len(parts))
    return result


def allocate(frame, items, orders, po, life, use_expiry=True):
    products = [{"sku_id": k, "shelf_life_days": v} for k, v in life.items()]
    return fifo.fifo_allocate(
        frame("order_items", items),
        frame("orders", orders),
        frame("purchase_orders", po),
        frame("products", products),
        use_expiry,
    )


def outcome(df):
    return {r.order_item_id: (r.batch_id, r.batches_used) for r in df.collect()}


def random_case(seed, n_items=160, n_lots=40, days=25):
    rng = random.Random(seed)
    life = {1: rng.randrange(0, 4), 2: rng.randrange(2, 9), 3: 400}
    orders = [
        {
            "order_id": n,
            "store_id": rng.choice([1, 1, 2]),
            "order_timestamp": at(rng.randrange(days), rng.choice([0, 5, 5, rng.randrange(86400)])),
            "order_status": rng.choice(["delivered", "delivered", "placed", "cancelled"]),
        }
        for n in range(n_items // 2)
    ]
    items = [
        {"order_item_id": n, "order_id": rng.randrange(len(orders)), "sku_id": rng.choice([1, 2, 3]), "quantity": rng.randrange(1, 6)}
        for n in rng.sample(range(1000), n_items)
    ]
    po = [
        {
            "batch_id": 100 * day + supplier,
            "store_id": rng.choice([1, 2]),
            "sku_id": rng.choice([1, 2, 3]),
            "actual_delivery_date": on(day) if rng.random() < 0.9 else None,
            "quantity_ordered": rng.randrange(1, 14),
        }
        for day, supplier in ((rng.randrange(-4, days), rng.randrange(3)) for _ in range(n_lots))
    ]
    return items, orders, po, life


@pytest.mark.parametrize("use_expiry", [True, False])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_plain_loop(frame, seed, use_expiry):
    case = random_case(seed)
    got, want = outcome(allocate(frame, *case, use_expiry)), greedy(*case, use_expiry)
    assert got == want
    assert any(b is None for b, _ in want.values()) and any(n > 1 for _, n in want.values())


def one_sku(frame, sales, lots, life=5):
    """Outcome for one store and SKU: sales are (day, quantity), lots (batch, day, quantity)."""
    orders = [
        {"order_id": n, "store_id": 1, "order_timestamp": at(day, n), "order_status": "delivered"}
        for n, (day, _) in enumerate(sales)
    ]
    items = [{"order_item_id": n, "order_id": n, "sku_id": 1, "quantity": q} for n, (_, q) in enumerate(sales)]
    po = [
        {"batch_id": b, "store_id": 1, "sku_id": 1, "actual_delivery_date": None if day is None else on(day), "quantity_ordered": q}
        for b, day, q in lots
    ]
    return outcome(allocate(frame, items, orders, po, {1: life}))


def test_sells_on_the_expiry_day_but_not_after(frame):
    assert one_sku(frame, [(3, 1), (4, 1)], [(7, 0, 5)], life=3) == {0: (7, 1), 1: (None, 0)}


def test_unmet_item_keeps_what_it_took(frame):
    assert one_sku(frame, [(0, 5), (0, 1), (1, 2)], [(7, 0, 3), (8, 1, 2)]) == {0: (None, 0), 1: (None, 0), 2: (8, 1)}


def test_equal_shares_go_to_the_older_batch(frame):
    assert one_sku(frame, [(2, 4)], [(9, 0, 2), (8, 1, 2)]) == {0: (9, 2)}


def test_larger_share_wins(frame):
    assert one_sku(frame, [(2, 5)], [(9, 0, 2), (8, 1, 9)]) == {0: (8, 2)}


def test_lines_of_a_batch_count_as_one_lot(frame):
    assert one_sku(frame, [(2, 5)], [(9, 0, 3), (9, 0, 1), (8, 1, 3)]) == {0: (9, 2)}


def test_undelivered_batch_never_opens(frame):
    assert one_sku(frame, [(2, 1)], [(9, None, 3)]) == {0: (None, 0)}


def test_stock_that_arrives_later_does_not_count(frame):
    assert one_sku(frame, [(0, 1), (2, 1)], [(9, 1, 3)]) == {0: (None, 0), 1: (9, 1)}


def test_one_hot_product(frame):
    """A third of all items in one second of one store and SKU."""
    rng = random.Random(9)
    items, orders, po, life = random_case(4)
    orders.append({"order_id": 999, "store_id": 1, "order_timestamp": at(10), "order_status": "delivered"})
    items += [{"order_item_id": 2000 + n, "order_id": 999, "sku_id": 3, "quantity": rng.randrange(1, 4)} for n in range(300)]
    po.append({"batch_id": 77, "store_id": 1, "sku_id": 3, "actual_delivery_date": on(9), "quantity_ordered": 400})
    assert outcome(allocate(frame, items, orders, po, life)) == greedy(items, orders, po, life)


def test_summary_and_anomalies(frame):
    case = random_case(5)
    allocation = allocate(frame, *case).cache()
    want = greedy(*case)
    met = [n for b, n in want.values() if b is not None]
    row = fifo.fifo_summary(allocation).first()
    assert (row.total_items, row.assigned_items, row.split_items) == (len(want), len(met), sum(n > 1 for n in met))
    assert row.success_pct == pytest.approx(100 * len(met) / len(want), abs=0.006)
    missed = {r.order_item_id for r in fifo.fifo_anomalies(allocation).collect()}
    assert missed == {i for i, (b, _) in want.items() if b is None}
    assert row.assigned_items + row.anomaly_items == row.total_items


def test_summary_of_nothing(frame):
    row = fifo.fifo_summary(allocate(frame, [], [], [], {1: 3})).first()
    assert (row.total_items, row.success_pct, row.split_pct, row.anomaly_pct) == (0, 0.0, 0.0, 0.0)


def test_no_batch_gives_more_than_it_has(frame):
    items, orders, po, life = random_case(6)
    allocation = allocate(frame, items, orders, po, life)
    tagged = fifo.with_batches(frame("order_items", items), allocation)
    assert tagged.count() == len(items)
    single = allocation.filter("batches_used = 1").groupBy("store_id", "sku_id", "batch_id").sum("quantity").collect()
    bought = {}
    for line in po:
        k = (line["store_id"], line["sku_id"], line["batch_id"])
        bought[k] = bought.get(k, 0) + line["quantity_ordered"]
    assert all(r[3] <= bought[r[0], r[1], r[2]] for r in single)


def test_allocation_feeds_the_wastage_log(shop):
    allocation = fifo.fifo_allocate(shop["order_items"], shop["orders"], shop["purchase_orders"], shop["products"])
    direct = facts.wastage_log(shop, allocation, Params())
    joined = facts.wastage_log(shop, fifo.with_batches(shop["order_items"], allocation), Params())
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, joined.collect()))


def test_all_items_at_midnight(frame):
    """Time stamps that carry only a day put all items of a day into one second."""
    rng = random.Random(11)
    orders = [{"order_id": n, "store_id": 1, "order_timestamp": at(n % 4), "order_status": "delivered"} for n in range(40)]
    items = [
        {"order_item_id": n, "order_id": rng.randrange(40), "sku_id": rng.choice([1, 2]), "quantity": rng.randrange(1, 6)}
        for n in range(400)
    ]
    po = [
        {"batch_id": b, "store_id": 1, "sku_id": rng.choice([1, 2]), "actual_delivery_date": on(b % 4), "quantity_ordered": rng.randrange(20, 90)}
        for b in range(20)
    ]
    case = (items, orders, po, {1: 3, 2: 9})
    assert outcome(allocate(frame, *case, True)) == greedy(*case, True)


def test_days_are_summed_by_one_window(spark):
    """Lots that arrive on a sale day count from that day on, those that expire on it no more; no sum per day runs before the window."""
    demand = spark.createDataFrame([(1, 1, on(2), 5), (1, 1, on(4), 7)], "store_id int, sku_id int, day date, units long")
    lots = spark.createDataFrame(
        [(1, 1, on(2), 8, 3, on(4)), (1, 1, on(2), 9, 4, on(4)), (1, 1, on(4), 8, 6, None), (1, 1, on(5), 8, 9, None)],
        "store_id int, sku_id int, day date, batch_id long, units long, gone date",
    )
    timeline = fifo._timeline(demand, lots)
    got = [(r.day, r.arrived, r.expired, r.demanded, r.demand) for r in timeline.orderBy("day").collect()]
    assert got == [(on(2), 7, 0, 0, 5), (on(4), 13, 7, 5, 7)]
    plan = timeline._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") == 1 and "Aggregate" not in plan
