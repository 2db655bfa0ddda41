"""Facts and views in the catalog."""

import uuid

import pytest

from shelfflow.operators import facts, kpis
from shelfflow.plans import catalog, warehouse


@pytest.fixture
def database(spark):
    name = f"shelf_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


VIEWS = ["view_sales_velocity", "view_stock_out_incidents", "view_supplier_reliability"]


def test_another_session_queries_the_views(shop, spark, database):
    catalog.publish(shop, database, views=VIEWS)
    direct = warehouse.build_views(shop, warehouse.build_facts(shop))
    other = spark.newSession()
    for name in VIEWS:
        assert same(direct[name], other.sql(f"SELECT * FROM {database}.{name}"))
    assert other.sql(f"SELECT count(*) FROM {database}.orders").first()[0] == 6
    assert same(facts.daily_sales(shop), other.table(f"{database}.fact_daily_sales"))


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_turnover_and_stock_outs_read_bucketed_facts_without_an_exchange(shop, spark, database):
    catalog.publish(shop, database, views=VIEWS[1:2])
    movement = catalog.fact_tables(spark, database)["fact_daily_movement"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (kpis.inventory_turnover(facts.inventory_snapshot(movement)), kpis.stock_out_incidents(movement)):
            plan = plan_of(df)
            assert "Exchange" not in plan and "Bucketed: true" in plan
        assert "Exchange" in plan_of(kpis.stock_out_incidents(facts.daily_movement(shop)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_failed_build_leaves_the_names_as_they_were(shop, spark, database, monkeypatch):
    catalog.publish(shop, database, views=VIEWS[1:2])
    held = {n: catalog.current_version(spark, database, n) for n in ("orders", "fact_daily_movement", VIEWS[1])}
    before = spark.table(f"{database}.{VIEWS[1]}").count()

    def fails(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(catalog, "build_views", fails)
    with pytest.raises(RuntimeError):
        catalog.publish(shop.replaced(orders=shop["orders"].limit(0)), database, views=VIEWS[1:2])
    assert {n: catalog.current_version(spark, database, n) for n in held} == held
    assert spark.table(f"{database}.{VIEWS[1]}").count() == before and spark.table(f"{database}.orders").count() == 6
    monkeypatch.undo()
    catalog.publish(shop, database, views=VIEWS[1:2])
    dropped = catalog.drop_old(spark, database)
    assert held["orders"].split(".")[1] in dropped and spark.table(f"{database}.orders").count() == 6
    assert catalog.drop_old(spark, database) == []
