"""The warehouse in the catalog: bucketed facts, and views that any session can query.

Each table and view of a database is written as a version, a table of its own with a number in its name; the name that users query
is a view of the catalog on the current version. Replacing that view is one step of the catalog: readers see the old version or the new
one. A build that fails before leaves names and versions as they were. ``drop_old`` removes versions no name
points to.

Facts are bucketed and sorted by store and SKU, the key of most views. Running stock, turnover, stock-outs, store
movement and the forecast grid then read them without moving a row.

Views are stored results of the library's operators, since rankings and allocation are plans that plain SQL text would
turn into windows over all rows. ``publish`` builds them anew from the tables; with a metastore they outlive the application.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfflow.operators.facts import CELL
from shelfflow.plans.warehouse import build_facts, build_views
from shelfflow.schemas import Params
from shelfflow.sources.tables import LazyTables

# Fact -> the columns its rows are bucketed by.
BUCKETED = {"fact_daily_sales": CELL, "fact_daily_movement": CELL, "fact_wastage_log": CELL}
_VERSION = re.compile(r"_v[0-9a-f]{32}$")


def write_version(df: DataFrame, database: str, name: str, keys: Sequence[str] = (), buckets: int = 0) -> str:
    """Write the frame as a new version of ``name``; returns the version's table. The name is not switched."""
    table = f"{database}.{name}_v{uuid.uuid4().hex}"
    if keys:
        # One task a bucket, so that a bucket is one sorted file.
        dealt = df.repartition(buckets, *keys)
        dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    else:
        df.hint("rebalance").write.format("parquet").saveAsTable(table)
    return table


def switch(spark: SparkSession, database: str, versions: Mapping[str, str]) -> None:
    """Point names to versions, one after another."""
    for name, table in versions.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {table}")


def current_version(spark: SparkSession, database: str, name: str) -> str:
    """The table a name points to."""
    text = spark.sql(f"SHOW CREATE TABLE {database}.{name}").first()[0]
    return f"{database}.{re.search(rf'{name}_v[0-9a-f]{{32}}', text)[0]}"


def drop_old(spark: SparkSession, database: str) -> list[str]:
    """Drop the versions of a database that no name points to, and that must not be read any longer; returns them."""
    tables = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    names = [n for n in tables if not _VERSION.search(n)]
    used = {current_version(spark, database, n).split(".")[1] for n in names}
    dropped = [n for n in tables if _VERSION.search(n) and n not in used]
    for name in dropped:
        spark.sql(f"DROP TABLE {database}.{name}")
    return dropped


def fact_tables(spark: SparkSession, database: str) -> LazyTables:
    """The facts of a database."""
    return LazyTables({name: (lambda n=name: spark.table(f"{database}.{n}")) for name in BUCKETED})


def publish(t: LazyTables, database: str, p: Params = Params(), buckets: int | None = None, views: Sequence[str] | None = None) -> LazyTables:
    """Write base tables, bucketed facts and views into the database and switch all names once everything is written.

    ``views`` chooses among the views of ``warehouse.build_views``; by default all whose tables are there. Returns what the names now hold.
    """
    spark = next(iter(t.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    versions = {name: write_version(t[name], database, name) for name in t}
    written = LazyTables({name: (lambda n=name: spark.table(versions[n])) for name in t})
    built = build_facts(written, p)
    versions |= {name: write_version(built[name], database, name, keys, buckets) for name, keys in BUCKETED.items()}
    facts = LazyTables({name: (lambda n=name: spark.table(versions[n])) for name in BUCKETED})
    offered = build_views(written, facts, p)
    chosen = views or [n for n in offered if n != "view_reorder_points" or "fact_ml_forecasts" in t]
    versions |= {name: write_version(_storable(offered[name]), database, name) for name in chosen}
    switch(spark, database, versions)
    return LazyTables({name: (lambda n=name: spark.table(f"{database}.{n}")) for name in versions})


def _storable(df: DataFrame) -> DataFrame:
    """Columns of no type can't be stored."""
    return df.withColumns({f.name: df[f.name].cast("string") for f in df.schema if isinstance(f.dataType, T.NullType)})
