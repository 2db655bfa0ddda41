"""Run registered queries beside their SQL: ``python tests/oracle_check.py sf0.01 [key ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = "region nation customer supplier part orders lineitem documents benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(row) -> tuple:
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


def compare(spark_df, con, sql: str) -> tuple[int, str]:
    """Number of rows and a description of the first difference ('' when equal)."""
    columns = sorted(spark_df.columns)
    got = sorted((normal(r) for r in spark_df.select(*columns).collect()), key=repr)
    listed = ", ".join(f'"{c}"' for c in columns)
    have = con.execute(f"DESCRIBE {sql}").fetchall()
    if sorted(r[0] for r in have) != columns:
        return len(got), f"columns {columns} against {sorted(r[0] for r in have)}"
    want = sorted((normal(r) for r in con.execute(f"SELECT {listed} FROM ({sql})").fetchall()), key=repr)
    if len(got) != len(want):
        return len(got), f"{len(got)} rows against {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return len(got), f"{columns}\n   spark {g}\n   sql   {w}"
    return len(got), ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    folder = f"/root/testdata/{sys.argv[1]}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sqls = connect(folder), e.queries(), e.oracle_sql()
    bad = 0
    for key in sys.argv[2:] or queries:
        began = time.time()
        try:
            df = queries[key](spark, folder)
            if key in sqls:
                rows, problem = compare(df, con, sqls[key])
            else:
                rows, problem = df.count(), ""
        except Exception as error:
            rows, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {key:30s} {rows:8d} rows {time.time() - began:6.2f} s {problem}", flush=True)
    print("failed:", bad)
