"""Exact ratios, deviations, running totals and tiles against plain Python."""

import random
from decimal import ROUND_HALF_UP, Decimal
from statistics import pstdev, stdev

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfflow.functions.numeric import deviation, half_up, rounded_ratio
from shelfflow.functions.ordering import running_before, tile


def test_rounded_ratio_is_half_away_from_zero(spark):
    cases = [(201, 20000), (1, 8), (-1, 8), (1, 3), (-7, -2), (0, -5), (5, 0), (67, 200), (10**10 + 1, 3), (2675, 1000)]
    got = spark.createDataFrame(cases, "n bigint, d bigint").select(
        "n", "d", rounded_ratio(F.col("n") * 100, F.col("d"), 2).alias("r")
    )
    for n, d, r in got.collect():
        if d == 0:
            assert r is None
        else:
            want = (Decimal(n) * 100 / Decimal(d)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert r == float(want), (n, d)
            assert str(r) != "-0.0"


def test_deviation(spark):
    samples = {"a": [3], "b": [1, 2, 4], "c": [5, 5, 5], "d": [0, 9]}
    df = spark.createDataFrame([(k, x) for k, xs in samples.items() for x in xs], "k string, x bigint")
    x = F.col("x")
    got = df.groupBy("k").agg(
        deviation(F.count(x), F.sum(x), F.sum(x * x)).alias("p"), deviation(F.count(x), F.sum(x), F.sum(x * x), 1).alias("s")
    )
    for k, p, s in got.collect():
        assert p == pytest.approx(pstdev(samples[k]))
        assert s is None if len(samples[k]) == 1 else s == pytest.approx(stdev(samples[k]))


def test_half_up(spark):
    assert spark.range(1).select(half_up(F.lit(1.25), 1)).first()[0] == 1.3


@pytest.mark.parametrize("ranges", [1, 7, 50])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_do_not_depend_on_the_ranges(spark, descending, ranges):
    rng = random.Random(5)
    keys = rng.sample(range(0, 2**20), 300) + rng.sample(range(2**33, 2**40), 100) + [0, 2**47, 2**50]
    keys = sorted(set(keys))
    rows = [(p, k, rng.randrange(9)) for p in ("x", "y", None) for k in keys]
    df = spark.createDataFrame(rows, "p string, k bigint, m bigint")
    placed = running_before(df, [("k", descending)], ["m"], ["p"], ranges)
    got = {(r.p, r.k): (r.m_before, r.m_total) for r in placed.collect()}
    assert len(got) == len(rows)
    for p in ("x", "y", None):
        own = sorted(((k, m) for q, k, m in rows if q == p), reverse=descending)
        total, before = sum(m for _, m in own), 0
        for k, m in own:
            assert got[p, k] == (before, total)
            before += m


@pytest.mark.parametrize("ranges", [1, 50])
def test_running_totals_without_partition(spark, ranges):
    df = spark.range(1000).withColumn("m", F.lit(1).cast("long"))
    got = running_before(df, [("id", False)], ["m"], ranges=ranges)
    assert got.filter("m_before <> id OR m_total <> 1000").count() == 0


def test_ties_in_the_first_key(spark):
    """A hot value: most rows share it, and the next key tells them apart."""
    rows = spark.range(5000).selectExpr("id AS k", "if(id % 10 < 9, 0L, id % 7) AS units", "1L AS one")
    got = running_before(rows, [("units", True), ("k", False)], ["one"], ranges=20)
    want = Window.partitionBy().orderBy(F.desc("units"), "k")
    assert got.withColumn("rn", F.row_number().over(want)).filter("one_before <> rn - 1").count() == 0


def test_a_range_bounds_the_largest_window(spark):
    """A hot partition key spreads over the ranges: no window holds more than a few shares."""
    rows = spark.range(100_000).selectExpr("if(id % 10 < 9, 1, id) AS p", "id AS k", "1L AS one")
    placed = running_before(rows, [("k", False)], ["one"], ["p"], ranges=50)
    assert "_range" not in placed.columns
    ranged = rows.repartitionByRange(50, "p", "k").groupBy(F.spark_partition_id()).count()
    assert ranged.agg(F.max("count")).first()[0] < 3 * 100_000 / 50


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11, 25, 100, 103])
def test_tile_equals_ntile(spark, n):
    rows = spark.range(1, n + 1).withColumn("n", F.lit(n).cast("long"))
    got = rows.withColumn("a", tile(F.col("id"), F.col("n"), 10)).withColumn(
        "b", F.ntile(10).over(Window.partitionBy("n").orderBy("id"))
    )
    assert got.filter("a <> b").count() == 0
