"""Rows dealt out by key in a fixed number of tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def dealt_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows in as many tasks as the session's shuffles have partitions, rows of equal ``keys`` together.

    Keys that hardly repeat are not worth partial sums, and they compress so well that adaptive execution, which merges
    partitions by their bytes, would give many millions of them to one task. A number given outright is kept.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
