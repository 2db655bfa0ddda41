"""Running totals, ranks and tiles over an ordering without an unbounded window.

A plain ``Window.orderBy`` without partition keys, or with few of them, sorts all its rows in one
task. Here the rows are dealt out in ranges of the ordering and staged with the number of their
range. Sums before a row are then the sum over the earlier rows of its own range, one sorted pass
in its task, plus the sum over the earlier ranges, which needs one row per range. The same steps run
for every size: a small input simply has one range.

The largest window holds one range, whose size the shuffle settings bound, whatever the keys are;
rows that agree in the whole ordering share a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfflow.functions.numeric import whole_div
from shelfflow.sources.staging import stage

Key = tuple[str, bool]
RANGE = "_range"


def running_before(
    df: DataFrame, order: Sequence[Key], measures: Sequence[str], partition: Sequence[str] = (), ranges: int | None = None
) -> DataFrame:
    """Add ``<m>_before`` (sum over earlier rows) and ``<m>_total`` (over the partition).

    ``order`` lists ``(column, descending)`` and should identify a row within its partition; NULL
    comes first, or last if descending, and NULL partition keys form a partition like any other.
    ``ranges`` is the number of ranges, by default that of the session's shuffles.
    """
    partition = list(partition)
    directed = [F.col(name).desc() if descending else F.col(name).asc() for name, descending in order]
    dealt = [*[F.col(p).asc() for p in partition], *directed]
    ranged = df.repartitionByRange(ranges, *dealt) if ranges else df.repartitionByRange(*dealt)
    ranged = stage(ranged.withColumn(RANGE, F.spark_partition_id()))

    sums = ranged.groupBy(*partition, RANGE).agg(*[F.sum(m).alias(f"_{m}_sum") for m in measures])
    siblings = Window.partitionBy(*partition)
    earlier = siblings.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(p).alias(f"_{p}_key") for p in partition],
        F.col(RANGE).alias("_range_key"),
        *[F.coalesce(F.sum(f"_{m}_sum").over(earlier), F.lit(0)).alias(f"_{m}_offset") for m in measures],
        *[F.sum(f"_{m}_sum").over(siblings).alias(f"{m}_total") for m in measures],
    )

    inside = Window.partitionBy(*partition, RANGE).orderBy(*directed).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumns({f"{m}_before": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    same = [own[RANGE] == sums["_range_key"], *[own[p].eqNullSafe(sums[f"_{p}_key"]) for p in partition]]
    placed = own.join(sums, same).withColumns(
        {f"{m}_before": F.col(f"{m}_before") + F.col(f"_{m}_offset") for m in measures}
    )
    return placed.drop(RANGE, "_range_key", *[f"_{p}_key" for p in partition], *[f"_{m}_offset" for m in measures])


def tile(position: Column, rows: Column, tiles: int) -> Column:
    """The NTILE number of the row at 1-based ``position`` among ``rows``."""
    k = F.lit(tiles).cast("long")
    small = whole_div(rows, k)
    extra = rows % k
    wide_rows = extra * (small + 1)
    in_wide = whole_div(position - 1, small + 1) + 1
    in_small = extra + whole_div(position - wide_rows - 1, small) + 1
    return F.when(position <= wide_rows, in_wide).otherwise(in_small)
