"""Sums of numeric arrays over all tasks, one array per key, without a group in memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTIAL = "key int, task long, value binary"


def partial(arrays: dict[int, np.ndarray]) -> pa.RecordBatch:
    """What one task has summed, a row per key; values are doubles."""
    return pa.RecordBatch.from_pydict(
        {
            "key": pa.array(list(arrays), pa.int32()),
            "task": pa.array([TaskContext.get().partitionId()] * len(arrays), pa.int64()),
            "value": pa.array([np.ascontiguousarray(v, np.float64).tobytes() for v in arrays.values()], pa.binary()),
        }
    )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, total = None, None

    def done():
        return pa.RecordBatch.from_pydict({"key": pa.array([key], pa.int32()), "value": pa.array([total.tobytes()], pa.binary())})

    for batch in batches:
        for k, v in zip(batch.column("key").to_pylist(), batch.column("value")):
            value = np.frombuffer(v.as_buffer(), np.float64)
            if k != key:
                if key is not None:
                    yield done()
                key, total = k, value.copy()
            else:
                total += value
    if key is not None:
        yield done()


def summed(partials: DataFrame) -> dict[int, np.ndarray]:
    """The sum of each key's arrays, added in the order of the tasks. Keys and lengths must be bounded by a parameter."""
    added = partials.repartition("key").sortWithinPartitions("key", "task").mapInArrow(_add, "key int, value binary")
    return {r.key: np.frombuffer(r.value, np.float64) for r in added.toLocalIterator()}


# Tasks whose arrays of one key are added in one place before they meet the others.
SHARES = 64


def collected(partials: DataFrame) -> dict[int, np.ndarray]:
    """The same in one job: first by key and share of the tasks, so that no task holds the arrays of all tasks, then by key."""
    shared = partials.withColumn("share", F.col("task") % SHARES).repartition("key", "share")
    apart = shared.sortWithinPartitions("key", "share", "task").mapInArrow(_add_shares, "key int, task long, value binary")
    added = apart.repartition("key").sortWithinPartitions("key", "task").mapInArrow(_add, "key int, value binary")
    return {r.key: np.frombuffer(r.value, np.float64) for r in added.collect()}


def _add_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, total = None, None

    def done():
        key, share = now
        return pa.RecordBatch.from_pydict(
            {"key": pa.array([key], pa.int32()), "task": pa.array([share], pa.int64()), "value": pa.array([total.tobytes()], pa.binary())}
        )

    for batch in batches:
        for key, share, v in zip(batch.column("key").to_pylist(), batch.column("share").to_pylist(), batch.column("value")):
            value = np.frombuffer(v.as_buffer(), np.float64)
            if (key, share) != now:
                if now is not None:
                    yield done()
                now, total = (key, share), value.copy()
            else:
                total += value
    if now is not None:
        yield done()
