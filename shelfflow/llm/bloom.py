"""Bloom filters built by all tasks, merged block by block, of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfflow.llm.text import U64

BITS_PER_KEY = 16
BLOCK_BITS = 1 << 19
PROBES = 4
LOCAL = "block int, once binary, twice binary"


def block_count(keys: int, max_bits: int) -> int:
    """Blocks for that many keys, as far as ``max_bits`` go."""
    return max(1, -(-min(keys * BITS_PER_KEY, max_bits) // BLOCK_BITS))


class Filter:
    """A Bloom filter whose bits of one key all lie in one block."""

    def __init__(self, blocks: int, data: np.ndarray | None = None):
        self.blocks = blocks
        self.data = np.zeros(blocks * BLOCK_BITS // 8, np.uint8) if data is None else data

    def _bit(self, hashes: np.ndarray, probe: int) -> tuple[np.ndarray, np.ndarray]:
        """Byte and mask of one of a key's bits."""
        block = ((hashes >> U64(32)) * U64(self.blocks)) >> U64(32)
        step = (hashes >> U64(19)) | U64(1)
        bit = block * U64(BLOCK_BITS) + (hashes + step * U64(probe)) % U64(BLOCK_BITS)
        return (bit >> U64(3)).astype(np.int64), np.uint8(1) << (bit & U64(7)).astype(np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        left = np.arange(len(hashes))
        for probe in range(PROBES):
            byte, mask = self._bit(hashes[left], probe)
            left = left[(self.data[byte] & mask) != 0]
        found = np.zeros(len(hashes), bool)
        found[left] = True
        return found

    def add(self, hashes: np.ndarray) -> None:
        for probe in range(PROBES):
            byte, mask = self._bit(hashes, probe)
            np.bitwise_or.at(self.data, byte, mask)


def blocks_of(once: Filter, twice: Filter) -> Iterator[pa.RecordBatch]:
    """What a task has seen, one row per block that isn't empty."""
    size = BLOCK_BITS // 8
    for b in range(once.blocks):
        part = slice(b * size, (b + 1) * size)
        if once.data[part].any():
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([b], pa.int32()),
                    "once": pa.array([once.data[part].tobytes()], pa.binary()),
                    "twice": pa.array([twice.data[part].tobytes()], pa.binary()),
                }
            )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the rows of each block, which follow one another; one block is held at a time."""
    block, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([block], pa.int32()),
                "once": pa.array([once.tobytes()], pa.binary()),
                "twice": pa.array([twice.tobytes()], pa.binary()),
            }
        )

    for batch in batches:
        for b, o, t in zip(*(batch.column(c) for c in ("block", "once", "twice"))):
            o, t = np.frombuffer(o.as_buffer(), np.uint8), np.frombuffer(t.as_buffer(), np.uint8)
            if b.as_py() != block:
                if block is not None:
                    yield done()
                block, once, twice = b.as_py(), o.copy(), t.copy()
            else:
                twice |= t | (once & o)
                once |= o
    if block is not None:
        yield done()


def gather(local: DataFrame, blocks: int, which: str) -> np.ndarray:
    """The merged filter ``once`` or ``twice`` of all tasks; its size is bounded by the number of blocks."""
    merged = local.repartition("block").sortWithinPartitions("block").mapInArrow(_merged, LOCAL)
    size = BLOCK_BITS // 8
    data = np.zeros(blocks * size, np.uint8)
    for row in merged.select("block", which).toLocalIterator():
        data[row.block * size : (row.block + 1) * size] = np.frombuffer(row[which], np.uint8)
    return data
