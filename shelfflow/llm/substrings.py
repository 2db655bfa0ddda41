"""Substring dedup over words by level-wise doubling.

A window of ``length`` words that occurs twice or more in the corpus is removed wherever it occurs.
Windows are found level by level: lengths double up to ``length``, and only windows repeated at one
length are extended to the next, until no candidates survive.

At the first lengths not every window is looked at. Among the windows of a level inside one full
window, the one with the lowest hash represents it; equal full windows have the same
representative, so a full window whose representative occurs once cannot repeat, and none is
lost. That leaves about one window in ten at the first level. The last level takes every full
window whose representatives all repeat, so the result is exact (hashes have 64 bits).

Defined cases: NULL and empty texts have no words. A repeated row is a document of its own, so all
its windows repeat. Ids may be NULL or repeat, they are only carried along. Other columns are dropped.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.llm import packed
from shelfflow.llm.text import byte_sums, flat, lowest, mix, sliced, text_hashes, window_hashes, window_starts, words


def level_lengths(length: int, base: int) -> list[int]:
    """``length``, its half, the half of that and so on, rounded up, down to ``base`` at least."""
    levels = [length]
    while levels[0] > base and (levels[0] + 1) // 2 >= base:
        levels.insert(0, (levels[0] + 1) // 2)
    return levels


class _Windows:
    """The windows of one chunk that are still candidates."""

    def __init__(self, batch: pa.RecordBatch, text: str, length: int):
        hashes, first = [], [np.zeros(1, np.int64)]
        for part in sliced([batch], text):
            data, offsets = flat(part.column(text))
            starts, ends, firsts = words(data, offsets)
            first.append(firsts[1:] + first[-1][-1])
            hashes.append(text_hashes(data, byte_sums(data), starts, ends))
        self.words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.first = np.concatenate(first)
        self.length = length
        self.starts = window_starts(self.first, length)

    def keys(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The window each candidate is judged by at this level (its start), and the hashes by start."""
        hashes = window_hashes(self.words, level)
        if level == self.length:
            return self.starts, hashes
        # The chosen hashes are low ones: mixed again, they spread over the buckets.
        return lowest(hashes, self.length - level + 1)[self.starts], mix(hashes)

    def keep(self, chosen: np.ndarray) -> None:
        self.starts = self.starts[chosen]


def remove_repeated_windows(
    docs: DataFrame, length: int = 35, base: int = 16, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row as ``id_column``, ``kept`` (the words left, joined by one space), ``n_words``, ``n_removed``.

    Words are runs of anything but \\x20 and \\x09 to \\x0D, unchanged.
    """
    levels = level_lengths(length, base)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    staged = packed.chunks(rows, "text")
    # Words have four bytes or more on average; 2 in 19 windows are looked at first, all candidates last.
    buckets = packed.bucket_count(staged, 0.5)

    def replay(row: dict, upto: int) -> tuple[pa.RecordBatch, _Windows]:
        batch = packed.unpack_batch(row["payload"])
        windows = _Windows(batch, "text", length)
        for n, level in enumerate(levels[:upto]):
            judged, hashes = windows.keys(level)
            sent = packed.distinct(hashes[np.unique(judged)])[0]
            chosen = packed.receive(row[f"level{n}"], sent, buckets)
            windows.keep(packed.members(sent, chosen, hashes[judged]))
        return batch, windows

    def look(upto: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    row = batch.slice(n, 1).to_pylist()[0]
                    _, windows = replay(row, upto)
                    judged, hashes = windows.keys(levels[upto])
                    yield packed.send(row["chunk"], *packed.distinct(hashes[np.unique(judged)]), buckets)

        return run

    answered = staged
    for n in range(len(levels)):
        sent = answered.drop("size").mapInArrow(look(n), packed.SENT)
        answered = packed.with_answers(answered, packed.repeated(sent), f"level{n}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                yield _without(*replay(batch.slice(n, 1).to_pylist()[0], len(levels)))

    kind = rows.schema["id"].dataType.simpleString()
    out = answered.drop("size").mapInArrow(write, f"id {kind}, kept string, n_words long, n_removed long")
    return out.withColumnRenamed("id", id_column)


def _without(batch: pa.RecordBatch, windows: _Windows) -> pa.RecordBatch:
    edges = np.zeros(len(windows.words) + 1, np.int64)
    edges[windows.starts] += 1
    edges[windows.starts + windows.length] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    before = np.concatenate([[0], np.cumsum(gone)])
    removed = before[windows.first[1:]] - before[windows.first[:-1]]
    kept = []
    for n, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        parts = (text or b"").split()
        if removed[n]:
            stay = ~gone[windows.first[n] : windows.first[n + 1]]
            parts = [w for w, s in zip(parts, stay.tolist()) if s]
        kept.append(b" ".join(parts))
    return pa.RecordBatch.from_pydict(
        {
            "id": batch.column("id"),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "n_words": pa.array(np.diff(windows.first), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
        }
    )
