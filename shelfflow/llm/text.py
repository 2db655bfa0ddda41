"""Arrow text columns as flat byte arrays: words and rolling hashes without a loop over rows.

Everything works on UTF-8 bytes. Word separators and A-Z are ASCII, so bytes give the same words and
lower case as code points would. NULL texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
# The separators \x20 and \x09 to \x0D, and A-Z to lower case.
SEPARATORS = b" \t\n\x0b\x0c\r"
IS_SEPARATOR = np.zeros(256, bool)
IS_SEPARATOR[list(SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = U64(0x9E3779B97F4A7C15)
INVERSE = U64(pow(int(BASE), -1, 2**64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, and where each row begins (one entry more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``max_bytes`` of text; a longer row is a slice of its own."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        offsets = flat(batch.column(column))[1]
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + max_bytes, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and the number of the first word of each row (and of the end)."""
    inside = ~IS_SEPARATOR[data]
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    opening = inside.copy()
    opening[1:] &= ~inside[:-1]
    opening[begins] |= inside[begins]
    starts = np.flatnonzero(opening)
    closing = inside.copy()
    closing[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    closing[last] |= inside[last]
    return starts, np.flatnonzero(closing) + 1, np.searchsorted(starts, offsets)


@cache
def _symbols() -> np.ndarray:
    """A random odd number for each byte value."""
    return np.random.default_rng(20).integers(0, 2**63, 256, dtype=U64) * U64(2) + U64(1)


_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        n = max(n, 1 << 20)
        for name, factor in (("up", BASE), ("down", INVERSE)):
            row = np.full(n, factor, U64)
            row[0] = 1
            _powers[name] = np.multiply.accumulate(row)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all others."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


# Symbols handled at a time, so that what is in hand stays in the processor's cache.
BLOCK = 1 << 15


def prefix_sums(symbols: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Sums of symbol times power, from which any span's hash follows; with a ``table``, of the symbols it lists."""
    up, _ = powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, U64)
    for begin in range(0, len(symbols), BLOCK):
        end = min(begin + BLOCK, len(symbols))
        part = symbols[begin:end] if table is None else table[symbols[begin:end]]
        part = part * up[begin:end]
        np.cumsum(part, out=sums[begin + 1 : end + 1])
        sums[begin + 1 : end + 1] += sums[begin]
    return sums


def byte_sums(data: np.ndarray) -> np.ndarray:
    return prefix_sums(data, _symbols())


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal spans have equal hashes wherever they lie."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


# Spans of more bytes are hashed whole: sums modulo 2**64 of some long strings of two letters agree by their construction.
LONG_SPAN = 256


def text_hashes(data: np.ndarray, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words or lines of any length, of which no two strings are known to agree."""
    hashes = span_hashes(sums, starts, ends)
    for n in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
        hashes[n] = xxhash.xxh64_intdigest(data[starts[n] : ends[n]], 20)
    return hashes


def window_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all windows of ``length`` symbols, also of those that cross rows."""
    if len(symbols) < length:
        return np.empty(0, U64)
    sums = prefix_sums(symbols)
    _, down = powers(len(sums))
    return mix((sums[length:] - sums[:-length]) * down[: len(symbols) - length + 1])


def window_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows of ``length`` symbols that lie within one row."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    before = np.cumsum(counts) - counts
    return np.arange(counts.sum()) + np.repeat(first[:-1] - before, counts)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the lowest one, the last one among equals.

    Which place a run names depends on the values in it alone, so equal runs name the same one.
    """
    bits = U64(20)
    low = U64((1 << 20) - 1)
    place = np.arange(len(values), dtype=U64)
    best = (values >> bits << bits) | (low - (place & low))
    done = 1
    while done * 2 <= width:
        best = np.minimum(best[:-done], best[done:])
        done *= 2
    if done < width:
        best = np.minimum(best[: len(best) - (width - done)], best[width - done :])
    run = np.arange(len(best), dtype=np.int64)
    found = (low - (best & low)).astype(np.int64)
    return run + ((found - run) & int(low))
