"""Benchmark decontamination by size-partitioned MinHash containment search.

A document contains a test item if it has at least ``threshold`` of the item's distinct shingles of ``shingle``
words (A-Z in lower case). A MinHash of a whole document says nothing about a passage in it, so
both sides are partitioned by size:

1. Items fall into classes by their number of shingles, doubling from class to class. Each item has ``HASHES`` minima
   of seeded hash functions over its shingles.
2. For each class, a document is cut into overlapping segments of twice the class's largest item, each
   beginning half a segment after the last. A contained passage lies whole in one of them and makes up a fifth
   or more of the two sets together. Minima of segments come from minima of half-segments.
3. Segments that share any minimum with an item of the class make the document a candidate for it: at a fifth, 48
   minima miss once in 40,000 times. A Bloom filter of the items' minima, of bounded size, keeps other minima from
   being shuffled.
4. Candidates are verified: shared shingles are joined by their own text and counted.

Defined cases: a text of fewer words than a shingle is one shingle; without words it has none and neither contains nor
is contained. NULL texts are empty. A document is told by its id and text: repeated rows have the same
verdict, NULL ids too. Repeated items count by their id; rows with the same item id are one item, its shingles pooled. Other
columns are carried along by ``without_benchmark``. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.llm import bloom
from shelfflow.llm.bloom import Filter
from shelfflow.llm.text import LOWER, U64, byte_sums, flat, mix, sliced, span_hashes, window_hashes, window_starts, words
from shelfflow.sources.staging import stage

HASHES = 48
_SEEDS = np.random.default_rng(9).integers(0, 2**63, (2, HASHES), dtype=U64) * U64(2) + U64(1)


class Shingles:
    """The word shingles of a slice of texts, repeats included, in order."""

    def __init__(self, column: pa.Array, shingle: int):
        data, offsets = flat(column)
        self.data = LOWER[data]
        self.starts, self.ends, first = words(self.data, offsets)
        tokens = span_hashes(byte_sums(self.data), self.starts, self.ends)
        count = np.diff(first)
        short = (count > 0) & (count < shingle)
        sizes = np.where(short, 1, np.maximum(count - shingle + 1, 0))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        # The first and the last word of each shingle.
        self.begin = np.empty(self.first[-1], np.int64)
        self.last = np.empty(self.first[-1], np.int64)
        self.hashes = np.empty(self.first[-1], U64)
        row = np.repeat(np.arange(len(count)), sizes)
        long = ~short[row]
        whole = window_starts(first, shingle)
        self.begin[long], self.last[long] = whole, whole + shingle - 1
        self.hashes[long] = window_hashes(tokens, shingle)[whole]
        for n in range(1, shingle):
            own = np.flatnonzero(short & (count == n))
            at = self.first[own]
            self.begin[at], self.last[at] = first[own], first[own] + n - 1
            if len(own):
                self.hashes[at] = window_hashes(tokens, n)[first[own]]

    def text(self, n: int) -> bytes:
        """The words of a shingle, joined by one space."""
        span = range(self.begin[n], self.last[n] + 1)
        return b" ".join(self.data[self.starts[w] : self.ends[w]].tobytes() for w in span)


def size_class(n: int) -> int:
    """0 for one shingle, then by doubling: 1 up to two, 2 up to four, 3 up to eight."""
    return (n - 1).bit_length()


def _key(minima: np.ndarray, h: int, level: int) -> np.ndarray:
    """One number for a minimum of hash function ``h`` in a class; spread, since minima are low."""
    return mix(minima ^ U64(((level << 8) + h + 1) * 0x9E3779B97F4A7C15 % 2**64))


def _permuted(hashes: np.ndarray, h: int) -> np.ndarray:
    x = (hashes ^ _SEEDS[0, h]) * _SEEDS[1, h]
    return x ^ (x >> U64(31))


def segment_keys(hashes: np.ndarray, first: np.ndarray, levels: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each class and hash function: the keys of all segments, and the row each belongs to."""
    rows = np.flatnonzero(np.diff(first))
    if not len(rows) or not levels:
        return
    blocks = {}
    for level in levels:
        width = 1 << level
        counts = -(-np.diff(first)[rows] // width)
        row = np.repeat(rows, counts)
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        blocks[level] = (first[row] + within * width, row)
    for h in range(HASHES):
        values = _permuted(hashes, h)
        for level in levels:
            begins, row = blocks[level]
            minima = np.minimum.reduceat(values, begins)
            both = minima.copy()
            same = row[1:] == row[:-1]
            both[:-1][same] = np.minimum(minima[:-1][same], minima[1:][same])
            yield _key(both, h, level), row


def _item_tables(items: DataFrame, shingle: int, item_column: str, text_column: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``item, shingle``; ``item, size``; ``item, level, key`` (the minima)."""
    kind = items.schema[item_column].dataType.simpleString()
    rows = items.select(F.col(item_column).alias("item"), F.col(text_column).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = Shingles(batch.column("text"), shingle)
            row = np.repeat(np.arange(batch.num_rows), np.diff(found.first))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item").take(pa.array(row)),
                    pa.array([found.text(n) for n in range(len(row))], pa.binary()),
                    pa.array(found.hashes.view(np.int64), pa.int64()),
                ],
                names=["item", "shingle", "hash"],
            )

    cut_up = stage(rows.mapInArrow(cut, f"item {kind}, shingle binary, hash long").distinct())
    sizes = cut_up.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
    columns = [f"min{h}" for h in range(HASHES)]

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(U64)
            # Signed numbers in the order of the unsigned ones, for the grouped minimum.
            values = [(_permuted(hashes, h) ^ U64(1 << 63)).view(np.int64) for h in range(HASHES)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), *[pa.array(v, pa.int64()) for v in values]], names=["item", *columns]
            )

    minima = cut_up.select("item", "hash").mapInArrow(permute, f"item {kind}, " + ", ".join(f"{c} long" for c in columns))
    minima = minima.groupBy("item").agg(*[F.min(c).alias(c) for c in columns], F.count(F.lit(1)).alias("size"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = np.array([size_class(n) for n in batch.column("size").to_pylist()], np.int64)
            for h in range(HASHES):
                values = batch.column(columns[h]).to_numpy().view(U64) ^ U64(1 << 63)
                key = np.array([_key(values[i : i + 1], h, int(v))[0] for i, v in enumerate(levels)], U64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item"), pa.array(levels, pa.int32()), pa.array(key.view(np.int64), pa.int64())],
                    names=["item", "level", "key"],
                )

    return cut_up.select("item", "shingle", "hash"), sizes, stage(minima.mapInArrow(keys, f"item {kind}, level int, key long"))


def _filter_of(keys: DataFrame, max_bits: int) -> tuple[int, np.ndarray]:
    """A Bloom filter of a column of longs."""
    blocks = bloom.block_count(keys.count(), max_bits)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = Filter(blocks)
        for batch in batches:
            once.add(mix(batch.column(0).to_numpy().view(U64)))
        yield from bloom.blocks_of(once, Filter(blocks))

    return blocks, bloom.gather(keys.mapInArrow(build, bloom.LOCAL), blocks, "once")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = 5,
    threshold: float = 0.8,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    max_filter_bits: int = 1 << 28,
) -> DataFrame:
    """A row for each document and item it contains: ``id``, ``content`` (a hash of its text), ``item``, ``n_shingles``, ``n_shared``."""
    spark = docs.sparkSession
    item_shingles, sizes, minima = _item_tables(items, shingle, item_column, text_column)
    levels = sorted(r.level for r in minima.select("level").distinct().collect())
    minima_filter = _filter_of(minima.select("key"), max_filter_bits)
    shingle_filter = _filter_of(item_shingles.select("hash"), max_filter_bits)
    shared = spark.sparkContext.broadcast((minima_filter, shingle_filter))
    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("content"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_minima, of_shingles = (Filter(*f) for f in shared.value)
        for batch in sliced(batches, "text"):
            cut = Shingles(batch.column("text"), shingle)
            hit_keys, hit_rows = [np.empty(0, U64)], [np.empty(0, np.int64)]
            for keys, row in segment_keys(cut.hashes, cut.first, levels):
                hit = of_minima.has(mix(keys))
                if hit.any():
                    hit_keys.append(keys[hit])
                    hit_rows.append(row[hit])
            keys, row = np.concatenate(hit_keys), np.concatenate(hit_rows)
            if not len(keys):
                continue
            candidate = np.zeros(batch.num_rows, bool)
            candidate[row] = True
            owner = np.repeat(np.arange(batch.num_rows), np.diff(cut.first))
            mine = np.flatnonzero(candidate[owner])
            mine = mine[of_shingles.has(mix(cut.hashes[mine]))]
            at = pa.array(np.concatenate([row, owner[mine]]))
            texts = [None] * len(row) + [cut.text(n) for n in mine]
            longs = pa.array(keys.view(np.int64).tolist() + [None] * len(mine), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("content").take(at), longs, pa.array(texts, pa.binary())],
                names=["id", "content", "key", "shingle"],
            )

    found = stage(rows.mapInArrow(search, f"id {kind}, content long, key long, shingle binary").distinct())
    candidates = (
        found.filter("key IS NOT NULL")
        .join(minima.select("key", "item"), "key")
        .select(F.col("id").alias("c_id"), F.col("content").alias("c_content"), F.col("item").alias("c_item"))
        .distinct()
    )
    counted = (
        found.filter("shingle IS NOT NULL")
        .join(item_shingles.select("item", "shingle"), "shingle")
        .groupBy("id", "content", "item")
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )
    pair = (
        counted["id"].eqNullSafe(candidates["c_id"])
        & (counted["content"] == candidates["c_content"])
        & counted["item"].eqNullSafe(candidates["c_item"])
    )
    verified = counted.join(candidates, pair, "left_semi")
    sizes = sizes.select(F.col("item").alias("s_item"), F.col("size").alias("n_shingles"))
    return (
        verified.join(sizes, verified["item"].eqNullSafe(sizes["s_item"]))
        .filter(F.col("n_shared") >= F.col("n_shingles") * threshold)
        .select("id", "content", "item", "n_shingles", "n_shared")
    )


def without_benchmark(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", **search
) -> DataFrame:
    """The rows that contain no item, with all their columns."""
    found = contained_items(docs, items, id_column=id_column, text_column=text_column, **search)
    leaks = stage(found.select(F.col("id").alias("__id"), F.col("content").alias("__content")).distinct())
    content = F.xxhash64(docs[text_column].cast("string"))
    same = docs[id_column].eqNullSafe(leaks["__id"]) & (content == leaks["__content"])
    return docs.join(leaks, same, "left_anti")
