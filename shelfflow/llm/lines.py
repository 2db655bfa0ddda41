"""Line dedup with two Bloom filters, one for line hashes seen once, one for those seen twice.

A line's key is the line without separators at both ends and with A-Z in lower case. Keys of at
least ``min_chars`` code points that occur in at least ``min_docs`` documents (two or more) lose all their lines,
except in the document with the largest id that has the key.

1. Each task puts the distinct keys of every document into its once-filter, and those that were in it
   already into its twice-filter. Filters travel in blocks and merge block by block:
   ``twice = twice1 | twice2 | (once1 & once2)``, ``once = once1 | once2``. Every key of two documents
   or more ends up in the twice-filter; so do some others by chance.
2. Only the lines that the twice-filter suspects are shuffled: an exact grouping by the key itself
   counts documents and finds the largest id, with sums formed before the shuffle.
3. The verdicts go back to the documents by id, and each text is written without its dropped lines.

The filters have 16 bits per line of the input, at most ``max_filter_bits``: what is broadcast is
bounded by that parameter. Beyond it more lines are suspected and shuffled, with the same result.

Defined cases: a NULL or empty text is one empty line; NULL becomes empty. Rows with the same id are one
document for the counts, and each row is written with its own text. A NULL id is a document smaller than all others.
Lines keep their other characters, ``\\r`` included. All columns of the input come out, the text changed; the two
counts are added as ``<prefix>n_lines`` and ``<prefix>n_dropped`` and replace columns of that name. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfflow.llm import bloom
from shelfflow.llm.bloom import Filter
from shelfflow.llm.text import SEPARATORS, U64


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or None if it is too short to count."""
    key = line.strip(SEPARATORS)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return key.lower()


def _key_hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def _filter_blocks(docs: DataFrame, max_filter_bits: int) -> int:
    lines = docs.agg(F.sum(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)).first()[0] or 0
    return bloom.block_count(lines, max_filter_bits)


def _local_filters(blocks: int, min_chars: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = Filter(blocks), Filter(blocks)
        for batch in batches:
            hashes = [h for _, keys in _keys_of(batch, min_chars) for h in map(_key_hash, keys)]
            if hashes:
                distinct, counts = np.unique(np.array(hashes, U64), return_counts=True)
                twice.add(distinct[(counts > 1) | once.has(distinct)])
                once.add(distinct)
        yield from bloom.blocks_of(once, twice)

    return build


def _keys_of(batch: pa.RecordBatch, min_chars: int) -> Iterator[tuple[int, set[bytes]]]:
    """The row number and the distinct keys of each row that has any."""
    for n, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        keys = {line_key(line, min_chars) for line in (text or b"").split(b"\n")}
        keys.discard(None)
        if keys:
            yield n, keys


def _twice_filter(docs: DataFrame, blocks: int, min_chars: int) -> np.ndarray:
    local = docs.select("text").mapInArrow(_local_filters(blocks, min_chars), bloom.LOCAL)
    return bloom.gather(local, blocks, "twice")


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_chars: int = 20,
    min_docs: int = 3,
    max_filter_bits: int = 1 << 30,
    prefix: str = "",
) -> DataFrame:
    """The rows without the repeated lines, and the number of lines before and dropped."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    blocks = _filter_blocks(rows, max_filter_bits)
    shared = spark.sparkContext.broadcast(_twice_filter(rows, blocks, min_chars))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = Filter(blocks, shared.value)
        for batch in batches:
            found = [(n, k) for n, keys in _keys_of(batch, min_chars) for k in keys]
            if not found:
                continue
            at, keys = zip(*found)
            suspected = np.flatnonzero(twice.has(np.array([_key_hash(k) for k in keys], U64)))
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([keys[i] for i in suspected], pa.binary()),
                    "id": batch.column("id").take(pa.array(np.array(at)[suspected], pa.int64())),
                }
            )

    kind = rows.schema["id"].dataType.simpleString()
    lines = rows.mapInArrow(suspects, f"key binary, id {kind}").distinct()
    verdicts = lines.groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("holder"))
    verdicts = verdicts.filter(F.col("docs") >= min_docs).select("key", "holder")
    lost = (
        lines.join(verdicts, "key")
        .filter(~F.col("id").eqNullSafe(F.col("holder")))
        .groupBy(F.col("id").alias("__lost_id"))
        .agg(F.collect_list("key").alias("__lost"))
    )

    counts = [f"{prefix}n_lines", f"{prefix}n_dropped"]
    kept = docs.drop(*counts)
    names = kept.columns
    joined = kept.join(lost, kept[id_column].eqNullSafe(lost["__lost_id"]), "left").drop("__lost_id")
    fields = [T.StructField(f.name, T.StringType()) if f.name == text_column else f for f in kept.schema]
    schema = T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in counts]])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text_column)
            texts, total, dropped = [], [], []
            for text, lost_keys in zip(batch.column(place).cast(pa.binary()).to_pylist(), batch.column("__lost").to_pylist()):
                parts = (text or b"").split(b"\n")
                total.append(len(parts))
                if lost_keys:
                    lost_keys = set(lost_keys)
                    parts = [p for p in parts if line_key(p, min_chars) not in lost_keys]
                texts.append(b"\n".join(parts))
                dropped.append(total[-1] - len(parts))
            columns = [batch.column(c) for c in names]
            columns[names.index(text_column)] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(total, pa.int64()), pa.array(dropped, pa.int64())], names=[*names, *counts]
            )

    return joined.mapInArrow(write, schema)
