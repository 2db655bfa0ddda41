"""Corpus-wide counts of 64-bit keys, exchanged as packed arrays instead of rows.

Documents are staged as chunks of a few MB, each a compressed Arrow batch under a chunk number. A
step computes the distinct keys of a chunk in sorted order, cuts them by value into buckets and
sends one packed array per chunk and bucket. The task of a bucket answers each array in its order,
so an answer needs no keys, and the chunk lays the answers beside its own keys again.

A key that fills the corpus arrives once per chunk, so no bucket depends on how often a key repeats.
The number of buckets follows the corpus, so a bucket keeps its size. Nothing passes the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.llm.text import U64, flat, sliced
from shelfflow.sources.staging import run_folder, stage

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def pack_batch(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_ZSTD) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_batch(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as stream:
        return stream.read_next_batch()


def chunks(df: DataFrame, text: str, chunk_bytes: int = CHUNK_BYTES, parts: int = 0) -> DataFrame:
    """Stage the rows as chunks: ``chunk``, ``size`` (bytes of text), ``payload``; co-located if ``parts`` are given."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        for n, part in enumerate(sliced(batches, text, chunk_bytes)):
            size = int(flat(part.column(text))[1][-1])
            yield pa.RecordBatch.from_pydict(
                {"chunk": [task + n], "size": [size], "payload": pa.array([pack_batch(part)], pa.binary())}
            )

    packed_up = df.mapInArrow(pack, "chunk long, size long, payload binary")
    return co_located(packed_up, parts, shuffle=True) if parts else stage(packed_up)


def co_located(df: DataFrame, parts: int, shuffle: bool = False) -> DataFrame:
    """Keep the frame as a table bucketed by ``chunk``: later joins by chunk move only the other side.

    The files lie in the run's folder; ``shuffle`` deals the rows out first, if they aren't yet.
    """
    spark = df.sparkSession
    name = f"shelfflow_{uuid.uuid4().hex}"
    dealt = df.repartition(parts, "chunk") if shuffle else df
    path = f"{run_folder(spark)}/{name}"
    dealt.write.bucketBy(parts, "chunk").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def bucket_count(staged: DataFrame, bytes_per_text_byte: float) -> int:
    """Buckets of about ``BUCKET_BYTES``, given what a step sends per byte of text."""
    total = staged.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    least = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(total * bytes_per_text_byte / BUCKET_BYTES) + 1)


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in the sorted keys, and the end."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=U64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and their counts."""
    return np.unique(keys, return_counts=True)


def send(chunk: int, keys: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket with keys: the sorted keys and how often the chunk has each."""
    cut = _bounds(keys, buckets)
    full = np.flatnonzero(np.diff(cut))
    counts = counts.astype(np.uint32)
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(full, pa.int32()),
            "chunk": pa.array(np.full(len(full), chunk), pa.int64()),
            "keys": pa.array([keys[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary()),
            "counts": pa.array([counts[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary()),
        }
    )


SENT = "bucket int, chunk long, keys binary, counts binary"


def _arrays(column: pa.ChunkedArray, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in column.to_pylist()]


def totals(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket: rows per array, the distinct keys, their total counts, each key's place among them."""
    arrays = _arrays(table["keys"], U64)
    keys, place = np.unique(np.concatenate(arrays), return_inverse=True)
    counts = np.bincount(place, np.concatenate(_arrays(table["counts"], np.uint32))).astype(np.int64)
    return [len(a) for a in arrays], keys, counts, place


def squeeze(values: np.ndarray) -> bytes:
    """Booleans as bits, numbers compressed."""
    return np.packbits(values).tobytes() if values.dtype == bool else pa.compress(values.tobytes(), "zstd", asbytes=True)


def answer(sent: DataFrame, reply: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """Per chunk the answers of all buckets: ``reply(keys, counts)`` gives one array entry per key.

    The bucket's keys pass ``reply`` once, whatever their chunks.
    """

    def of_bucket(table: pa.Table) -> pa.Table:
        sizes, keys, counts, place = totals(table)
        found = reply(keys, counts)[place]
        parts = np.split(found, np.cumsum(sizes)[:-1])
        sent_back = pa.array([squeeze(p) for p in parts], pa.binary())
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "answer": sent_back})

    return per_chunk(sent.groupBy("bucket").applyInArrow(of_bucket, "chunk long, bucket int, answer binary"))


def per_chunk(answers: DataFrame) -> DataFrame:
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))


def repeated(sent: DataFrame) -> DataFrame:
    """Per chunk, which of its keys occur twice or more in the corpus."""
    return answer(sent, lambda keys, counts: counts >= 2)


def with_answers(staged: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """The chunks with the answers of one step in column ``name``."""
    return staged.join(answers.withColumnRenamed("answers", name), "chunk", "left")


def receive(answers: list[dict] | None, keys: np.ndarray, buckets: int, kind: type = bool) -> np.ndarray:
    """The answers to ``keys`` in their order."""
    cut = _bounds(keys, buckets)
    out = np.zeros(len(keys), kind)
    for part in answers or []:
        b = part["bucket"]
        n = cut[b + 1] - cut[b]
        if kind is bool:
            out[cut[b] : cut[b + 1]] = np.unpackbits(np.frombuffer(part["answer"], np.uint8), count=n)
        else:
            size = int(n) * np.dtype(kind).itemsize
            out[cut[b] : cut[b + 1]] = np.frombuffer(pa.decompress(part["answer"], size, "zstd"), kind)
    return out


def members(sorted_keys: np.ndarray, chosen: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each key whether ``chosen`` holds at its place among the sorted keys (all of which occur)."""
    if len(keys) == 0:
        return np.zeros(0, bool)
    return chosen[np.searchsorted(sorted_keys, keys)]
