"""SimHash near-dedup with pivot distance tables.

A fingerprint bit is 1 if it is set in over half of the hashes of a document's word shingles (repeats
included). Documents link when their fingerprints differ in at most ``max_bits`` bits, and a group is
everything reachable by links.

Links are searched among the distinct fingerprints:

1. The 64 bits are cut into ``max_bits + 4`` blocks. Two linked fingerprints agree in at least four whole
   blocks, so each fingerprint is filed under every choice of four blocks and what it holds there.
   The rest of the bits bound the size of a file: distinct fingerprints in it differ there.
2. Each task computes the table of Hamming distances to many random reference fingerprints (pivots) and
   sorts every file by the first of them. Linked fingerprints differ by at most ``max_bits`` in
   every column, so only neighbours within that distance in the first column are compared, pairs whose
   largest column difference is greater are discarded, and the survivors' own distance decides.
3. A task reports for each fingerprint the smallest one it reaches there: at most one link a row,
   however dense the file. The links are joined into groups by ``components``.

Defined cases: NULL and empty texts have the fingerprint 0, linked like any other. A NULL id belongs to its group but
never names it, unless all ids there are NULL. Repeated rows share a fingerprint, hence a group. Other columns
are carried along by ``one_of_each_group``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.llm.components import components
from shelfflow.llm.text import U64, sliced
from shelfflow.sources.staging import stage

SEED = 42
PIVOTS = 32


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of one text."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], gaps[: len(gaps) - shingle + 2] + 1]).tolist()
    ends = np.concatenate([gaps[shingle - 1 :], [len(joined)]]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends)], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 4096):
        part = hashes[begin : begin + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def _fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """``id``, ``content`` and ``fp`` (the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [fingerprint(t, shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            fps = pa.array(np.array(found, U64).view(np.int64), pa.int64())
            kept = [batch.column("id"), batch.column("content")]
            yield pa.RecordBatch.from_arrays([*kept, fps], names=["id", "content", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, content long, fp long")


def _blocks(max_bits: int) -> list[int]:
    """Bit masks of the blocks, as even as 64 bits allow."""
    edges = np.linspace(0, 64, max_bits + 5).astype(int)
    return [((1 << int(hi - lo)) - 1) << int(lo) for lo, hi in zip(edges[:-1], edges[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def distances(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table: a row per fingerprint, a column per pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)


def links_within(key: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and the smallest fingerprint each reaches by links under its own key, where that's another one."""
    pivots = np.random.default_rng(SEED).integers(0, 2**64, PIVOTS, dtype=U64)
    order = np.lexsort((np.bitwise_count(fps ^ pivots[0]), key))
    key, fps = key[order], fps[order]
    # Rows alone under their key can't link.
    same = key[1:] == key[:-1]
    busy = np.zeros(len(key), bool)
    busy[1:] |= same
    busy[:-1] |= same
    key, fps = key[busy], fps[busy]
    table = distances(fps, pivots)
    label = np.arange(len(fps))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step, near = 1, np.arange(len(fps))
    while True:
        near = near[near + step < len(fps)]
        near = near[(key[near] == key[near + step]) & (table[near + step, 0] - table[near, 0] <= max_bits)]
        if not len(near):
            break
        left, right = near, near + step
        close = np.abs(table[left] - table[right]).max(axis=1) <= max_bits
        left, right = left[close], right[close]
        real = np.bitwise_count(fps[left] ^ fps[right]) <= max_bits
        if real.any():
            found.append((left[real], right[real]))
            if sum(len(a) for a, _ in found) > 4 * len(fps):
                found = [_spanning(label, found)]
        step += 1
    if found:
        _spanning(label, found)
    # The smallest fingerprint of each label names it.
    names = np.full(len(fps), np.iinfo(np.int64).max)
    signed = fps.view(np.int64)
    np.minimum.at(names, label, signed)
    root = names[label]
    other = root != signed
    return signed[other], root[other]


def _spanning(label: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Bring the labels of linked rows together; returns as few links as rows that say the same."""
    left = np.concatenate([a for a, _ in found])
    right = np.concatenate([b for _, b in found])
    while True:
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, label[left], low)
        np.minimum.at(label, label[right], low)
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label[:] = label[label]
        if (before == label).all():
            break
    rows = np.arange(len(label))
    linked = label != rows
    return label[linked], rows[linked]


def _find_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """``a`` and ``b``: links between distinct fingerprints ``fp`` that join every group."""
    masks = _blocks(max_bits)
    choices = [sum(chosen) for chosen in combinations(masks, 4)]
    filed = F.explode(
        F.array(*[F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for n, m in enumerate(choices)])
    )
    rows = fps.select("fp", filed.alias("file")).select("fp", F.xxhash64("file.choice", "file.bits").alias("file"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("file").to_numpy(), b.column("fp").to_numpy()) for b in batches]
        if not parts:
            return
        files, values = (np.concatenate(x) for x in zip(*parts))
        a, b = links_within(files, values.view(U64), max_bits)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.repartition("file").mapInArrow(search, "a long, b long")


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_column: str, text_column: str) -> DataFrame:
    """Every row as ``id``, ``content`` (a hash of its text), ``fp`` and ``root`` (its group)."""
    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("content"), text.alias("text"))
    rows = stage(_fingerprints(rows, shingle))
    fps = stage(rows.select("fp").distinct())
    roots = stage(components(_find_links(fps, max_bits), "a", "b"))
    return rows.join(roots, rows["fp"] == roots["node"], "left").select(
        "id", "content", "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicate_groups(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row as ``id_column``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable)."""
    rows = _grouped(docs, shingle, max_bits, id_column, text_column)
    groups = rows.groupBy(F.col("root").alias("group")).agg(F.min("id").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(groups, rows["root"] == groups["group"]).select(F.col("id").alias(id_column), hexed, "component_id")


def one_of_each_group(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each group with all its columns: the one with the smallest id, NULL last.

    Among rows with that id the hash of the text decides, and of identical ones any one stays.
    """
    rows = _grouped(docs, shingle, max_bits, id_column, text_column)
    copies = rows.groupBy("root", "id", "content").agg(F.count(F.lit(1)).alias("__copies"))
    first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "content", "__copies"))
    keepers = stage(
        copies.groupBy("root")
        .agg(first.alias("first"))
        .select(F.col("first.id").alias("__id"), F.col("first.content").alias("__content"), F.col("first.__copies").alias("__copies"))
    )
    content = F.xxhash64(docs[text_column].cast("string"))
    same = docs[id_column].eqNullSafe(keepers["__id"]) & (content == keepers["__content"])
    kept = docs.join(keepers, same)
    once = kept.filter(F.col("__copies") == 1).select(docs.columns)
    repeated = kept.filter(F.col("__copies") > 1).dropDuplicates(["__id", "__content"]).select(docs.columns)
    return once.union(repeated)
