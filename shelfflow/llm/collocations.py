"""Phrase collocations: frequent phrases of a language and how far their parts stand together by more than chance.

Counting. Texts are staged once as chunks of word numbers. Phrases are found length by length; a phrase is looked at only where all its shorter
phrases have survived. At each step a chunk sends the distinct hashes of its phrases with their counts, cut by value into hash
partitions; these exact counts are a chunk's own summary. The task of a partition merges them into one Misra-Gries summary: when
more counters are left than its capacity allows, what the first one beyond has is taken off all of them. The capacity is
``slack`` times the partition's mass over the threshold and one more, so less than threshold / slack is ever taken off a phrase, and every phrase
that reaches the threshold survives, whatever the order of merging. Each partition is bounded, as the number of partitions follows the
corpus. The chunk is told which of its hashes survive.

A second pass counts the survivors exactly, by their text: a collision of hashes only lets a rare phrase survive the first. So hashes are cut to the bits that
keep collisions rare and sent as compressed differences.

Scoring. A phrase with count ``a`` is cut after each of its words; with the counts ``l`` and ``r`` of the two parts and ``n`` words in the
language the score is floor(1000 a n / (l r)); the lowest-scoring cut counts, the first of equals. Parts of a frequent phrase are frequent, so
everything is in the table of exact counts. Products are decimals of 38 digits. A phrase whose occurrences nearly all lie inside a longer
candidate is dropped.

Defined cases: a NULL text has no words; a NULL language is ``und``, together with rows that say so. Ids are not used; repeated rows count as often as they
occur. Words are separated by spaces and tabs, pieces by ``.,;:!?`` and \\x0A to \\x0D. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfflow.llm import packed
from shelfflow.llm.text import LOWER, U64, mix, sliced
from shelfflow.sources.staging import stage

# What separates words, and what ends a piece.
KIND = np.zeros(256, np.uint8)
KIND[list(b" \t")] = 1
KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2

CHUNK_BYTES = 4 << 20
# Keys that a partition receives at most, about.
BUCKET_KEYS = 1 << 20
# Partitions of the first pass for one of the second, in which only survivors travel.
TALLIES = 4
LONGEST = 5
# Lengths found at each step.
STEPS = ((1, 2), (3,), (4, 5))
ODD = U64(0x9E3779B97F4A7C15)
# Parts of a language's candidates that are ranked before they meet.
RANK_PARTS = 32


def _tokenize(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, int]:
    """A slice of documents as word numbers, and how many words it has."""
    texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
    joined = b"\n".join([b"", *[t or b"" for t in texts], b""])  # every text ends a piece
    data = LOWER[np.frombuffer(joined, np.uint8)]
    kinds = KIND[data]
    inside = kinds == 0
    starts = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    stops = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    pieces = np.cumsum(kinds == 2)[starts]
    sizes = stops - starts
    edges = np.concatenate([[0], np.cumsum(sizes)])
    spelled = data[np.arange(edges[-1]) + np.repeat(starts - edges[:-1], sizes)]
    buffers = [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(spelled))]
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    begins = np.cumsum([1 + len(t or b"") for t in texts])
    per_text = np.diff(np.searchsorted(starts, begins), prepend=0)
    langs = batch.column("lang").dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint32)
    row = pa.RecordBatch.from_pydict(
        {
            "words": pa.array([coded.dictionary.to_pylist()], pa.list_(pa.binary())),
            "ids": [ids.tobytes()],
            "opens": [np.packbits(np.diff(pieces, prepend=-1) != 0).tobytes()],
            "langs": pa.array([langs.dictionary.to_pylist()], pa.list_(pa.string())),
            "lang": [np.repeat(langs.indices.to_numpy(zero_copy_only=False), per_text).astype(np.uint32).tobytes()],
        }
    )
    return row, len(ids)


class _Chunk:
    """The phrases of one chunk: where each length may begin, and which have survived."""

    def __init__(self, payload: bytes):
        row = packed.unpack_batch(payload).to_pylist()[0]
        self.words, self.langs = row["words"], row["langs"]
        self.ids = np.frombuffer(row["ids"], np.uint32)
        self.lang = np.frombuffer(row["lang"], np.uint32)
        opens = np.unpackbits(np.frombuffer(row["opens"], np.uint8), count=len(self.ids))
        self.piece = np.cumsum(opens)
        hashed = np.array([xxhash.xxh64_intdigest(w) for w in self.words], U64)[self.ids] if len(self.ids) else np.empty(0, U64)
        told = np.array([xxhash.xxh64_intdigest(x, 1) for x in self.langs], U64)
        self.hashes: dict[int, np.ndarray] = {}
        if len(self.ids):
            now = mix(hashed ^ told[self.lang])
            for n in range(1, LONGEST + 1):
                self.hashes[n] = now
                now = mix(now[:-1] * ODD + hashed[n:]) if len(now) > 1 else now[:0]
        else:
            self.hashes = {n: np.empty(0, U64) for n in range(1, LONGEST + 1)}
        # By length: the places where a phrase that may be frequent begins.
        self.places: dict[int, np.ndarray] = {}

    def look(self, sizes: tuple[int, ...]) -> None:
        """Places of phrases of these lengths within a piece, all of whose phrases of the last length found have survived."""
        shorter = max(self.places, default=0)
        for n in sizes:
            if len(self.ids) < n:
                self.places[n] = np.empty(0, np.int64)
                continue
            whole = self.piece[: len(self.ids) - n + 1] == self.piece[n - 1 :]
            if shorter:
                alive = np.zeros(len(self.ids) - shorter + 1, bool)
                alive[self.places[shorter]] = True
                for k in range(n - shorter + 1):
                    whole &= alive[k : k + len(whole)]
            self.places[n] = np.flatnonzero(whole)

    def keys(self, sizes: tuple[int, ...], mask: np.uint64) -> np.ndarray:
        return np.concatenate([self.hashes[n][self.places[n]] for n in sizes]) & mask

    def settle(self, sizes: tuple[int, ...], mask: np.uint64, answers: list[dict] | None, buckets: int) -> None:
        """Keep the places whose phrases survive."""
        keys = self.keys(sizes, mask)
        order, heads = _groups(keys)
        sent = keys[order[heads]]
        chosen = packed.receive(answers, sent, buckets)
        kept = np.empty(len(keys), bool)
        kept[order] = np.repeat(chosen, np.diff(np.append(heads, len(keys))))
        begin = 0
        for n in sizes:
            end = begin + len(self.places[n])
            self.places[n] = self.places[n][kept[begin:end]]
            begin = end

    def phrases(self, places: np.ndarray, n: int) -> list[bytes]:
        words = self.words
        if n == 1:
            return [words[w] for w in self.ids[places].tolist()]
        return [b" ".join([words[w] for w in row]) for row in self.ids[places[:, None] + np.arange(n)].tolist()]

    def counted(self) -> tuple[np.ndarray, pa.RecordBatch]:
        """Exact counts of the survivors by language, length and text, and of all words as length 0; beside them their hashes."""
        found: list[tuple[np.ndarray, np.ndarray, int, list[bytes], np.ndarray]] = []
        totals = np.bincount(self.lang, minlength=len(self.langs))
        told = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], U64)
        found.append((told, np.arange(len(self.langs)), 0, [b""] * len(self.langs), totals))
        for n, places in self.places.items():
            order, heads = _groups(self.hashes[n][places])
            places = places[order]
            counts = np.diff(np.append(heads, len(places)))
            same = self.lang[places[1:]] == self.lang[places[:-1]]
            for k in range(n):
                same &= self.ids[places[1:] + k] == self.ids[places[:-1] + k]
            same = np.append(True, same)
            same[heads] = True
            if not same.all():  # different phrases of one hash: such groups are counted one by one
                mixed = np.add.reduceat(~same, heads) > 0
                apart = places[np.repeat(mixed, counts)]
                texts = Counter(zip(self.hashes[n][apart].tolist(), self.lang[apart].tolist(), self.phrases(apart, n)))
                keys, langs, spelled = zip(*texts)
                found.append((np.array(keys, U64), np.array(langs), n, list(spelled), np.array(list(texts.values()))))
                heads, counts = heads[~mixed], counts[~mixed]
            first = places[heads]
            found.append((self.hashes[n][first], self.lang[first], n, self.phrases(first, n), counts))
        hashes, langs, sizes, spelled, counts = zip(*found)
        batch = pa.RecordBatch.from_pydict(
            {
                "lang": pa.array(self.langs, pa.string()).take(pa.array(np.concatenate(langs).astype(np.int64))),
                "size": pa.array(np.repeat(sizes, [len(x) for x in spelled]), pa.int32()),
                "phrase": pa.array([p for part in spelled for p in part], pa.binary()).cast(pa.string()),
                "n": pa.array(np.concatenate(counts), pa.int64()),
            }
        )
        return np.concatenate(hashes), batch


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and where each group begins in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(keys)])


COUNTED = "lang string, size int, phrase string, n long"


def _dealt(hashes: np.ndarray, batch: pa.RecordBatch, buckets: int) -> pa.RecordBatch:
    """One row per hash partition with the counts that belong there."""
    order = np.argsort(hashes)
    batch = batch.take(pa.array(order))
    cut = packed._bounds(hashes[order], buckets)
    full = np.flatnonzero(np.diff(cut))
    parts = [packed.pack_batch(batch.slice(cut[b], cut[b + 1] - cut[b])) for b in full]
    return pa.RecordBatch.from_pydict({"bucket": pa.array(full, pa.int32()), "payload": pa.array(parts, pa.binary())})


def _narrow(keys: np.ndarray) -> bytes:
    """Sorted numbers as their differences, byte by byte of the same weight, compressed."""
    planes = np.diff(keys, prepend=U64(0)).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def _widened(payload: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(payload, count * 8, "zstd"), np.uint8).reshape(8, count)
    return np.cumsum(np.ascontiguousarray(planes.T).view(U64).ravel(), dtype=U64)


SENT = "bucket int, chunk long, size long, keys binary, counts binary"


def _send(chunk: int, keys: np.ndarray, shift: np.uint64, buckets: int) -> pa.RecordBatch:
    """One row per hash partition: the chunk's distinct keys there and their counts."""
    keys, counts = np.unique(keys, return_counts=True)
    cut = packed._bounds(keys, buckets)
    full = np.flatnonzero(np.diff(cut))
    parts = [slice(cut[b], cut[b + 1]) for b in full]
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(full, pa.int32()),
            "chunk": pa.array([chunk] * len(parts), pa.int64()),
            "size": pa.array([p.stop - p.start for p in parts], pa.int64()),
            "keys": pa.array([_narrow(keys[p] >> shift) for p in parts], pa.binary()),
            "counts": pa.array([_narrow(np.cumsum(counts[p], dtype=U64)) for p in parts], pa.binary()),
        }
    )


class Summary:
    """A Misra-Gries summary: what it holds of a key is less than the key's count by ``lost`` at most."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.empty(0, U64), np.empty(0, np.int64)

    def merge(self, keys: list[np.ndarray], counts: list[np.ndarray]) -> None:
        """Take in other summaries (with nothing lost)."""
        self.keys, place = np.unique(np.concatenate([self.keys, *keys]), return_inverse=True)
        self.counts = np.bincount(place, np.concatenate([self.counts, *counts])).astype(np.int64)
        if len(self.keys) > self.capacity:
            beyond = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            left = self.counts > beyond
            self.keys, self.counts, self.lost = self.keys[left], self.counts[left] - beyond, self.lost + beyond

    def reaching(self, least: int) -> np.ndarray:
        """All keys whose count may be ``least`` or more."""
        return self.keys[self.counts + self.lost >= least]


def frequent(arrays: list[tuple[np.ndarray, np.ndarray]], least: int, slack: int) -> np.ndarray:
    """Keys of one partition that may occur ``least`` times, in order; all that do are among them."""
    capacity = slack * (sum(int(counts.sum()) for _, counts in arrays) // least + 1)
    summary, waiting, size = Summary(capacity), [], 0
    for part in arrays:
        waiting.append(part)
        size += len(part[0])
        if size > 2 * capacity:
            summary.merge(*map(list, zip(*waiting)))
            waiting, size = [], 0
    if waiting:
        summary.merge(*map(list, zip(*waiting)))
    return summary.reaching(least)


def _survivors(sent: DataFrame, least: int, slack: int) -> DataFrame:
    """Per chunk, which of the keys it sent may be frequent."""

    def of_bucket(table: pa.Table) -> pa.Table:
        sizes = table["size"].to_pylist()
        keys = [_widened(k, n) for k, n in zip(table["keys"].to_pylist(), sizes)]
        counts = [np.diff(_widened(c, n), prepend=U64(0)).astype(np.int64) for c, n in zip(table["counts"].to_pylist(), sizes)]
        chosen = frequent(list(zip(keys, counts)), least, slack)
        ends = np.append(chosen, U64(2**64 - 1))
        told = [packed.squeeze(ends[np.searchsorted(chosen, k)] == k) for k in keys]
        return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "answer": pa.array(told, pa.binary())})

    return packed.per_chunk(sent.groupBy("bucket").applyInArrow(of_bucket, "chunk long, bucket int, answer binary"))


def frequent_phrases(docs: DataFrame, least: int = 100, slack: int = 8, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """``lang``, ``size``, ``phrase``, ``n``: exact counts of all phrases of up to ``LONGEST`` words that occur ``least`` times.

    Size 0 has the number of words of the language.
    """
    rows = docs.select(
        F.col(text_column).cast("string").alias("text"),
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        for n, part in enumerate(sliced(batches, "text", CHUNK_BYTES)):
            row, words = _tokenize(part)
            yield pa.RecordBatch.from_pydict(
                {"chunk": [task + n], "words": [words], "payload": pa.array([packed.pack_batch(row)], pa.binary())}
            )

    # Kept by chunk, so that only the answers move.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    staged = packed.co_located(rows.mapInArrow(cut, "chunk long, words long, payload binary"), parts, shuffle=True)
    words = staged.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    # A hash among all keys meets another with a chance of 1 in 256.
    shift = U64(max(0, 56 - (2 * words + 1).bit_length()))
    mask = U64(2**64 - (1 << int(shift)))
    buckets = max(parts, 2 * words // BUCKET_KEYS + 1)

    def replay(row: dict, upto: int) -> _Chunk:
        chunk = _Chunk(row["payload"])
        for n, sizes in enumerate(STEPS[:upto]):
            chunk.look(sizes)
            chunk.settle(sizes, mask, row[f"step{n}"], buckets)
        return chunk

    def send(upto: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    row = batch.slice(n, 1).to_pylist()[0]
                    chunk = replay(row, upto)
                    chunk.look(STEPS[upto])
                    yield _send(row["chunk"], chunk.keys(STEPS[upto], mask), shift, buckets)

        return run

    answered = staged.drop("words")
    for n in range(len(STEPS)):
        sent = answered.mapInArrow(send(n), SENT)
        answered = packed.with_answers(answered, packed.co_located(_survivors(sent, least, slack), parts), f"step{n}")

    tallies = buckets // TALLIES + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                yield _dealt(*replay(batch.slice(n, 1).to_pylist()[0], len(STEPS)).counted(), tallies)

    def add(table: pa.Table) -> pa.Table:
        rows = pa.Table.from_batches([packed.unpack_batch(p) for p in table["payload"].to_pylist()])
        total = rows.group_by(["lang", "size", "phrase"]).aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
        return total.filter((pc.field("size") == 0) | (pc.field("n") >= least)).select(["lang", "size", "phrase", "n"])

    return stage(answered.mapInArrow(count, "bucket int, payload binary").groupBy("bucket").applyInArrow(add, COUNTED))


def collocations(
    docs: DataFrame,
    least: int = 100,
    top: int = 2000,
    covered_percent: int = 100,
    slack: int = 8,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    counts = frequent_phrases(docs, least, slack, text_column, lang_column)
    candidates = counts.filter("size >= 2").withColumnRenamed("n", "a").withColumn("words", F.split("phrase", " "))
    scored = _scored(candidates.drop("size"), counts.filter("size >= 1").drop("size"), counts.filter("size = 0").select("lang", "n"))
    kept = scored.join(_covered(candidates, covered_percent), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    few = kept.withColumn("part", part)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _scored(candidates: DataFrame, counts: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
    sides = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.expr("array_join(slice(words, 1, k), ' ')").alias("first"),
        F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("rest"),
    )
    sides = sides.join(counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    sides = sides.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    big = {c: F.col(c).cast("decimal(19,0)") for c in "alrn"}
    over, under = big["a"] * 1000 * big["n"], big["l"] * big["r"]
    sides = sides.join(totals, "lang").withColumns({"over": over, "under": under}).withColumn("score", F.expr("over div under"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    lowest = sides.groupBy("lang", "phrase", "a", "n").agg(best)
    return lowest.select("lang", "phrase", "a", "n", "best.score", "best.l", "best.r")


def _covered(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates that lie inside a longer one with at least that share of their occurrences."""
    inner = """flatten(transform(sequence(2, size(words) - 1), n ->
        transform(sequence(1, size(words) - n + 1), i -> array_join(slice(words, i, n), ' '))))"""
    inside = candidates.filter("size > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), F.col("a").alias("longer"))
    most = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    big = F.col("longer").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(28,0)") * percent
    return candidates.join(most, ["lang", "phrase"]).filter(big).select("lang", "phrase")
