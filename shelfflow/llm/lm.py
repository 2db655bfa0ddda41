"""Scoring texts with a gated recurrent language model.

Tokens are the words of a text, A-Z in lower case, and one end. The training rows are counted as a whole: how often each
word occurs, exchanged as packed arrays. From the counts follow the unigram base score and the model's
symbols: the end, the ``frequent`` most frequent words, and ``BUCKETS`` buckets of all other words by their last two bytes. A
word in a bucket has, given the bucket, a share by its count, with 0.1 added for each word and for unseen
ones together; so every text has a proper probability, whatever its words.

The network (``gru``) reads symbols. It starts from one chunk of training texts, read a few times in one task. From there every
task trains on its own chunks, all training rows being read once, and the weighted mean of the tasks' parameters is the model. Texts
are scored as a whole, the state carried through all of their windows.

Held-out rows only receive scores. Defined cases: a NULL or empty text is an end alone. A NULL id counts as the empty text
for the split. Repeated rows are counted and scored as often as they occur. Without any training row, counts are 0 and the model is untrained. Other
columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.llm import gru, packed, sums
from shelfflow.llm.language import held_out
from shelfflow.llm.text import LOWER, U64, byte_sums, flat, sliced, text_hashes, words
from shelfflow.sources.staging import stage

BUCKETS = 128
ADDED = 0.1
SUMMARY = -1
# Symbols read side by side at a time; two bytes each.
BATCH_SYMBOLS = 4_000_000
_LN10 = np.log(10.0)


class Tokens:
    """Word keys of a chunk: 57 bits of hash, and the word's bucket in the lowest seven."""

    def __init__(self, batch: pa.RecordBatch):
        keys, first = [np.empty(0, U64)], [np.zeros(1, np.int64)]
        for part in sliced([batch], "text"):
            data, offsets = flat(part.column("text"))
            data = LOWER[data]
            starts, ends, firsts = words(data, offsets)
            tail = data[ends - 1].astype(np.int64) * 31 + np.where(ends - starts > 1, data[ends - 2], 0)
            hashes = text_hashes(data, byte_sums(data), starts, ends)
            keys.append(hashes & ~U64(BUCKETS - 1) | (tail * 0x9E37 >> 4).astype(U64) & U64(BUCKETS - 1))
            first.append(firsts[1:] + first[-1][-1])
        self.keys, self.first = np.concatenate(keys), np.concatenate(first)
        self.distinct, self.place = np.unique(self.keys, return_inverse=True)
        trains = ~batch.column("apart").to_numpy(zero_copy_only=False)
        self.trained = np.bincount(self.place[np.repeat(trains, np.diff(self.first))], minlength=len(self.distinct))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield batch.slice(n, 1).to_pylist()[0]


def _counted(staged: DataFrame, buckets: int, frequent: int) -> DataFrame:
    """Staged: for each chunk and bucket the total counts of its words, and a summary of each bucket (as chunk -1)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            tokens = Tokens(packed.unpack_batch(row["payload"]))
            yield packed.send(row["chunk"], tokens.distinct, tokens.trained, buckets)

    def of_bucket(table: pa.Table) -> pa.Table:
        sizes, keys, counts, place = packed.totals(table)
        parts = np.split(counts[place], np.cumsum(sizes)[:-1])
        answers = [packed.squeeze(p) for p in parts]
        low = (keys & U64(BUCKETS - 1)).astype(np.int64)
        known = np.bincount(low[counts > 0], minlength=BUCKETS)
        total = np.bincount(low, counts, BUCKETS).astype(np.int64)
        top = np.lexsort((keys, -counts))[:frequent]
        summary = np.concatenate([known, total, keys[top].view(np.int64), counts[top]])
        bucket = table["bucket"][0].as_py()
        return pa.table(
            {
                "chunk": pa.array(table["chunk"].to_pylist() + [SUMMARY], pa.int64()),
                "bucket": pa.array([bucket] * (len(answers) + 1), pa.int32()),
                "answer": pa.array(answers + [summary.tobytes()], pa.binary()),
            }
        )

    sent = staged.select("chunk", "payload").mapInArrow(count, packed.SENT)
    return stage(sent.groupBy("bucket").applyInArrow(of_bucket, "chunk long, bucket int, answer binary"))


class Vocabulary:
    """The frequent words with their counts, and what the buckets of the others add up to."""

    def __init__(self, counted: DataFrame, ends: int, frequent: int):
        self.ends, self.words, self.tokens = ends, 0, ends
        self.distinct = 1 if ends else 0
        known, total = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        keys, counts = np.empty(0, U64), np.empty(0, np.int64)
        for row in counted.filter(F.col("chunk") == SUMMARY).select("answer").toLocalIterator():
            numbers = np.frombuffer(row.answer, np.int64)
            known += numbers[:BUCKETS]
            total += numbers[BUCKETS : 2 * BUCKETS]
            own_keys, own_counts = np.split(numbers[2 * BUCKETS :], 2)
            keys, counts = np.concatenate([keys, own_keys.view(U64)]), np.concatenate([counts, own_counts])
            best = np.lexsort((keys, -counts))[:frequent]
            keys, counts = keys[best], counts[best]
        self.tokens += int(total.sum())
        self.distinct += int(known.sum())
        keys, counts = keys[counts > 0], counts[counts > 0]
        low = (keys & U64(BUCKETS - 1)).astype(np.int64)
        self.rest = total - np.bincount(low, counts, BUCKETS).astype(np.int64)
        self.rest_words = known - np.bincount(low, minlength=BUCKETS)
        by_key = np.argsort(keys)
        self.keys, self.rank = keys[by_key], by_key + 1
        self.symbols = 1 + len(keys) + BUCKETS
        self.symbol_counts = np.concatenate([[ends], counts, self.rest])

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))

    def symbols_of(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol of each distinct word, and the logarithm of the word's share of it."""
        low = (keys & U64(BUCKETS - 1)).astype(np.int64)
        symbol = 1 + len(self.keys) + low
        share = np.log10((counts + ADDED) / (self.rest[low] + ADDED * (self.rest_words[low] + 1)))
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            listed = self.keys[at] == keys
            symbol[listed] = self.rank[at[listed]]
            share[listed] = 0
        return symbol.astype(np.uint16), share


def _encoded(staged: DataFrame, counted: DataFrame, vocabulary: Vocabulary, buckets: int, kind: str) -> DataFrame:
    """Staged: a row per chunk with its documents' counts, base scores and symbols."""
    shared = staged.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        end_base = known.base(np.array([known.ends]))[0]
        for row in _each(batches):
            batch = packed.unpack_batch(row["payload"])
            tokens = Tokens(batch)
            counts = packed.receive(row["counts"], tokens.distinct, buckets, np.int64)
            symbol, share = known.symbols_of(tokens.distinct, counts)
            n = len(tokens.first) - 1
            owner = np.repeat(np.arange(n), np.diff(tokens.first))
            per_word = tokens.place
            out = pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "apart": batch.column("apart"),
                    "n_tokens": pa.array(np.diff(tokens.first) + 1),
                    "n_known": pa.array(np.bincount(owner[counts[per_word] > 0], minlength=n) + (known.ends > 0)),
                    "base": pa.array(np.bincount(owner, known.base(counts)[per_word], n) + end_base),
                    "share": pa.array(np.bincount(owner, share[per_word], n)),
                    "symbols": pa.LargeListArray.from_arrays(pa.array(tokens.first), pa.array(symbol[per_word])),
                }
            )
            yield pa.RecordBatch.from_pydict(
                {"chunk": [row["chunk"]], "payload": pa.array([packed.pack_batch(out)], pa.binary())}
            )

    answered = packed.with_answers(staged, packed.per_chunk(counted.filter(F.col("chunk") != SUMMARY)), "counts")
    return stage(answered.select("chunk", "payload", "counts").mapInArrow(encode, "chunk long, payload binary"))


def _documents(batch: pa.RecordBatch, chosen: np.ndarray | None = None) -> list[np.ndarray]:
    column = batch.column("symbols")
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    rows = range(batch.num_rows) if chosen is None else np.flatnonzero(chosen)
    return [values[offsets[i] : offsets[i + 1]] for i in rows]


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The chunks of a task, some at a time: a long text then has many others beside it."""
    held, size = [], 0
    for row in _each(batches):
        held.append(packed.unpack_batch(row["payload"]))
        size += len(held[-1].column("symbols").values)
        if size >= BATCH_SYMBOLS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _training(batch: pa.RecordBatch) -> list[np.ndarray]:
    return _documents(batch, ~batch.column("apart").to_numpy(zero_copy_only=False))


def _first_weights(encoded: DataFrame, shape: gru.Shape, start: np.ndarray, passes: int, rate: float) -> np.ndarray:
    """Trained in one task on the chunk with the lowest number: a bounded sample to start from."""
    lowest = encoded.agg(F.min("chunk")).first()[0]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _each(batches):
            trainer = gru.Trainer(shape, start, rate)
            documents = _training(packed.unpack_batch(row["payload"]))
            for _ in range(passes):
                trainer.learn(documents, lanes=64)
            yield pa.RecordBatch.from_pydict({"flat": pa.array([trainer.flat.tobytes()], pa.binary())})

    rows = encoded.filter(F.col("chunk") == lowest).mapInArrow(learn, "flat binary").collect()
    return np.frombuffer(rows[0].flat, np.float32) if rows else start


def _trained(encoded: DataFrame, shape: gru.Shape, start: np.ndarray, rate: float) -> np.ndarray:
    """Every task trains from the same weights on all its training rows; the mean weighs each by what it read."""
    shared = encoded.sparkSession.sparkContext.broadcast(start)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, read = gru.Trainer(shape, shared.value, rate), 0
        for held in _together(batches):
            read += trainer.learn([d for batch in held for d in _training(batch)], lanes=256)
        if read:
            pieces = np.array_split(trainer.flat.astype(np.float64) * read, 16)
            yield sums.partial({**dict(enumerate(pieces)), 16: np.array([read])})

    found = sums.summed(encoded.mapInArrow(learn, sums.PARTIAL))
    if not found:
        return start
    return (np.concatenate([found[n] for n in range(16)]) / found[16][0]).astype(np.float32)


def score_texts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    modulus: int = 10,
    remainder: int = 0,
    frequent: int = 895,
    hidden: int = 16,
    classes: int = 32,
    first_passes: int = 3,
    first_rate: float = 0.01,
    rate: float = 0.004,
) -> DataFrame:
    """Every row as ``id_column``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Scores are log10 probabilities of the whole text. Rows whose hashed id leaves ``remainder`` are held out.
    """
    apart = held_out(F.col(id_column), modulus, remainder)
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), apart.alias("apart"))
    kind = rows.schema["id"].dataType.simpleString()
    staged = packed.chunks(rows, "text", chunk_bytes=8 << 20)
    ends = rows.filter(~F.col("apart")).count()
    buckets = packed.bucket_count(staged, 0.5)
    counted = _counted(staged, buckets, frequent)
    vocabulary = Vocabulary(counted, ends, frequent)
    encoded = _encoded(staged, counted, vocabulary, buckets, kind)
    shape = gru.Shape(vocabulary.symbols, hidden, classes)
    first = _first_weights(encoded, shape, shape.start(vocabulary.symbol_counts), first_passes, first_rate)
    shared = docs.sparkSession.sparkContext.broadcast(_trained(encoded, shape, first, rate))
    train_tokens = vocabulary.tokens

    def scored(held: list[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        found = gru.score(shape, shared.value, [d for batch in held for d in _documents(batch)])
        return zip(held, np.split(found, np.cumsum([batch.num_rows for batch in held])[:-1]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in (pair for held in _together(batches) for pair in scored(held)):
            found = scores / _LN10 + batch.column("share").to_numpy()
            yield pa.RecordBatch.from_pydict(
                {
                    "id": batch.column("id"),
                    "held_out": batch.column("apart"),
                    "n_tokens": batch.column("n_tokens"),
                    "n_known": batch.column("n_known"),
                    "train_tokens": pa.array(np.full(batch.num_rows, train_tokens, np.int64)),
                    "base_score": batch.column("base"),
                    "score": pa.array(found),
                }
            )

    columns = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return encoded.mapInArrow(score, f"id {kind}, {columns}").withColumnRenamed("id", id_column)
