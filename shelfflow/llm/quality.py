"""Quality rules: counts over the whole text, then a linear-chain CRF over its lines.

A text fails the counts if it has fewer than ``min_words`` words or if too many of them lie in repeated windows. For the
others, every line with a word is described by yes-or-no features (length, symbols, capitals, repeats, place) and
Viterbi decoding of a two-state linear-chain conditional random field marks it as content or
boilerplate. A text is kept if at least ``min_content`` of its words are in content lines.

The CRF is trained on a bounded sample of labelled documents, the ``sample_docs`` with the smallest hashes of their
ids and of each the first ``sample_lines`` lines with a word; a document's quality label stands for its lines. Only this fit uses
a sample: counting and decoding cover all lines of all texts.

Defined cases: a NULL or empty text has no words and fails. Lines that are blank have no state; a repeated line is compared
as it stands. Labels that are NULL are left out, of several for one id the lowest counts. If the sample lacks good or
bad documents, there is nothing to learn and all lines are content. Rows with the same id are judged one by one, each by its own text.
All columns come out; the results are added as ``<prefix>...`` and replace columns of that name. An empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfflow.llm.text import U64, byte_sums, flat, mix, sliced, text_hashes, window_hashes, window_starts, words

# The symbols that count.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEATURES = [
    "always", "1 word", "2-3 words", "4-7 words", "8-20 words", "over 20 words", "no symbol", "few symbols",
    "many symbols", "symbols everywhere", "capitals", "exclamation marks", "bars", "ends a sentence", "some repeated words",
    "mostly repeated words", "repeats a line", "digits", "long words", "first", "last",
]


def _class_counts(data: np.ndarray, chars: bytes, edges: np.ndarray) -> np.ndarray:
    """Bytes out of ``chars`` in each span between neighbouring edges."""
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return np.diff(np.searchsorted(np.flatnonzero(table[data]), edges))


class Described:
    """Counts of each text of a slice, and the features of its lines with a word."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        n = len(offsets) - 1
        starts, ends, first = words(data, offsets)
        self.n_words = np.diff(first)
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        chars = points[ends] - points[starts]
        before = np.concatenate([[0], np.cumsum(chars)])
        self.word_chars = before[first[1:]] - before[first[:-1]]
        self.n_symbols = _class_counts(data, SYMBOLS, offsets)
        sums = byte_sums(data)
        tokens = text_hashes(data, sums, starts, ends)
        self.n_repeat_words = self._repeat_words(tokens, first, n)

        # Lines: a text begins one, and so does every byte after a line feed.
        feeds = np.flatnonzero(data == 10)
        begin = np.sort(np.concatenate([offsets[:-1], feeds + 1]))
        text = np.repeat(np.arange(n), 1 + np.diff(np.searchsorted(feeds, offsets)))
        end = np.minimum(np.append(begin[1:] - 1, offsets[-1]), offsets[1:][text])
        last_of_text = np.append(text[1:] != text[:-1], True) if len(text) else np.zeros(0, bool)
        end[last_of_text] = offsets[1:][text[last_of_text]]
        lows = np.searchsorted(starts, begin)
        counts = np.searchsorted(starts, end) - lows
        used = np.flatnonzero(counts)
        begin, end, text, lows, counts = begin[used], end[used], text[used], lows[used], counts[used]
        self.line_text, self.line_words = text, counts
        key = mix(text_hashes(data, sums, begin, end) ^ mix(text.astype(U64)))
        _, firsts = np.unique(key, return_index=True)
        duplicate = np.ones(len(key), bool)
        duplicate[firsts] = False
        self.n_dup_lines = np.bincount(text[duplicate], minlength=n)
        self.features = self._features(data, begin, end, text, lows, counts, tokens, duplicate, points)

    @staticmethod
    def _repeat_words(tokens: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
        at = window_starts(first, WINDOW)
        if not len(at):
            return np.zeros(n, np.int64)
        owner = np.searchsorted(first, at, "right") - 1
        key = mix(window_hashes(tokens, WINDOW)[at] ^ mix(owner.astype(U64)))
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
        again = at[count[place] > 1]
        edges = np.zeros(len(tokens) + 1, np.int64)
        edges[again] += 1
        edges[again + WINDOW] -= 1
        covered = np.concatenate([[0], np.cumsum(np.cumsum(edges)[:-1] > 0)])
        return covered[first[1:]] - covered[first[:-1]]

    @staticmethod
    def _features(data, begin, end, text, lows, counts, tokens, duplicate, points) -> np.ndarray:
        if not len(begin):
            return np.zeros((0, len(FEATURES)), bool)
        spans = np.stack([begin, end], axis=1).ravel()

        def of(chars: bytes) -> np.ndarray:
            return _class_counts(data, chars, spans)[::2] / counts

        size = np.maximum(points[end] - points[begin], 1)
        symbols, capitals = of(SYMBOLS), of(bytes(range(65, 91))) * counts / size
        same = np.zeros(len(tokens) + 1, np.int64)
        same[2:] = np.cumsum(tokens[1:] == tokens[:-1])
        repeats = (same[lows + counts] - same[lows + 1]) / counts
        closing = np.zeros(256, bool)
        closing[list(b".!?\"')")] = True
        tail = data[np.maximum(end - 1, 0)]
        first = np.append(True, text[1:] != text[:-1])
        columns = [
            np.ones(len(begin), bool), counts == 1, (counts > 1) & (counts < 4), (counts > 3) & (counts < 8),
            (counts > 7) & (counts < 21), counts > 20, symbols == 0, (symbols > 0) & (symbols <= 0.1),
            (symbols > 0.1) & (symbols <= 0.5), symbols > 0.5, capitals > 0.4, of(b"!") > 0.3, of(b"|") > 0, closing[tail],
            (repeats > 0.1) & (repeats <= 0.5), repeats > 0.5, duplicate, of(b"0123456789") * counts / size > 0.2,
            size / counts > 14, first, np.append(first[1:], True),
        ]
        return np.stack(columns, axis=1)


@dataclass
class LineModel:
    """A linear chain with the states 0 (boilerplate) and 1 (content)."""

    emission: np.ndarray  # features x states
    transition: np.ndarray  # from x to

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The likeliest states of one text's lines; at a tie the content state."""
        own = (features @ self.emission).tolist()
        (a, b), (c, d) = self.transition.tolist()
        back = []
        zero, one = own[0]
        for e0, e1 in own[1:]:
            from0, from1 = one + c >= zero + a, one + d >= zero + b
            back.append((from0, from1))
            zero, one = (one + c if from0 else zero + a) + e0, (one + d if from1 else zero + b) + e1
        state = one >= zero
        states = [state]
        for from0, from1 in reversed(back):
            state = from1 if state else from0
            states.append(state)
        return np.array(states[::-1])


def all_content() -> LineModel:
    emission = np.zeros((len(FEATURES), 2))
    emission[0, 1] = 1
    return LineModel(emission, np.zeros((2, 2)))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(sequences: list[np.ndarray], labels: list[int], steps: int = 40, rate: float = 0.2, decay: float = 1e-3) -> LineModel:
    """Maximum likelihood by forward-backward and Adam; all lines of a sequence have its label."""
    if len(set(labels)) < 2:
        return all_content()
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    sequences, labels = [sequences[i] for i in order], np.array([labels[i] for i in order])
    lengths = np.array([len(s) for s in sequences])
    longest, n = lengths[0], len(sequences)
    x = np.zeros((longest, n, len(FEATURES)), np.float32)
    for i, s in enumerate(sequences):
        x[: len(s), i] = s
    alive = [int((lengths > t).sum()) for t in range(longest)]
    mask = np.arange(longest)[:, None] < lengths[None, :]
    # Each class of documents weighs the same.
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum()) / lengths.mean()
    gold = np.zeros((longest, n, 2), np.float32)
    gold[:, np.arange(n), labels] = 1
    gold *= mask[:, :, None]
    stays = np.zeros((2, 2))
    for label in (0, 1):
        stays[label, label] = ((lengths - 1) * share)[labels == label].sum()
    parameters = np.zeros(len(FEATURES) * 2 + 4)
    moment, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        emission, transition = parameters[:-4].reshape(-1, 2), parameters[-4:].reshape(2, 2)
        own = x @ emission
        forward, backward = np.zeros((longest, n, 2)), np.zeros((longest, n, 2))
        forward[0] = own[0]
        for t in range(1, longest):
            k = alive[t]
            forward[t, :k] = own[t, :k] + _logsumexp(forward[t - 1, :k, :, None] + transition, 1)
        for t in range(longest - 2, -1, -1):
            k = alive[t + 1]
            backward[t, :k] = _logsumexp((transition + (own[t + 1, :k] + backward[t + 1, :k])[:, None, :]), 2)
        total = _logsumexp(forward[lengths - 1, np.arange(n)], 1)
        marginal = np.exp(np.minimum(forward + backward - total[:, None], 0)) * mask[:, :, None]
        slope = np.einsum("tnf,tns->fs", x, (gold - marginal) * share[:, None])
        moves = np.zeros((2, 2))
        for t in range(1, longest):
            k = alive[t]
            both = forward[t - 1, :k, :, None] + transition + (own[t, :k] + backward[t, :k])[:, None, :] - total[:k, None, None]
            moves += (np.exp(np.minimum(both, 0)) * share[:k, None, None]).sum(axis=0)
        gradient = np.concatenate([slope.ravel(), (stays - moves).ravel()]) - decay * parameters
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        parameters += rate * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return LineModel(parameters[:-4].reshape(-1, 2).copy(), parameters[-4:].reshape(2, 2).copy())


def train(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, sample_docs: int = 2000, sample_lines: int = 200
) -> LineModel:
    """Fit the line model on a bounded sample of the labelled documents.

    Of a text with more than ``sample_lines`` lines two stretches of that many are learned from: one at a place that follows from its
    id, and its last one.
    """
    chosen = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id")
        .limit(sample_docs)
        .select(F.col("doc_id").alias("__labelled"), "quality")
    )
    # At most sample_docs rows: bounded by the parameter.
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    rows = rows.join(F.broadcast(chosen), rows["id"] == chosen["__labelled"]).select("id", "quality", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = Described(batch.column("text"))
            edges = np.searchsorted(found.line_text, np.arange(batch.num_rows + 1))
            rows = []
            for n, (id_, quality) in enumerate(zip(batch.column("id").cast(pa.string()).to_pylist(), batch.column("quality").to_pylist())):
                first, last = int(edges[n]), int(edges[n + 1])
                begins = [first]
                if last - first > sample_lines:
                    begins = [first + zlib.crc32(id_.encode()) % (last - first - sample_lines), last - sample_lines]
                ends = [min(begin + sample_lines, last) for begin in begins]
                parts = [(end - begin, np.packbits(found.features[begin:end]).tobytes()) for begin, end in zip(begins, ends)]
                rows.append((id_, quality, *parts[0], *(parts[1] if len(parts) > 1 else (0, b""))))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary())
            names = ["id", "quality", "lines", "bits", "last_lines", "last_bits"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    described = "id string, quality int, lines long, bits binary, last_lines long, last_bits binary"
    found = rows.mapInArrow(describe, described).filter("lines > 0")
    # Rows may repeat an id: the text with the least lines counts, so the sample stays bounded and is the same in every run.
    one = F.min(F.struct("quality", "lines", "bits", "last_lines", "last_bits")).alias("text")
    texts = [r.text for r in sorted(found.groupBy("id").agg(one).collect(), key=lambda r: r.id)]
    parts = [(t.quality, lines, bits) for t in texts for lines, bits in ((t.lines, t.bits), (t.last_lines, t.last_bits)) if lines]
    width = len(FEATURES)
    sequences = [np.unpackbits(np.frombuffer(bits, np.uint8), count=lines * width).reshape(-1, width) for _, lines, bits in parts]
    return fit(sequences, [int(quality > 0) for quality, _, _ in parts])


def assess(
    docs: DataFrame,
    model: LineModel,
    text_column: str = "text",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    min_content: float = 0.5,
    prefix: str = "",
) -> DataFrame:
    """The rows with their counts, ``base_failed``, ``content_share`` (of words) and ``kept``."""
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kinds = {c: T.LongType() for c in counts} | {
        "base_failed": T.BooleanType(), "content_share": T.DoubleType(), "kept": T.BooleanType()
    }
    kept_columns = docs.drop(*[f"{prefix}{c}" for c in kinds])
    names = kept_columns.columns
    schema = T.StructType([*kept_columns.schema.fields, *[T.StructField(f"{prefix}{c}", k) for c, k in kinds.items()]])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, text_column):
            found = Described(batch.column(text_column))
            failed = (found.n_words < min_words) | (100 * found.n_repeat_words > max_repeat_percent * found.n_words)
            edges = np.searchsorted(found.line_text, np.arange(batch.num_rows + 1))
            share = np.zeros(batch.num_rows)
            for n in np.flatnonzero(found.n_words > 0):
                lines = slice(edges[n], edges[n + 1])
                content = model.decode(found.features[lines])
                share[n] = (found.line_words[lines] * content).sum() / found.n_words[n]
            values = [pa.array(getattr(found, c).astype(np.int64)) for c in counts]
            values += [pa.array(failed), pa.array(share), pa.array(~failed & (share >= min_content))]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], *values], names=[*names, *[f"{prefix}{c}" for c in kinds]]
            )

    return kept_columns.mapInArrow(judge, schema)


def apply_quality_rules(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", **rules
) -> DataFrame:
    """Train the line model on the labelled documents and assess all of them."""
    return assess(docs, train(docs, labels, id_column, text_column), text_column, **rules)
