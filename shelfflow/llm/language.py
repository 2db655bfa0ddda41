"""Language identification by the nearest of several centroids per language.

A text is the vector of its letter trigrams: letters in lower case, every run of other characters one
space, trigrams hashed into ``DIMENSIONS``, weight (1 + log of the count) times log of the inverse share of training
documents that have it, scaled to length one.

Training covers all rows with a text and a language that are not held out. Their trigrams are counted once and staged, packed, in
the shared folder; all passes below read those. The document frequencies come first; then each
language gets ``centroids`` clusters: seeds are its documents with the smallest hash, and a fixed number of
rounds assigns every training document to the nearest centroid of its own language and averages. Each task sums
its vectors per centroid; only sums travel.

A text gets the language of the centroid with the greatest cosine. It is rejected as too far from all of them

* if its distance (one minus the cosine) exceeds the median of that language's training texts of similar length by more than
  ``tolerance`` deviations, taken as 1.4826 times the median absolute deviation and at least ``LEAST``: a minority of junk among
  the training rows moves neither. Length is the number of distinct trigrams, on which the distance depends; a word said a
  thousand times is short. A last round over all training rows counts the distances in histograms, each text left out
  of its own centroid. Every length has a limit at every number of rows: neighbours fill up for lengths with few texts;
* or if it is no closer than as many random trigrams would be, by ``CHANCE`` standard deviations;
* or if it has no letters.

Languages are bounded by ``max_languages``, so everything that is broadcast has a bounded size.

Defined cases: a NULL text or one without letters is ``und`` with score 0, and rejected. A NULL id counts as the empty text for the
split. Without any training row every text is ``und``. Ties go to the first language in code-point order. Repeated rows count as often as they occur.
All columns come out; ``<prefix>lang_pred``, ``score``, ``held_out`` and ``rejected`` are added and replace columns of that
name. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfflow.llm import packed, sums
from shelfflow.llm.text import sliced
from shelfflow.sources.staging import stage

DIMENSIONS = 8192
# Classes of length, two for each doubling of the distinct trigrams, and steps of the distance in a histogram.
SIZES = 27
STEPS = 256
LEAST = 0.03
BORROWED = 30
CHANCE = 4.0
# Texts whose trigrams are held as whole rows at a time.
ROWS = 256


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigram_counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed trigrams, a row per text, and the number of letters of each."""
    joined = "\0" + "\0".join((t or "").lower().replace("\0", " ") for t in texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.cumsum(points == 0) - 1
    letter = _letters()[points]
    n_letters = np.bincount(row[letter], minlength=len(texts))
    # One space before, between and after runs of letters; those between texts belong to both.
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[0] = True
    points, row, letter = np.where(letter, points, 32)[kept].astype(np.uint64), row[kept], letter[kept]
    if len(points) < 3:
        return np.zeros((len(texts), DIMENSIONS), np.int64), n_letters
    mixed = (points[:-2] * np.uint64(0x9E3779B97F4A7C15) + points[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + points[2:]
    place = ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int64)
    owner = np.where(letter[1:-1], row[1:-1], row[:-2])
    own = letter[1:-1] | (row[:-2] == row[2:])
    cells = np.bincount(owner[own] * DIMENSIONS + place[own], minlength=len(texts) * DIMENSIONS)
    return cells.reshape(len(texts), DIMENSIONS), n_letters


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.zeros(counts.shape, np.float32)
    filled = counts > 0
    out[filled] = 1 + np.log(counts[filled])
    out *= idf
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


def _size(distinct: np.ndarray) -> np.ndarray:
    """Texts of similar length: by the logarithm of the number of distinct trigrams."""
    return (2 * np.log2(np.maximum(distinct, 1))).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        for begin in range(0, batch.num_rows, ROWS):
            yield batch.slice(begin, ROWS)


def _median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    running = np.cumsum(weights[order])
    return float(values[order][np.searchsorted(running, running[-1] / 2)])


def _limits(spread: np.ndarray, tolerance: float) -> np.ndarray:
    """The greatest distance of each language and size, from the histograms of the training texts' distances.

    Median and deviation of a size are averaged with those of its neighbours, which weigh ``BORROWED`` texts together: the nearest
    sizes most, the sizes of all languages a thousandth. The half of a text's trigrams has, on average, its
    cosine over the square root of two: so much nearer to zero longer texts stand for shorter ones. Shorter ones stand
    for longer ones as they are.
    """
    if not spread.any():  # a single text in each language
        return np.ones(spread.shape[:2])
    middle = (np.arange(STEPS) + 0.5) / STEPS
    kinds = np.concatenate([spread, spread.sum(axis=0, keepdims=True)])
    texts, cosine, deviation = kinds.sum(axis=2), np.zeros(kinds.shape[:2]), np.zeros(kinds.shape[:2])
    for lang, size in np.argwhere(texts):
        weights = kinds[lang, size]
        median = _median(middle, weights)
        cosine[lang, size] = 1 - median
        deviation[lang, size] = 1.4826 * _median(np.abs(middle - median), weights)
    away = np.arange(SIZES)[:, None] - np.arange(SIZES)[None, :]  # from the size that lends to the one that borrows
    weight, factor = 4.0 ** -np.abs(away), 2.0 ** (np.minimum(away.T, 0) / 4)
    lent = [texts @ weight, (texts * cosine) @ (weight * factor), (texts * deviation) @ (weight * factor)]
    near, cosines, deviations = (x[:-1] + 1e-3 * x[-1] for x in lent)
    own = texts[:-1]
    cosine = (own * cosine[:-1] + BORROWED * cosines / near) / (own + BORROWED)
    deviation = (own * deviation[:-1] + BORROWED * deviations / near) / (own + BORROWED)
    return 1 - cosine + tolerance * np.maximum(deviation, LEAST)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # of length one, those of a language next to each other
    owner: np.ndarray  # the language of each centroid
    farthest: np.ndarray  # by language and size of the text: a greater distance is rejected

    def __post_init__(self):
        """Mean and deviation of what one trigram in a random place adds to the cosine of a text."""
        scale = np.sqrt((self.idf.astype(float) ** 2).mean())
        self.chance = np.array([((c * self.idf).mean() / scale, (c * self.idf).std() / scale) for c in self.centroids]).reshape(-1, 2)

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number (-1: und), cosine and rejection of each text."""
        parts = [self._predict(texts[begin : begin + ROWS]) for begin in range(0, max(len(texts), 1), ROWS)]
        lang, score, rejected = (np.concatenate(p) for p in zip(*parts))
        return lang, score, rejected

    def _predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        counts, n_letters = trigram_counts(texts)
        vectors = _vectors(counts, self.idf)
        known = n_letters > 0
        if not len(self.centroids):
            return np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = vectors @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(float)
        distinct = (counts > 0).sum(axis=1)
        mean, deviation = self.chance[best].T
        by_chance = mean * np.sqrt(distinct) + CHANCE * deviation * np.sqrt(1 - distinct / DIMENSIONS)
        rejected = ~known | (1 - score > self.farthest[self.owner[best], _size(distinct)]) | (score <= by_chance)
        return np.where(known, self.owner[best], -1), np.where(known, score, 0.0), rejected


def held_out(id_column: Column, modulus: int, remainder: int) -> Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))) % modulus == remainder


def train(
    rows: DataFrame, centroids: int = 3, rounds: int = 2, tolerance: float = 6.0, max_languages: int = 1000
) -> Model:
    """Fit on all ``rows`` (``id``, ``text``, ``lang``); NULL texts and languages are left out."""
    spark = rows.sparkSession
    # Seeds: for each language the rows with the smallest hashes of their ids.
    draw = F.xxhash64(F.col("id").cast("string"), F.lit("seed"))
    labelled = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang", draw.alias("draw"))
    staged = stage(labelled.mapInArrow(_pack, "payload binary"))
    languages, idf, seeds = _begin(staged, centroids, max_languages)
    if not languages:
        none = np.zeros((0, DIMENSIONS), np.float32)
        return Model([], np.ones(DIMENSIONS, np.float32), none, np.zeros(0, np.int64), np.ones((0, SIZES)))
    number = {lang: n for n, lang in enumerate(languages)}
    owner = np.repeat(np.arange(len(languages)), centroids)

    def nearest_own(block: _Block, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors, languages and, of each text, the nearest centroid of its language."""
        vectors = block.vectors(idf)
        lang = np.array([number[x] for x in block.langs])
        return vectors, lang, np.where(owner[None, :] == lang[:, None], vectors @ now.T, -1.0).argmax(axis=1)

    before, total = seeds, seeds
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(seeds)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for block in _unpacked(batches):
                vectors, _, nearest = nearest_own(block, shared.value)
                for c in np.unique(nearest).tolist():
                    total[c] = total.get(c, 0) + vectors[nearest == c].sum(axis=0, dtype=np.float64)
            yield sums.partial(total)

        before, found = seeds, sums.collected(staged.mapInArrow(assign, sums.PARTIAL))
        total = np.array([found.get(c, np.zeros(DIMENSIONS)) for c in range(len(owner))])
        empty = ~total.any(axis=1)
        total[empty] = seeds[empty]
        seeds = (total / np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    shared = spark.sparkContext.broadcast((before, total.astype(np.float32)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, total = shared.value
        squares = (total.astype(np.float64) ** 2).sum(axis=1)
        spread: dict[int, np.ndarray] = {}
        for block in _unpacked(batches):
            vectors, lang, member = nearest_own(block, before)
            dot, place = (vectors @ total.T).astype(np.float64), np.arange(len(lang))
            length = np.broadcast_to(squares, dot.shape).copy()
            if rounds:  # the centroid a text belongs to, without the text
                length[place, member] += 1 - 2 * dot[place, member]
                dot[place, member] -= 1
            cosine = np.where(length > 1e-3, dot / np.sqrt(np.maximum(length, 1e-3)), -1.0)
            cosine = np.where(owner[None, :] == lang[:, None], cosine, -1.0).max(axis=1)
            step = np.minimum((np.clip(1 - cosine, 0, 1) * STEPS).astype(np.int64), STEPS - 1)
            # Texts without letters, and such as are alone in their language, have no distance.
            told = (block.distinct > 0) & (cosine > -1)
            cell = _size(block.distinct) * STEPS + step
            for n in np.unique(lang[told]).tolist():
                spread[n] = spread.get(n, 0) + np.bincount(cell[told & (lang == n)], minlength=SIZES * STEPS)
        yield sums.partial(spread)

    found = sums.collected(staged.mapInArrow(measure, sums.PARTIAL))
    none = np.zeros(SIZES * STEPS)
    spread = np.array([found.get(n, none) for n in range(len(languages))]).reshape(-1, SIZES, STEPS)
    return Model(languages, idf, seeds, owner, _limits(spread, tolerance))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of labelled texts as the trigrams they have, one after another, with their counts."""
    for batch in _blocks(batches):
        counts, _ = trigram_counts(batch.column("text").to_pylist())
        text, cell = np.nonzero(counts)
        row = {
            "langs": [batch.column("lang").to_pylist()],
            "draws": [batch.column("draw").to_pylist()],
            "distinct": [np.bincount(text, minlength=len(counts)).astype(np.uint32).tobytes()],
            "cells": [cell.astype(np.uint16).tobytes()],
            "counts": [counts[text, cell].astype(np.uint32).tobytes()],
        }
        yield pa.RecordBatch.from_pydict({"payload": pa.array([packed.pack_batch(pa.RecordBatch.from_pydict(row))], pa.binary())})


class _Block:
    def __init__(self, payload: bytes):
        row = packed.unpack_batch(payload).to_pylist()[0]
        self.langs, self.draws = row["langs"], row["draws"]
        self.distinct, self.cells, self.counts = (
            np.frombuffer(row[name], kind) for name, kind in (("distinct", np.uint32), ("cells", np.uint16), ("counts", np.uint32))
        )

    def vectors(self, idf: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.langs), DIMENSIONS), np.float32)
        text = np.repeat(np.arange(len(self.langs)), self.distinct)
        out[text, self.cells] = (1 + np.log(self.counts)).astype(np.float32) * idf[self.cells]
        return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-12)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for payload in batch.column("payload"):
            yield _Block(payload.as_py())


def _begin(staged: DataFrame, centroids: int, max_languages: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """From one pass: the languages, the weights by document frequency, and each language's seeds, the texts with the smallest draws."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1)
        best: dict[str, list[tuple[int, bytes, bytes]]] = {}
        for block in _unpacked(batches):
            total[:-1] += np.bincount(block.cells, minlength=DIMENSIONS)
            total[-1] += len(block.langs)
            ends = np.cumsum(block.distinct)
            for n, (lang, draw) in enumerate(zip(block.langs, block.draws)):
                held = best.setdefault(lang, [])
                if len(held) < centroids or draw <= held[-1][0]:
                    own = slice(int(ends[n]) - int(block.distinct[n]), int(ends[n]))
                    held.append((draw, block.cells[own].tobytes(), block.counts[own].tobytes()))
                    held.sort()
                    del held[centroids:]
        seeds = [(lang, *seed) for lang, held in best.items() for seed in held]
        langs, draws, cells, counts = zip(*seeds) if seeds else ((), (), (), ())
        none = [None] * len(seeds)
        first = sums.partial({0: total}).to_pydict()
        yield pa.RecordBatch.from_pydict(
            {
                "key": pa.array([*first["key"], *none], pa.int32()),
                "task": pa.array([*first["task"], *none], pa.int64()),
                "value": pa.array([*first["value"], *none], pa.binary()),
                "lang": pa.array([None, *langs], pa.string()),
                "draw": pa.array([None, *draws], pa.int64()),
                "cells": pa.array([None, *cells], pa.binary()),
                "counts": pa.array([None, *counts], pa.binary()),
            }
        )

    seen = stage(staged.mapInArrow(look, f"{sums.PARTIAL}, lang string, draw long, cells binary, counts binary"))
    found = sums.collected(seen.filter("lang IS NULL").select("key", "task", "value"))
    if not found:
        return [], np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32)
    idf = np.log((found[0][-1] + 1) / (found[0][:-1] + 1)).astype(np.float32) + 1
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "cells", "counts"))
    chosen = seen.filter("lang IS NOT NULL").withColumn("place", place).filter(F.col("place") <= centroids)
    rows = chosen.limit((max_languages + 1) * centroids).collect()
    held: dict[str, list[np.ndarray]] = {}
    for r in sorted(rows, key=lambda r: r.place):
        counts = np.zeros((1, DIMENSIONS), np.int64)
        counts[0, np.frombuffer(r.cells, np.uint16)] = np.frombuffer(r.counts, np.uint32)
        held.setdefault(r.lang, []).append(_vectors(counts, idf)[0])
    if len(held) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted(held)
    # A language with fewer rows than centroids repeats its last one.
    seeds = np.array([held[x][min(n, len(held[x]) - 1)] for x in languages for n in range(centroids)]).reshape(-1, DIMENSIONS)
    return languages, idf, seeds


def identify(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    modulus: int = 4,
    remainder: int = 2,
    prefix: str = "",
    **fit,
) -> DataFrame:
    """The rows with their predicted language, score, whether held out from training, and whether rejected."""
    out = {"lang_pred": T.StringType(), "score": T.DoubleType(), "held_out": T.BooleanType(), "rejected": T.BooleanType()}
    out = {f"{prefix}{name}": kind for name, kind in out.items()}
    apart = held_out(F.col(id_column), modulus, remainder)
    labelled = docs.filter(~apart).select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.col(lang_column).cast("string").alias("lang")
    )
    model = docs.sparkSession.sparkContext.broadcast(train(labelled, **fit))
    kept = docs.drop(*out)
    names = kept.columns
    marked = kept.withColumn("__apart", apart)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, k) for n, k in out.items()]])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = [*model.value.languages, "und"]
        for batch in sliced(batches, text_column):
            lang, score, rejected = model.value.predict(batch.column(text_column).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array([named[x] for x in lang], pa.string()),
                    pa.array(score, pa.float64()),
                    batch.column("__apart"),
                    pa.array(rejected),
                ],
                names=[*names, *out],
            )

    return marked.mapInArrow(predict, schema)
