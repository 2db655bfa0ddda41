"""Spelling variants: words one edit apart, found by walking all words through a trie at once.

The trie is a distributed edge table: a row per node (a prefix of some word), with the code points that go on from it and the
count of the word that ends there. The frontier is a table of states (word, position, node, edits), one level of the trie
after another: every level joins the states with the nodes of that depth, follows the word's next code point, and from states without an
edit branches off once, by another code point than the word's or by leaving one out. A state with one edit whose word and path end together
is a pair of neighbours.

* A pair is met once: replacements only go to greater code points and nothing is inserted, since the longer or greater word of a pair
  finds the other; an edit stands where the two words first differ.
* The upper levels of a trie are dense, and nearly every edit there lives on for some levels. So words walk twice, forwards and
  backwards, and branch off only in the second half of the word: an edit lies in the second half of the word or of its
  reversal. States start in the middle, at nodes of at least half the word, so no node near the root is a hot key of the joins; what is still hot, adaptive execution splits.
* Each level is written to the shared folder, so plans stay short and a lost executor repeats one level at most.

Words of more than ``LEVELS`` code points would need a level for each. They are few and spread, so pairs of them are
found by hashes of the word without one place (equal if the words differ there at most) and proved on the words themselves: as many rows as
code points, whatever the length.

Defined cases: a NULL text has no words. A NULL id is the empty text in the hash of ``slips``. Repeated rows count as often as they occur. Ties among the most
frequent neighbours go to the smallest in code-point order. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.llm.text import INVERSE, U64, mix, powers, sliced
from shelfflow.sources.staging import stage

# Runs of A-Z (in lower case) and the code points U+00C0 to U+00FF as UTF-8.
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
# Distinct words a task holds before it hands them on.
HELD = 300_000
LEVELS = 32
# Code points of a long word handled at a time.
BLOCK = 1 << 16


def _slip(run: bytes, place: int) -> bytes:
    """The run without one code point."""
    text = run.decode()
    place %= len(text)
    return (text[:place] + text[place + 1 :]).encode()


def word_counts(
    docs: DataFrame, least_chars: int = 6, least_count: int = 5, slips: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``word`` and ``n`` of all words with enough code points and occurrences.

    With ``slips``, a run whose crc32 (of id, colon and run) is divisible by it has lost one code point in that document.
    """
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).cast("string").alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            words = pa.array(held.keys(), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_pydict({"word": words, "n": pa.array(held.values(), pa.int64())})

        for batch in sliced(batches, "text"):
            ids = batch.column("id").cast(pa.binary()).to_pylist()
            texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary()).to_pylist()
            for id_, text in zip(ids, texts):
                begun = zlib.crc32(id_ + b":")
                for run, n in Counter(RUN.findall((text or b"").lower())).items():
                    if len(run) < least_chars:
                        continue
                    if slips:
                        drawn = zlib.crc32(run, begun)
                        if drawn % slips == 0:
                            run = _slip(run, drawn)
                    held[run] += n
            if len(held) > HELD:
                yield handed_on()
                held.clear()
        if held:
            yield handed_on()

    found = rows.mapInArrow(count, "word string, n long").filter(F.length("word") >= least_chars)
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _walks(words: DataFrame) -> DataFrame:
    """Each word forwards and backwards, with the depth from which it may branch off."""
    half = F.floor(F.length("word") / 2).cast("int")
    ways = F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("text"), half.alias("start")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("text"), (F.length("word") - half).alias("start")),
    )
    return words.select("n", F.inline(ways))


def _edges(walks: DataFrame) -> DataFrame:
    """The nodes from each word's start on: depth, the code points that follow, and the count of the word that ends there."""
    depth = F.explode(F.sequence("start", F.length("text"))).alias("depth")
    places = walks.select("way", "text", "n", depth)
    ends = F.col("depth") == F.length("text")
    return (
        places.select(
            "way",
            "depth",
            F.expr("left(text, depth)").alias("node"),
            F.when(~ends, F.expr("substr(text, depth + 1, 1)")).alias("next"),
            F.when(ends, F.col("n")).alias("ending"),
        )
        .groupBy("way", "depth", "node")
        .agg(F.collect_set("next").alias("next"), F.max("ending").alias("end_n"))
    )


# The states that follow from a state and its node, with ``end_n`` set for those that have met a neighbour.
_FOLLOWING = """
    CASE
    WHEN edits = 1 AND position = length(text) THEN
        filter(array(struct(position, node, edits, end_n)), x -> x.end_n IS NOT NULL)
    WHEN edits = 1 THEN
        filter(array(struct(position + 1 AS position, node || here AS node, edits, CAST(NULL AS LONG) AS end_n)), x -> array_contains(next, here))
    ELSE concat(
        filter(array(struct(position + 1 AS position, node || here AS node, 0 AS edits, CAST(NULL AS LONG) AS end_n)),
            x -> position + 1 < length(text)),
        transform(filter(next, c -> c > here),
            c -> struct(position + 1 AS position, node || c AS node, 1 AS edits, CAST(NULL AS LONG) AS end_n)),
        filter(array(struct(position + 1 AS position, node, 1 AS edits, end_n)),
            x -> position + 1 = length(text) AND x.end_n IS NOT NULL),
        filter(array(struct(position + 2 AS position, node || after AS node, 1 AS edits, CAST(NULL AS LONG) AS end_n)),
            x -> after <> here AND array_contains(next, after)))
    END"""


def _level(states: DataFrame, nodes: DataFrame) -> DataFrame:
    """All states one level further down."""
    at = states.join(nodes, ["way", "node"]).withColumns(
        {"here": F.expr("substr(text, position + 1, 1)"), "after": F.expr("substr(text, position + 2, 1)")}
    )
    return at.select("way", "text", "n", F.inline(F.expr(_FOLLOWING)))


def _short_pairs(words: DataFrame) -> DataFrame:
    """Pairs of words of up to ``LEVELS`` code points, from the frontier."""
    walks = stage(_walks(words))
    edges = stage(_edges(walks).sortWithinPartitions("depth"))
    first, last = walks.agg(F.min("start"), F.max(F.length("text"))).first()
    seeds = walks.select(
        "way", "text", "n", F.col("start").alias("position"), F.expr("left(text, start)").alias("node"), F.lit(0).alias("edits"), "start"
    )
    levels: list[DataFrame] = []
    for depth in range(first or 0, (last or -1) + 1):
        states = seeds.filter(F.col("start") == depth).drop("start")
        if levels:
            states = levels[-1].filter("end_n IS NULL").drop("end_n").unionByName(states)
        levels.append(stage(_level(states, edges.filter(F.col("depth") == depth).drop("depth"))))
    forwards = {c: F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c)) for c in ("text", "node")}
    found = [
        level.filter("end_n IS NOT NULL").select(
            forwards["text"].alias("word"), "n", forwards["node"].alias("near"), F.col("end_n").alias("near_n")
        )
        for level in levels
    ]
    return reduce(DataFrame.unionByName, found) if found else _no_pairs(words)


def _no_pairs(words: DataFrame) -> DataFrame:
    return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).filter("false")


def _without_one(word: str) -> Iterator[pa.RecordBatch]:
    """Hashes of a word, of the word less one code point, and of the word less what stands at a place."""
    points = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(U64)
    n, odd = len(points), U64(0x9E3779B97F4A7C15)
    up, _ = powers(n + 1)
    parts = mix(points + odd) * up[:n]
    before = np.concatenate([[U64(0)], np.cumsum(parts, dtype=U64)])
    whole = before[-1]
    size = np.array([n, n - 1], U64) * odd
    yield _keys("word", mix(np.array([whole + size[0]])))
    for begin in range(0, n, BLOCK):
        place = np.arange(begin, min(begin + BLOCK, n))
        yield _keys("other", mix(mix(whole - parts[place] + size[0]) + place.astype(U64)))
        # Of equal neighbours only the last one is left out.
        place = place[(place == n - 1) | (points[np.minimum(place + 1, n - 1)] != points[place])]
        yield _keys("less", mix(before[place] + (whole - before[place + 1]) * INVERSE + size[1]))


def _keys(kind: str, keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(keys)), "key": pa.array(keys.view(np.int64))})


def _long_pairs(words: DataFrame) -> DataFrame:
    """Pairs with a word of more than ``LEVELS`` code points, by hashes and proved on the words."""
    numbered = stage(words.filter(F.length("word") >= LEVELS).withColumn("number", F.monotonically_increasing_id()))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, word in zip(batch.column("number").to_pylist(), batch.column("word").to_pylist()):
                for part in _without_one(word):
                    yield part.append_column("number", pa.array([number] * part.num_rows, pa.int64()))

    keyed = stage(numbered.select("number", "word").mapInArrow(keys, "kind string, key long, number long"))

    def of(kind: str, name: str) -> DataFrame:
        return keyed.filter(F.col("kind") == kind).select("key", F.col("number").alias(name))

    less = of("less", "a").join(of("word", "b"), "key")
    other = of("other", "a").join(of("other", "b"), "key").filter("a < b")
    pairs = less.unionByName(other).select("a", "b").distinct()
    left = numbered.select(F.col("number").alias("a"), "word", "n")
    right = numbered.select(F.col("number").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    proved = pairs.join(left, "a").join(right, "b").filter(F.levenshtein("word", "near", 1) == 1)
    return proved.filter(F.greatest(F.length("word"), F.length("near")) > LEVELS).select("word", "n", "near", "near_n")


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n``: every word (``word``, ``n``) with each of its neighbours, both ways round."""
    short = _short_pairs(words.filter(F.length("word") <= LEVELS))
    pairs = short.unionByName(_long_pairs(words)).distinct()  # one left-out code point can lie in both halves
    both = F.array(
        F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    return pairs.select(F.inline(both))


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last word reached by following ``form``, by doubling the steps until no word moves.

    Forms are ``ratio`` times as frequent as their word, so a chain is as long as a logarithm of the corpus.
    """
    reached = stage(links.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(reached.join(onward, "root", "left"))
        if moved.filter("further IS NOT NULL").isEmpty():
            return reached
        reached = stage(moved.select("word", F.coalesce("further", "root").alias("root")))


def group_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """Each word with its form and the root of its forms, its count ``n``, ``n_near`` and the form's count.

    The form is the most frequent neighbour, if it is at least ``ratio`` times as frequent as the word.
    """
    if ratio < 2:
        raise ValueError("with a ratio under 2 forms could follow one another in a circle")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near").alias("form")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    common = -F.col("best.rank") >= F.col("n") * ratio
    found = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(common, F.col("best.form")).alias("form"),
            F.when(common, -F.col("best.rank")).alias("form_n"),
        )
    )
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame,
    least_chars: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    slips: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The variants among the words of all texts; see ``word_counts`` and ``group_variants``."""
    return group_variants(stage(word_counts(docs, least_chars, least_count, slips, id_column, text_column)), ratio)
