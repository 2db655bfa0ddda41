"""Phrase collocations against plain Python with unbounded integers."""

import random
import re
from collections import Counter

import cases
import numpy as np
import pytest

from shelfflow.llm import collocations

U64 = np.uint64
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def by_hand(rows, least, top, percent):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(cases.UPPER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 6):
                for i in range(len(words) - n + 1):
                    counts[lang, tuple(words[i : i + n])] += 1
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, phrase), a in candidates.items():
        n = totals[lang]
        cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]]) for k in range(1, len(phrase))]
        score, _, l, r = min((1000 * a * n // (l * r), k, l, r) for k, (l, r) in enumerate(cuts))
        covered = any(
            other == lang and len(longer) > len(phrase) and 100 * b >= percent * a
            and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if not covered:
            out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), l, r, n))
    return sorted(
        (lang, rank, phrase.decode(), -a, l, r, n, -score)
        for lang, found in out.items()
        for rank, (score, a, phrase, l, r, n) in enumerate(sorted(found)[:top], 1)
    )


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()))


@pytest.mark.parametrize("least, top, percent, slack", [(4, 2000, 100, 8), (3, 7, 100, 1), (6, 50, 60, 1), (30, 5, 100, 2)])
def test_documents(docs, least, top, percent, slack):
    given = [(r[1], r[2]) for r in cases.rows()]
    expected = by_hand(given, least, top, percent)
    assert expected
    assert rows_of(collocations.collocations(docs, least, top, percent, slack)) == expected


def test_pieces_languages_and_repeats(spark):
    texts = [
        ("New York, new york! NEW\tYORK\r\nnew  york", None), ("new york", "und"), ("new.york;new:york", "und"), ("", "en"), (None, "en"),
        ("a a a a a a a a", "en"), ("ÉA éa ÉA éa", "fr"), ("x" * 100_000 + " y " + "x" * 100_000 + " y", "fr"), (" ,.\n", "de"),
    ]
    docs = spark.createDataFrame(texts * 2, "text string, lang string")
    assert rows_of(collocations.collocations(docs, least=2)) == by_hand(texts * 2, 2, 2000, 100)


def test_many_small_chunks_and_partitions(spark, monkeypatch):
    rng = random.Random(5)
    texts = [(" ".join(rng.choices(["a", "b", "c", "dd", "e", "f."], k=rng.randint(0, 60))), rng.choice(["x", "y"])) for _ in range(300)]
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(7)
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 200)
    monkeypatch.setattr(collocations, "BUCKET_KEYS", 100)
    assert rows_of(collocations.collocations(docs, least=40)) == by_hand(texts, 40, 2000, 100)


@pytest.mark.parametrize("slack", [1, 3])
def test_every_frequent_key_survives_merging(slack):
    rng = np.random.default_rng(slack)
    for _ in range(30):
        least = int(rng.integers(2, 40))
        arrays, total = [], Counter()
        for _ in range(int(rng.integers(1, 60))):
            keys, counts = np.unique((rng.zipf(1.3, int(rng.integers(1, 300))) % 5000).astype(U64), return_counts=True)
            arrays.append((keys, counts.astype(np.int64)))
            total.update(dict(zip(keys.tolist(), counts.tolist())))
        found = collocations.frequent(arrays, least, slack).tolist()
        assert found == sorted(found) and {k for k, n in total.items() if n >= least} <= set(found)
        # What is taken off a key is less than the threshold, so no key that occurs that much less survives.
        mass = sum(total.values())
        assert all(total[k] > 0 for k in found) and len(found) <= slack * (mass // least + 1)


def test_a_summary_takes_off_less_than_mass_over_capacity():
    rng = np.random.default_rng(2)
    summary, total = collocations.Summary(20), Counter()
    for _ in range(50):
        keys, counts = np.unique(rng.integers(0, 200, 100).astype(U64), return_counts=True)
        total.update(dict(zip(keys.tolist(), counts.tolist())))
        summary.merge([keys], [counts.astype(np.int64)])
        held = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
        assert len(held) <= 20 and summary.lost * 21 <= sum(total.values())
        assert all(held.get(k, 0) <= n <= held.get(k, 0) + summary.lost for k, n in total.items())


def test_sorted_numbers_survive_compression():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5, 1000):
        keys = np.unique(rng.integers(0, 2**64, size, dtype=U64))
        assert (collocations._widened(collocations._narrow(keys), len(keys)) == keys).all()


def test_phrases_of_one_hash_are_counted_apart():
    import pyarrow as pa

    from shelfflow.llm import packed

    batch = pa.RecordBatch.from_pydict({"text": ["a b c a b", "a b"], "lang": ["x", "y"]})
    chunk = collocations._Chunk(packed.pack_batch(collocations._tokenize(batch)[0]))
    for sizes in collocations.STEPS:
        chunk.look(sizes)
    for n in chunk.hashes:
        chunk.hashes[n] = np.zeros_like(chunk.hashes[n])
    found = Counter()
    for r in chunk.counted()[1].to_pylist():
        found[r["lang"], r["size"], r["phrase"]] += r["n"]
    assert found["x", 1, "a"] == 2 and found["x", 1, "c"] == 1 and found["y", 1, "a"] == 1
    assert found["x", 2, "a b"] == 2 and found["x", 2, "c a"] == 1 and found["y", 2, "a b"] == 1
    assert found["x", 5, "a b c a b"] == 1 and found["x", 0, ""] == 5


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame([("x", "p q", 2, 10**15 + 7, ["p", "q"])], "lang string, phrase string, size int, a long, words array<string>")
    counts = spark.createDataFrame([("x", "p", 10**15 + 9), ("x", "q", 3 * 10**15 + 1)], "lang string, phrase string, n long")
    totals = spark.createDataFrame([("x", 10**17 + 3)], "lang string, n long")
    row = collocations._scored(words.drop("size"), counts, totals).first()
    assert row.score == 1000 * (10**15 + 7) * (10**17 + 3) // ((10**15 + 9) * (3 * 10**15 + 1))


def test_nothing(nothing):
    got = collocations.collocations(nothing)
    assert got.columns == COLUMNS and got.collect() == []
