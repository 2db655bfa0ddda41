"""Spelling variants against plain Python over all pairs."""

import random
import re
import zlib
from collections import Counter

import cases
import pytest

from shelfflow.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counts_by_hand(rows, least_chars, least_count, slips):
    found = Counter()
    for r in rows:
        for run in RUN.findall(r[1] or ""):
            word = run.translate(cases.UPPER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{word}".encode())
            if slips and h % slips == 0:
                p = h % len(word)
                word = word[:p] + word[p + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= least_chars and n >= least_count}


@pytest.fixture
def few_levels(monkeypatch):
    """Longer words than eight go the way of long words, so that tests have few levels."""
    monkeypatch.setattr(spelling, "LEVELS", 8)


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(counts, ratio):
    out, form = [], {}
    near = {w: [v for v in counts if abs(len(v) - len(w)) <= 1 and one_apart(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=repr)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


@pytest.mark.parametrize("least_chars, least_count, ratio, slips", [(6, 5, 5, 199), (1, 1, 2, 2)])
def test_documents(docs, few_levels, least_chars, least_count, ratio, slips):
    got = spelling.spelling_variants(docs, least_chars, least_count, ratio, slips).collect()
    counts = counts_by_hand(cases.rows(), least_chars, least_count, slips)
    assert cases.keyed(got, *COLUMNS) == variants_by_hand(counts, ratio)


def crowded(seed, bound):
    """Words of few letters, in which nearly all are one edit apart, with repeated letters and long ones around the bound of the levels."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 7))) for _ in range(150)}
    for size in (bound - 2, bound - 1, bound, bound + 1, bound + 2, 40):
        base = "".join(rng.choices("aab", k=size))
        words |= {base, base[1:], base + "z", base[: size // 2] + "ÿ" + base[size // 2 + 1 :], base[: size // 2] + base[size // 2 + 1 :]}
        words |= {base[:-1] + "c", "ñ" + base[1:], "a" * size, "a" * size + "b"}
    return {w: 5 ** rng.randint(0, 5) * rng.randint(1, 4) for w in words}


@pytest.mark.parametrize("seed, bound", [(1, 6), (2, 14)])
def test_crowded_words_and_chains(spark, monkeypatch, seed, bound):
    monkeypatch.setattr(spelling, "LEVELS", bound)
    counts = crowded(seed, bound)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = spelling.group_variants(words, 5).collect()
    assert cases.keyed(got, *COLUMNS) == variants_by_hand(counts, 5)
    assert any(r.root not in (r.word, r.form) for r in got)


def test_a_chain_is_followed_to_its_end(spark):
    links = spark.createDataFrame([("a" * n, "a" * (n + 1)) for n in range(1, 14)], "word string, form string")
    assert {r.root for r in spelling.roots(links).collect()} == {"a" * 14}


def test_very_long_words(spark):
    long = "ab" * 60_000
    texts = [(n, f"{long} {long}x, {long[:-2]}b{long[-1]}") for n in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.word: r for r in spelling.spelling_variants(docs).collect()}
    assert len(got) == 3 and got[long].n_near == 2 and got[f"{long}x"].n_near == 1


def test_forms_cannot_run_in_a_circle(spark):
    with pytest.raises(ValueError):
        spelling.group_variants(spark.createDataFrame([("ab", 1)], "word string, n long"), 1)


def test_no_words(spark, nothing):
    assert spelling.spelling_variants(nothing).count() == 0
    docs = spark.createDataFrame([(None, None), (1, ""), (2, "1 2 --")], "doc_id long, text string")
    assert spelling.spelling_variants(docs).collect() == []
    assert spelling.spelling_variants(nothing).columns == COLUMNS
