"""Strings made to collide under sums modulo 2**64."""

import hashlib

import cases
import numpy as np
import pyarrow as pa
import pytest

from shelfflow.llm import lm, quality, substrings, text


def twins(size):
    """The Thue-Morse string of two letters and its complement: their polynomial hashes modulo 2**64 agree from 1,024 letters on."""
    odd = [bin(n).count("1") % 2 for n in range(size)]
    return "".join("ab"[x] for x in odd), "".join("ba"[x] for x in odd)


@pytest.mark.parametrize("size", [128, 256, 257, 1024, 2048, 4096])
def test_words_of_any_length_differ(size):
    data, offsets = text.flat(pa.array([" ".join(twins(size))]))
    starts, ends, _ = text.words(data, offsets)
    hashes = text.text_hashes(data, text.byte_sums(data), starts, ends)
    assert len(set(hashes.tolist())) == 2


def test_windows_with_such_words_are_not_removed(spark):
    one, other = twins(2048)
    filler = [f"w{n}" for n in range(34)]
    rows = [(1, " ".join([one, *filler])), (2, " ".join([other, *filler])), (3, " ".join([*filler, one]))]
    got = {r.doc_id: r for r in substrings.remove_repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), 35).collect()}
    assert [got[n].n_removed for n in (1, 2, 3)] == [0, 0, 0]


def test_such_lines_and_windows_of_words_are_no_repeats():
    one, other = twins(2048)
    found = quality.Described(pa.array([f"{one} x\n{other} x\n{one} x", " ".join([one, *"abcdefg", other, *"abcdefg"])]))
    assert found.n_dup_lines.tolist() == [1, 0] and found.n_repeat_words.tolist() == [0, 0]


def test_a_word_never_seen_is_not_known(spark):
    one, other = twins(1024)
    docs = spark.createDataFrame(cases.rows(count=40), cases.SCHEMA).select("doc_id", "text")
    apart = next(n for n in range(1000, 2000) if __import__("zlib").crc32(str(n).encode()) % 10 == 0)
    trained = next(n for n in range(1000, 2000) if __import__("zlib").crc32(str(n).encode()) % 10 != 0)
    more = spark.createDataFrame([(apart, f"{other} maison"), (trained, f"{one} maison")], docs.schema)
    got = {r.doc_id: r for r in lm.score_texts(docs.union(more)).collect()}
    assert got[apart].n_known == 2 and got[trained].n_known == 3


def test_the_last_lines_of_long_texts_are_learned(spark):
    """Texts whose last lines alone tell good from bad: a fit of their first lines could not."""
    start = "\n".join(f"a line of words {n} that every text has" for n in range(300))
    ends = {
        1: "\n".join(f"A closing paragraph, the one numbered {n}, has many plain words in it and goes on for a while." for n in range(150)),
        0: "\n".join(f"| # $ {n} | * %" for n in range(150)),
    }
    docs = [(n, f"{start}\n{ends[n % 2]}") for n in range(40)]
    labels = [(n, n % 2, 0) for n in range(40)] + [(n, n % 2, 0) for n in range(0, 40, 3)]
    frame = spark.createDataFrame(docs + docs[:7], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    models = [quality.train(frame.repartition(k), marks, "doc_id", "text") for k in (1, 5)]
    told = [m.decode(quality.Described(pa.array([ends[1]])).features) for m in models]
    junk = [m.decode(quality.Described(pa.array([ends[0]])).features) for m in models]
    assert told[0].mean() > junk[0].mean() + 0.5
    digests = {hashlib.md5(np.concatenate([x.ravel() for x in vars(m).values()]).tobytes()).hexdigest() for m in models}
    assert len(digests) == 1
