"""Line, window, byte-string and near-duplicate removal against plain Python."""

import random
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfflow.llm import lines, packed, simhash, substrings, suffixes, text
from shelfflow.llm.components import components


def test_words_and_windows_agree_with_plain_python():
    import pyarrow as pa

    texts = [r[1] for r in cases.rows()]
    data, offsets = text.flat(pa.array(texts, pa.string()))
    starts, ends, first = text.words(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert [found[a:b] for a, b in zip(first[:-1], first[1:])] == [cases.words(t) for t in texts]
    hashes = text.span_hashes(text.byte_sums(data), starts, ends)
    assert len(set(hashes.tolist())) == len(set(found))
    windows = text.window_hashes(hashes, 3)
    by_text = defaultdict(set)
    for s in text.window_starts(first, 3):
        by_text[tuple(found[s : s + 3])].add(int(windows[s]))
    assert all(len(v) == 1 for v in by_text.values()) and len({min(v) for v in by_text.values()}) == len(by_text)


@pytest.mark.parametrize("width", [1, 2, 3, 7, 16, 19])
def test_lowest_names_the_last_of_the_lowest(width):
    values = np.random.default_rng(1).integers(0, 9, 300, dtype=np.uint64) << np.uint64(40)
    found = text.lowest(values, width)
    for i in range(len(values) - width + 1):
        run = values[i : i + width].tolist()
        assert found[i] == i + max(j for j in range(width) if run[j] == min(run))


def line_key(line):
    return line.strip(cases.SPACES).translate(cases.UPPER)


def lines_by_hand(rows, min_chars, min_docs):
    holders = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            holders[line_key(line)].add(r[0])
    out = []
    for r in rows:
        parts = (r[1] or "").split("\n")
        kept = []
        for p in parts:
            held = holders[line_key(p)]
            largest = max((h for h in held if h is not None), default=None)
            if not (len(line_key(p)) >= min_chars and len(held) >= min_docs and r[0] != largest):
                kept.append(p)
        out.append((r[0], "\n".join(kept), len(parts), len(parts) - len(kept), *r[2:]))
    return out


@pytest.mark.parametrize("filter_bits", [1 << 30, 1])
@pytest.mark.parametrize("min_chars, min_docs", [(20, 3), (1, 2), (3, 4)])
def test_lines(docs, min_chars, min_docs, filter_bits):
    got = lines.dedup_lines(docs, min_chars=min_chars, min_docs=min_docs, max_filter_bits=filter_bits, prefix="x_")
    columns = ["doc_id", "text", "x_n_lines", "x_n_dropped", "lang", "source", "n_chars", *cases.CLASHES]
    assert cases.keyed(got.collect(), *columns) == sorted(lines_by_hand(cases.rows(), min_chars, min_docs), key=repr)


def test_lines_without_a_prefix_replace_columns(docs):
    got = lines.dedup_lines(docs)
    assert got.columns.count("n_lines") == 1 and dict(got.dtypes)["n_lines"] == "bigint"


def windows_by_hand(sequences, length):
    counts = Counter(tuple(s[i : i + length]) for s in sequences for i in range(len(s) - length + 1))
    covered = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if counts[tuple(s[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        covered.append(gone)
    return covered


@pytest.mark.parametrize("length, base", [(35, 16), (5, 2), (8, 8), (1, 1)])
def test_word_windows(docs, length, base):
    got = substrings.remove_repeated_windows(docs, length, base).collect()
    rows = cases.rows()
    tokens = [cases.words(r[1]) for r in rows]
    want = [
        (r[0], " ".join(w for w, g in zip(t, gone) if not g), len(t), sum(gone))
        for r, t, gone in zip(rows, tokens, windows_by_hand(tokens, length))
    ]
    assert cases.keyed(got, "doc_id", "kept", "n_words", "n_removed") == sorted(want, key=repr)


def test_levels_double():
    assert substrings.level_lengths(35, 16) == [18, 35]
    assert substrings.level_lengths(35, 4) == [5, 9, 18, 35]
    assert substrings.level_lengths(8, 8) == [8]
    assert substrings.level_lengths(2, 1) == [1, 2] and substrings.level_lengths(1, 1) == [1]


def strings_by_hand(rows, length):
    data = [(r[1] or "").encode() for r in rows]
    out = []
    for r, d, gone in zip(rows, data, windows_by_hand(data, length)):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], bytes(b for b, g in zip(d, gone) if not g), len(d), sum(gone), spans))
    return out


@pytest.mark.parametrize("length", [28, 60, 400])
def test_byte_strings(docs, length):
    got = suffixes.remove_repeated_strings(docs, length).collect()
    found = sorted(((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got), key=repr)
    assert found == sorted(strings_by_hand(cases.rows(), length), key=repr)


def test_byte_strings_with_periods_and_many_chunks(spark, monkeypatch):
    """Periodic texts make short phrases, so names must be named again; tiny chunks spread copies over many."""
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 2000)
    rng = random.Random(8)
    texts = ["ab" * 300, "ab" * 290 + "c" + "ab" * 100, "a" * 700, "b" + "a" * 650, "abc" * 200]
    noise = "".join(rng.choices("ab", k=1500))
    texts += [noise, noise[200:900] + "x" + noise[100:800], noise[:500][::-1]]
    texts += [noise[a : a + 150] + "".join(rng.choices("xyz", k=200)) for a in range(0, 1200, 37)]
    rows = [(n, t) for n, t in enumerate(texts)]
    got = suffixes.remove_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 100).collect()
    found = sorted((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in got)
    assert found == sorted(strings_by_hand(rows, 100))


def fingerprint_by_hand(t, shingle):
    tokens = cases.low_words(t)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + shingle]) for i in range(max(1, len(tokens) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows, shingle, max_bits):
    fps = [fingerprint_by_hand(r[1], shingle) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return fps, group


@pytest.mark.parametrize("shingle, max_bits", [(3, 2), (1, 4), (3, 0)])
def test_near_duplicate_groups(docs, shingle, max_bits):
    rows = cases.rows()
    fps, group = groups_by_hand(rows, shingle, max_bits)
    least = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in set(group)}
    want = [(r[0], f"{fp:016x}", least[g]) for r, fp, g in zip(rows, fps, group)]
    got = simhash.near_duplicate_groups(docs, shingle, max_bits).collect()
    assert cases.keyed(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)

    kept = simhash.one_of_each_group(docs, shingle, max_bits)
    assert kept.columns == docs.columns
    by_group = defaultdict(list)
    for r, g in zip(rows, group):
        by_group[g].append(r)
    ids = sorted((min((r[0] for r in rs if r[0] is not None), default=None) for rs in by_group.values()), key=repr)
    found = [tuple(r) for r in kept.collect()]
    assert sorted((r[0] for r in found), key=repr) == ids and all(r in rows for r in found)


def test_dense_groups_link_completely():
    """Thousands of fingerprints around one centre, in one file: links join all that are near."""
    rng = np.random.default_rng(4)
    fps = np.unique(np.array([int(np.bitwise_xor.reduce(np.uint64(1) << rng.choice(64, 3).astype(np.uint64))) for _ in range(1500)], np.uint64))
    a, b = simhash.links_within(np.zeros(len(fps), np.int64), fps, 2)
    root = dict(zip(a.tolist(), b.tolist()))
    group = {int(f): root.get(int(f), int(f)) for f in fps.view(np.int64)}
    signed = fps.view(np.int64)
    for i in range(len(fps)):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 2)
        assert len({group[int(signed[j])] for j in near}) == 1


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}


def test_repeats_are_counted_over_chunks(spark):
    rows = [(n, f"word{n % 50} only{n}") for n in range(300)]
    staged = packed.chunks(spark.createDataFrame(rows, "id long, text string").repartition(5), "text", chunk_bytes=200)
    assert staged.count() > 20 and staged.agg(F.sum("size")).first()[0] == sum(len(t) for _, t in rows)


@pytest.mark.parametrize(
    "operator",
    [
        lines.dedup_lines,
        substrings.remove_repeated_windows,
        suffixes.remove_repeated_strings,
        simhash.near_duplicate_groups,
        simhash.one_of_each_group,
    ],
)
def test_empty_tables(nothing, operator):
    assert operator(nothing).collect() == []
