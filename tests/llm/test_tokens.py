"""Compiled token counts against the tokenizers library and against merging by definition."""

import json
import random

import cases
import numpy as np
import pytest

from shelfflow.llm import tokens

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

FILE = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "aestrmdlv'' '\n\t  .,!#19é日  \x85\x1c\0٣Ⅷ😀́abc​ 　"
EDGES = [
    "", "a", "'", " '", "it's", "don't  we'll'", "x'r", "x'l 'l", "'re", "''re", "a'll'llx", "'r\n", "'R'S", "\n's", "  's",
    "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "  <|endoftext|>  x", "'r<|endoftext|>e", "<|endoftext",
    "a" * 5000, " " * 3000, "-" * 2000, " " * 100 + "x", "the" * 1000, "\n" * 501, "aaaab" * 300, "'" * 700, "' " * 300, "'l" * 400,
]


@pytest.fixture(scope="module")
def library():
    made = tokenizers.Tokenizer.from_file(FILE)
    return lambda texts: [len(e.ids) for e in made.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    with open(FILE, "rb") as f:
        return tokens.TokenCounter(f.read())


def texts(seed=1, count=3000):
    rng = random.Random(seed)
    out = EDGES + ["".join(rng.choices(ALPHABET, k=rng.randint(1, 40))) for _ in range(count)]
    spans = [(0x20, 0x7F), (0x20, 0x500), (0xE000, 0x30000)]
    return out + ["".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(rng.randint(1, 60))) for _ in range(count // 2)]


def test_counts_equal_the_library(counter, library):
    given = texts()
    assert counter.count([t.encode() for t in given]).tolist() == library(given)


def test_every_code_point_is_split_as_the_library_does(counter, library):
    points = [chr(c) for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    given = [" a".join(points[n : n + 64]) + " 1".join(points[n : n + 64]) for n in range(0, len(points), 64)]
    assert counter.count([t.encode() for t in given]).tolist() == library(given)


@pytest.mark.parametrize("chunk", [1, 2, 3, 7, 100])
def test_pieces_do_not_depend_on_the_chunks(chunk):
    kinds = tokens.classes()[np.array([ord(c) for c in "".join(texts(2, 400))])]
    kinds[::97] = tokens.END
    assert (tokens.piece_starts(kinds, chunk) == tokens.piece_starts(kinds)).all()


def merged(ranks, text):
    """The earliest pair in the list of merges first, the leftmost among equals."""
    parts = [text[n : n + 1] for n in range(len(text))]
    while True:
        found = [(ranks[pair], n) for n, pair in enumerate(zip(parts, parts[1:])) if pair in ranks]
        if not found:
            return parts
        n = min(found)[1]
        parts[n : n + 2] = [parts[n] + parts[n + 1]]


@pytest.mark.parametrize("seed", range(8))
def test_transducers_of_small_vocabularies_merge_by_definition(seed):
    """Vocabularies over three letters, in which most tokens overlap and several merges make one token."""
    rng = random.Random(seed)
    known, ranks = [b"a", b"b", b"c"], {}
    while len(ranks) < 40:
        pair = (rng.choice(known), rng.choice(known))
        if pair not in ranks and len(b"".join(pair)) < 12:
            ranks[pair] = len(ranks)
            if b"".join(pair) not in known:
                known.append(b"".join(pair))
    used = {token for n in range(3, 8) for text in _all(n) for token in merged(ranks, text)} | set(known[:3])
    made = tokens.Counter(dict.fromkeys(known, 0), ranks, max_states=rng.choice([3, 50, 10**6]))
    for n in range(1, 8):
        for text in _all(n):
            assert made.count(text) == len(merged(ranks, text))
    for x in used:
        for y in used:
            assert made.may_follow(x, y) == (merged(ranks, x + y) == [x, y])


def _all(n):
    out = [b""]
    for _ in range(n):
        out = [t + c for t in out for c in (b"a", b"b", b"c")]
    return out


def test_bounded_memory_gives_the_same(counter, library):
    with open(FILE, "rb") as f:
        small = tokens.TokenCounter(f.read(), max_states=50, max_pieces=10)
    given = texts(3, 300)
    assert small.count([t.encode() for t in given]).tolist() == library(given)
    assert len(small.counter.states) <= 52 and len(small.known) <= 10


def test_other_tokenizers_are_refused():
    with open(FILE, "rb") as f:
        spec = json.loads(f.read())
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        with pytest.raises(ValueError):
            tokens.TokenCounter(json.dumps(spec | change).encode())


def test_rows_columns_and_defined_cases(docs, nothing, library):
    got = tokens.count_tokens(docs, FILE, limit=50, prefix="x_")
    columns = ["doc_id", "text", "lang", "source", "n_chars", *cases.CLASHES, "x_n_bytes", "x_n_tokens", "x_over_limit"]
    assert got.columns == columns
    rows = cases.rows()
    counts = library([r[1] or "" for r in rows])
    expected = [(*r, len((r[1] or "").encode()), n, n > 50) for r, n in zip(rows, counts)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    assert tokens.count_tokens(nothing, FILE).count() == 0


def test_columns_of_the_same_names_are_replaced(spark):
    docs = spark.createDataFrame([("ab", "old", None)], "n_tokens string, n_bytes string, text string")
    got = tokens.count_tokens(docs, FILE, text_column="n_tokens").collect()
    assert [r.asDict() for r in got] == [{"text": None, "n_bytes": 2, "n_tokens": 1, "over_limit": False}]
