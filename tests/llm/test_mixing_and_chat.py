"""Mixing, decontamination, chat formatting and the pipeline against plain Python."""

import hashlib
import json
from collections import Counter, defaultdict
from fractions import Fraction

import cases
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_dedup import groups_by_hand, lines_by_hand

import corpus_pipeline
from shelfflow.llm import chat, decontaminate, language, mixing

SMALL = "/root/testdata/sf0.001"


# Mixing


def targets_by_hand(sizes, weights=(1, 2, 3), epochs=3):
    """Clamp, reshare, until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    clamped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(epochs * sizes[s] for s in clamped)
        parts = sum(weight[s] for s in sizes if s not in clamped)
        target = {s: Fraction(epochs * sizes[s]) if s in clamped else Fraction(weight[s] * rest, parts) for s in sizes}
        above = {s for s in sizes if target[s] > epochs * sizes[s]}
        if not above:
            return target
        clamped |= above


def test_mixing(docs):
    sized = docs.withColumn("size", mixing.word_count(F.col("text")))
    got = mixing.mix_sources(sized, "size").collect()
    rows = cases.rows()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(cases.words(r[1]))
    target = targets_by_hand(sizes)
    assert cases.keyed(got, "doc_id", "size") == sorted(((r[0], len(cases.words(r[1]))) for r in rows), key=repr)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(target[r.source]))
        assert 0 <= r.taken <= 3 * r.size
        whole = int(target[r.source] / sizes[r.source]) if sizes[r.source] else 0
        assert whole * r.size <= r.taken <= (whole + 1) * r.size
        taken[r.source] += r.taken
    # Rows with the same id at the cut may leave a few words.
    assert all(abs(taken[s] - target[s]) <= 3 for s in sizes)
    columns = ["doc_id", "size", "source", "taken"]
    again = mixing.mix_sources(sized.repartition(7), "size").collect()
    assert cases.keyed(again, *columns) == cases.keyed(got, *columns)


def test_another_seed_takes_other_documents(docs):
    sized = docs.withColumn("size", mixing.word_count(F.col("text")))
    first, second = (mixing.mix_sources(sized, "size", seed=s).select("doc_id", "source", "taken").collect() for s in (0, 1))
    assert sorted(first, key=repr) != sorted(second, key=repr)


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 0, "c": 1}, {"a": 1000, "b": 3, "c": 3, "d": 500, None: 7}, {"a": 5}])
def test_water_level(spark, sizes):
    """Sources of very different sizes: several rounds of clamping."""
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, source string, size long"), "size").collect()
    target = targets_by_hand(sizes)
    assert all(r.target == pytest.approx(float(target[r.source])) for r in got)
    assert all(abs(r.taken - target[r.source]) <= 1 for r in got)


# Decontamination


def shingles_by_hand(text, n=5):
    tokens = cases.low_words(text)
    if not tokens:
        return set()
    return {tuple(tokens[i : i + n]) for i in range(max(1, len(tokens) - n + 1))}


def items(spark):
    texts = [r[1] for r in cases.rows() if r[1]]
    long = max(texts, key=lambda t: len(cases.words(t)))
    tokens = cases.words(long)
    found = [" ".join(tokens[a : a + n]) for a, n in [(0, 5), (300, 12), (900, 40), (2000, 150), (50, 700)]]
    edited = [*tokens[500:560], "other", *tokens[561:600]]
    found += [" ".join(edited).upper(), "not to be found anywhere at all, ever", "one two", "", None, "x", " ".join(tokens[7:9])]
    rows = [(n if n != 3 else None, t) for n, t in enumerate(found)] + [(1, found[1])]
    return rows, spark.createDataFrame(rows, "item_id long, text string")


def leaks_by_hand(rows, item_rows):
    pooled = defaultdict(set)
    for i, t in item_rows:
        pooled[i] |= shingles_by_hand(t)
    out = []
    for r in rows:
        own = shingles_by_hand(r[1])
        for i, wanted in pooled.items():
            shared = len(own & wanted)
            if wanted and shared >= 0.8 * len(wanted):
                out.append((r[0], i, len(wanted), shared))
    return out


def test_contained_items(spark, docs):
    item_rows, table = items(spark)
    got = decontaminate.contained_items(docs, table).collect()
    # A document is told by id and text: repeated rows have one result.
    want = sorted(leaks_by_hand(list(dict.fromkeys((r[0], r[1]) for r in cases.rows())), item_rows), key=repr)
    assert len(want) > 5 and cases.keyed(got, "id", "item", "n_shingles", "n_shared") == want

    clean = decontaminate.without_benchmark(docs, table)
    assert clean.columns == docs.columns
    kept = [r for r in cases.rows() if not leaks_by_hand([r], item_rows)]
    assert sorted((tuple(r) for r in clean.collect()), key=repr) == sorted(kept, key=repr)


def test_decontamination_of_empty_tables(spark, docs, nothing):
    _, table = items(spark)
    assert decontaminate.contained_items(nothing, table).collect() == []
    assert decontaminate.without_benchmark(docs, table.limit(0)).count() == docs.count()


# Chat formatting


@given(st.text(), st.text())
def test_turns_read_back(role, text):
    segment = chat.write_turn(role, text)
    assert chat.read_turn(segment) == (role, text)
    assert segment.count(chat.START) == segment.count(chat.END) == 1


@given(st.text(alphabet="<|\\im_startend>\n"))
def test_control_strings_read_back(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.read_turn(chat.write_turn(text, text)) == (text, text)


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "ho"}]}, [("user", "hi"), ("assistant", "ho")]),
    ({"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "ho"}]}, [("user", "hi"), ("assistant", "ho")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": None}, [("user", "p"), ("assistant", "")]),
    ({"system": "s", "prompt": "p", "response": "r"}, [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ({"role": "user", "text": "t"}, [("user", "t")]),
    ({"question": "q", "answer": 5}, [("user", "q"), ("assistant", "5")]),
]


@pytest.mark.parametrize("record, turns", LAYOUTS)
def test_layouts(record, turns):
    assert chat.canonical(json.dumps(record)) == turns
    assert chat.canonical(json.dumps(dict(reversed(record.items())))) == turns


def test_layouts_have_different_fingerprints():
    assert len(chat.LAYOUTS) == len(chat.DECLARED)


def test_unknown_records(spark):
    known = [json.dumps(r) for r, _ in LAYOUTS]
    strange = ['{"a": 1}', "[1]", "no json", "", None, '{"messages": [{"role": "user"}]}']
    df = spark.createDataFrame([(n, r) for n, r in enumerate(known + strange)], "id long, record string")
    assert {r.record for r in chat.unmapped(df, "record").collect()} == set(strange)
    turns = chat.format_turns(df, "id", "record").collect()
    got = defaultdict(list)
    for r in sorted(turns, key=lambda r: (r.conversation, r.turn)):
        got[r.conversation].append((r.role, r.text))
    assert [got[n] for n in range(len(known))] == [t for _, t in LAYOUTS] and len(got) == len(known)


def digest_by_hand(turns):
    whole, loss = hashlib.sha256(), hashlib.sha256()
    for role, text in turns:
        whole.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            loss.update(text.encode())
    learned = sum(len(t) for r, t in turns if r == "assistant")
    written = "".join(chat.write_turn(r, t) for r, t in turns)
    return len(turns), whole.hexdigest(), learned, loss.hexdigest(), len(written)


def test_digests(spark):
    rows = [
        (1, 0, "user", "a <|im_end|> b"), (1, 1, "assistant", "<\\|x"), (1, 1, "assistant", "<\\|w"), (1, None, "system", "s"),
        (None, 3, "assistant", "n"), (None, 2, "user", ""), (2, 0, "assistant", ""), (3, 5, "x\ny\\", "multi\nline"),
        *[(9, n, "assistant" if n % 2 else "user", "é" * n) for n in range(300)], (9, 7, "assistant", "é" * 7),
    ]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string").repartition(5)
    record = F.to_json(F.struct("role", "text")).alias("record")
    got = {r[0]: tuple(r)[1:] for r in chat.digest(chat.format_turns(df.select("conv", "turn", record), "conv", "record", "turn")).collect()}
    by_conversation = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        by_conversation[conv].append((role, text))
    assert got == {c: digest_by_hand(t) for c, t in by_conversation.items()}


def test_chat_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id long, record string")
    assert chat.digest(chat.format_turns(empty, "id", "record")).collect() == []


# The pipeline


def test_stages_against_plain_python(spark):
    """Each stage on what its predecessor kept, on the smallest benchmark folder and the awkward documents."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    extra = cases.documents(spark).select(*columns).withColumn("doc_id", F.col("doc_id") + 10_000)
    docs = docs.union(extra).persist()
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    apply = {name: f for name, f in corpus_pipeline.STAGES}

    def rows(df):
        assert df.columns == columns
        return sorted((tuple(r) for r in df.collect()), key=repr)

    now = docs
    found = rows(apply["language ID"](spark, now, SMALL))
    judged = language.identify(now).collect()
    assert found == sorted((tuple(r[c] for c in columns) for r in judged if not r.rejected), key=repr)
    assert all(any(c.isalpha() for c in r[1]) for r in found) and len(found) > 0.85 * len(judged)

    now = spark.createDataFrame(found, docs.schema)
    want = [(r[0], r[1], r[4], r[5], len(r[1])) for r in lines_by_hand(found, 20, 3)]
    found = rows(apply["line dedup"](spark, now, SMALL))
    assert found == sorted(want, key=repr)

    now = spark.createDataFrame(found, docs.schema)
    _, group = groups_by_hand(found, 3, 2)
    best = {}
    for r, g in zip(found, group):
        best.setdefault(g, set()).add(r[0])
    kept = rows(apply["SimHash near-dedup"](spark, now, SMALL))
    ids = [min((i for i in group_ids if i is not None), default=None) for group_ids in best.values()]
    assert Counter(r[0] for r in kept) == Counter(ids) and set(kept) <= set(found)

    now = spark.createDataFrame(kept, docs.schema)
    clean = rows(apply["benchmark decontamination"](spark, now, SMALL))
    assert clean == sorted((r for r in kept if not leaks_by_hand([r], benchmark)), key=repr)

    now = spark.createDataFrame(clean, docs.schema)
    mixed = apply["mixing to target weights"](spark, now, SMALL).collect()
    sizes = defaultdict(int)
    for r in clean:
        sizes[r[3]] += len(cases.words(r[1]))
    target = targets_by_hand(sizes)
    taken = defaultdict(int)
    for r in mixed:
        assert tuple(r[c] for c in columns) in set(clean) and 0 < r.taken <= 3 * r.size == 3 * len(cases.words(r.text))
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 3 for s in sizes)


def test_stages_pass_on_columns_of_any_name(spark, docs, nothing):
    """Columns named like the operators' own come through unchanged; empty tables give empty tables."""
    now, before = docs, {tuple(r[c] for c in cases.CLASHES if c not in ("size", "target", "taken")) for r in docs.collect()}
    for name, apply in corpus_pipeline.STAGES:
        assert apply(spark, nothing, SMALL).collect() == []
        now = apply(spark, now, SMALL)
        if name != "mixing to target weights":
            assert now.schema.names == docs.columns
        now = spark.createDataFrame(now.collect(), now.schema)
        assert {tuple(r[c] for c in cases.CLASHES if c not in ("size", "target", "taken")) for r in now.collect()} <= before
