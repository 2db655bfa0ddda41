"""Language model, language ID and quality rules: exact parts against plain Python, learned parts on held-out rows."""

import itertools
import math
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfflow.llm import gru, language, lm, quality

SMALL = "/root/testdata/sf0.001"


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


# Language model


def numbers(seed=0):
    rng = np.random.default_rng(seed)
    return [rng.integers(1, 20, n).astype(np.uint16) for n in (5, 40, 1, 0, 90, 33)]


def test_gradient_equals_differences():
    shape, documents = gru.Shape(20, 4, 3), numbers()
    flat = shape.start(np.ones(20)).astype(np.float64)
    lanes = gru.Lanes(documents, 3)
    inputs, live, place = next(lanes.windows())
    targets = lanes.symbols[place[live]]

    def loss(parameters):
        network = gru.Network(shape, parameters)
        states, _ = network.run(inputs, np.zeros((inputs.shape[1], 4)))
        return -network.log_probability(states[live].astype(np.float64), targets).mean()

    network = gru.Network(shape, flat)
    states, tape = network.run(inputs, np.zeros((inputs.shape[1], 4)))
    slope = network.gradient(inputs, live, targets, states, tape)
    for i in np.random.default_rng(1).integers(0, shape.size, 30):
        step = np.zeros(shape.size)
        step[i] = 1e-3
        assert slope[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-3, abs=2e-6)


def test_probabilities_add_up_to_one():
    shape = gru.Shape(21, 4, 3)
    network = gru.Network(shape, shape.start(np.arange(21)))
    states = np.random.default_rng(0).standard_normal((5, 4)).astype(np.float32)
    symbols = np.arange(shape.classes * shape.per_class)
    total = sum(np.exp(network.log_probability(states, np.full(5, s))) for s in symbols)
    assert total == pytest.approx(np.ones(5), abs=1e-5)


def test_scores_do_not_depend_on_lanes_or_windows():
    """A document alone, step by step, has the score it has among others: the state is carried and reset."""
    shape, documents = gru.Shape(20, 4, 3), numbers()
    flat = shape.start(np.ones(20))
    network = gru.Network(shape, flat)
    for lanes in (1, 2, 8):
        got = gru.score(shape, flat, documents, lanes)
        for document, score in zip(documents, got):
            state, total, last = np.zeros((1, 4), np.float32), 0.0, 0
            for symbol in [*document.tolist(), 0]:
                states, _ = network.run(np.array([[last]]), state)
                state, last = states[0], symbol
                total += network.log_probability(state, np.array([symbol]))[0]
            assert score == pytest.approx(total, rel=1e-4)


def test_training_learns_an_order():
    shape = gru.Shape(9, 8, 3)
    documents = [np.array([1, 2, 3, 4, 5, 6, 7, 8] * 10, np.uint16) for _ in range(8)]
    flat = shape.start(np.ones(9))
    trainer = gru.Trainer(shape, flat, 0.03)
    for _ in range(30):
        trainer.learn(documents, 8)
    assert gru.score(shape, trainer.flat, documents).sum() > 0.2 * gru.score(shape, flat, documents).sum()


def base_by_hand(rows):
    counts = Counter()
    for r in rows:
        if crc(r[0]) % 10:
            counts.update(cases.low_words(r[1]))
            counts["\n"] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for r in rows:
        tokens = [*cases.low_words(r[1]), "\n"]
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        out.append((r[0], crc(r[0]) % 10 == 0, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    return out


def test_base_scores(docs):
    got = lm.score_texts(docs).withColumn("base_score", F.round("base_score", 6)).collect()
    columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    assert cases.keyed(got, *columns) == sorted(base_by_hand(cases.rows()), key=repr)
    assert all(r.score < 0 for r in got)


def test_shares_of_a_bucket_add_up(spark):
    """Over all words of a bucket and one unseen, the shares make one."""
    vocabulary = lm.Vocabulary.__new__(lm.Vocabulary)
    counts = np.array([5, 3, 2, 1])
    keys = np.array([128, 256, 384, 512], np.uint64)
    vocabulary.keys, vocabulary.rank = np.empty(0, np.uint64), np.empty(0, np.int64)
    vocabulary.rest = np.bincount([0] * 4, counts, lm.BUCKETS).astype(np.int64)
    vocabulary.rest_words = np.bincount([0] * 4, minlength=lm.BUCKETS)
    symbols, share = vocabulary.symbols_of(keys, counts)
    unseen = vocabulary.symbols_of(np.array([1024], np.uint64), np.array([0]))[1]
    assert set(symbols) == {1} and (10**share).sum() + 10 ** unseen[0] == pytest.approx(1)


def test_model_beats_the_base_on_held_out_texts(spark):
    found = lm.score_texts(spark.read.parquet(f"{SMALL}/documents.parquet")).filter("held_out")
    score, base = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


# Language ID


def test_trigrams():
    """Letters in lower case, one space around every run of them, each text by itself."""
    texts = ["The cat, the CAT!", "", None, "1234 !!", "élan Élan", "a", "日本語 text", "a", "..x..y"]
    counts, letters = language.trigram_counts(texts)
    assert letters.tolist() == [sum(c.isalpha() for c in (t or "")) for t in texts]
    for row, t in zip(counts, texts):
        runs = "".join(c if c.isalpha() else " " for c in (t or "").lower()).split()
        spaced = f" {' '.join(runs)} " if runs else ""
        assert sorted(row[row > 0]) == sorted(Counter(zip(spaced, spaced[1:], spaced[2:])).values())
        alone, _ = language.trigram_counts([t])
        assert (alone[0] == row).all()


def test_languages_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = language.identify(docs).filter("held_out AND lang IS NOT NULL AND length(text) > 50")
    right, total = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 20 and right > 0.9


def test_rows_without_letters_are_undetermined(docs):
    got = language.identify(docs, prefix="x_")
    assert got.columns[: len(docs.columns)] == docs.columns
    for r in got.collect():
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.x_lang_pred != "und") == lettered and 0 <= r.x_score <= 1
        assert r.x_held_out == (crc(r.doc_id) % 4 == 2)
        if not lettered:
            assert r.x_rejected and r.x_score == 0
        else:
            assert r.x_lang_pred in ("de", "en")


def test_lang_is_no_input_of_a_prediction(docs):
    """Labels of held-out rows change nothing."""
    changed = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id"), 4, 2), F.lit("zz")).otherwise(F.col("lang")))
    columns = ["doc_id", "lang_pred", "score", "rejected"]
    assert cases.keyed(language.identify(docs).collect(), *columns) == cases.keyed(language.identify(changed).collect(), *columns)


def test_without_labels_all_is_undetermined(docs):
    got = language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in got} == {"und"}


def test_noise_is_rejected_and_prose_is_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    apart = next(n for n in range(-1, -99, -1) if crc(n) % 4 == 2)
    noise = spark.createDataFrame([(apart, "qx " * 400, "en")], "doc_id long, text string, lang string")
    found = language.identify(docs.select("doc_id", "text", "lang").union(noise)).select("doc_id", "rejected").collect()
    rejected = {r.doc_id for r in found if r.rejected}
    assert apart in rejected and len(rejected) < 0.05 * len(found)


LENGTHS = (30, 64, 200, 400, 1000, 3000, 10_000, 50_000)
CYRILLIC, GREEK, CJK = "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", [chr(n) for n in range(0x4E00, 0x5A00)]
RUSSIAN = ["при", "вет", "мо", "ро", "ка", "сно", "ва", "ле", "ние", "ста", "про", "зде", "ть", "ого", "ем", "ша"]
FINNISH = ["ka", "lo", "mi", "tu", "sä", "vei", "nen", "kku", "tta", "ry", "hyö", "pa", "jär", "ssa", "ell", "ään"]


def letters(alphabet, n, rng):
    """Random letters in words of two to nine."""
    ends = np.cumsum(rng.integers(2, 10, n))
    drawn = "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))
    return " ".join(drawn[a:b] for a, b in zip([0, *ends], ends) if drawn[a:b])


def speech(syllables, n, rng):
    """Words of a small language with these syllables."""
    known = ["".join(syllables[i] for i in rng.integers(0, len(syllables), k)) for k in rng.integers(1, 4, 400)]
    words = [known[i] for i in rng.integers(0, 400, n)]
    return " ".join(words[: 1 + int(np.searchsorted(np.cumsum([len(w) for w in words]), n))])


def language_model(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumnRenamed("doc_id", "id")
    apart = language.held_out(F.col("id"), 4, 2)
    prose = [r.text for r in docs.filter(apart).collect() if any(c.isalpha() for c in r.text or "")]
    return language.train(docs.filter(~apart)), prose


def test_unlearned_scripts_are_rejected_at_every_length(spark):
    model, prose = language_model(spark, "/root/testdata/sf0.01")
    rng = np.random.default_rng(4)
    for n in LENGTHS:
        foreign = [letters(a, n, rng) for a in (CYRILLIC, GREEK, CJK)] + [speech(RUSSIAN, n, rng)]
        assert model.predict(foreign)[2].all(), n
    assert model.predict(prose)[2].mean() < 0.02


def test_junk_among_the_training_rows_moves_no_limit():
    """A tenth of the texts far from their language leaves the limit where it is, near enough."""
    clean = np.zeros((1, language.SIZES, language.STEPS))
    clean[0, 16, 40:61] = 900 / 21
    junk = clean.copy()
    junk[0, 16, 230] = 100
    limits = [language._limits(x, 6.0)[0, 16] for x in (clean, junk)]
    assert limits[0] < 0.5 and limits[1] - limits[0] < 0.05


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_lengths_that_training_hardly_has_are_judged_too(spark, folder):
    """The longest training text has fewer distinct trigrams than these, whatever the number of training rows."""
    model, prose = language_model(spark, folder)
    rng = np.random.default_rng(6)
    for n in (n for n in LENGTHS if n >= 400):
        foreign = [letters("abcdefghijklmnopqrstuvwxyz", n, rng) for _ in range(3)] + [speech(FINNISH, n, rng) for _ in range(3)]
        assert model.predict(foreign)[2].all(), n
    assert model.predict(prose)[2].mean() < 0.02


def test_limits_do_not_jump_with_the_number_of_rows():
    """One text more changes a limit little; lengths without a text take it from the nearest."""
    for n in (1, 10, 29, 300):
        spread = np.zeros((2, language.SIZES, language.STEPS))
        spread[0, 16, 40:60] = 100
        spread[0, 20, 20] = n
        more = spread.copy()
        more[0, 20, 20] += 1
        limits, then = language._limits(spread, 6.0), language._limits(more, 6.0)
        assert np.abs(limits[0, 16:] - then[0, 16:]).max() < 0.1
        assert limits[0, 16:].max() < 0.6 and (limits[1, 16:] < 0.6).all()


# Quality rules


def counts_by_hand(text):
    tokens = cases.words(text)
    windows = [tuple(tokens[i : i + 8]) for i in range(len(tokens) - 7)]
    repeated, gone = Counter(windows), [False] * len(tokens)
    for i, w in enumerate(windows):
        if repeated[w] > 1:
            gone[i : i + 8] = [True] * 8
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if cases.words(line):
            duplicates += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(tokens), sum(map(len, tokens)), symbols, duplicates, sum(gone)


def test_counts(docs):
    labels = docs.sparkSession.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.apply_quality_rules(docs, labels, prefix="x_").collect()
    columns = ["doc_id", "x_n_words", "x_word_chars", "x_n_symbols", "x_n_dup_lines", "x_n_repeat_words", "x_base_failed", "x_kept"]
    want = []
    for r in cases.rows():
        n, chars, symbols, duplicates, repeats = counts_by_hand(r[1])
        failed = n < 20 or 100 * repeats > 30 * n
        want.append((r[0], n, chars, symbols, duplicates, repeats, failed, not failed))
    assert cases.keyed(got, *columns) == sorted(want, key=repr)


def test_decoding_finds_the_best_path():
    rng = np.random.default_rng(3)
    for _ in range(20):
        model = quality.LineModel(rng.standard_normal((len(quality.FEATURES), 2)), rng.standard_normal((2, 2)) * 2)
        features = rng.random((6, len(quality.FEATURES))) < 0.4
        own = features @ model.emission

        def total(path):
            return sum(own[i, s] for i, s in enumerate(path)) + sum(model.transition[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=6), key=total)
        assert tuple(model.decode(features).astype(int)) == best


def test_likelihood_training_separates_kinds_of_lines(spark):
    rng = np.random.default_rng(5)
    good = "La maison est grande et le chat dort dans le jardin avec les enfants.\n"
    bad = "BUY!! NOW!! $$$ ### &&& ***\n"
    rows = [(n, (good if n % 2 else bad) * int(rng.integers(5, 20)) + f"{n} more words here") for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, n % 2, 0) for n in range(40)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, "doc_id", "text")
    share = {r.doc_id: r.content_share for r in quality.assess(docs, model).collect()}
    assert all((share[n] > 0.5) == bool(n % 2) for n in range(60))


def test_labelled_quality_is_followed(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.apply_quality_rules(docs, labels).join(labels, "doc_id")
    good, bad = (judged.filter(f"quality = {q} AND NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0] for q in (1, 0))
    assert good > 0.95 and (bad is None or bad < 0.5)


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert lm.score_texts(nothing).collect() == []
    assert language.identify(nothing).collect() == []
    assert quality.apply_quality_rules(nothing, labels).collect() == []
