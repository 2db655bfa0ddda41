"""Awkward documents and plain-Python definitions for the corpus operators."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\x0c\r"

# Columns whose names the operators use themselves, beside those of documents.
CLASHES = [
    "id", "content", "fp", "root", "size", "target", "taken", "chunk", "payload", "key", "item", "score",
    "n_words", "kept", "n_lines", "rejected", "draw", "held_out",
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in CLASHES],
    ]
)


def words(text):
    return WORD.findall(text or "")


def low_words(text):
    return words((text or "").translate(UPPER))


def rows(seed=3, count=60):
    """Texts with shared passages, copies, near copies, blank and NULL texts, NULL and repeated ids."""
    rng = random.Random(seed)
    vocabulary = ["La", "maison", "der", "Hund", "the", "cat,", "élan", "Über.", "x", "日本", "a#b", "<|", "$5"] + [
        "".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(80)
    ]

    def prose(n):
        return "".join(w + rng.choice([" ", " ", " ", "  ", "\n", "\t", ". "]) for w in rng.choices(vocabulary, k=n))

    passages = [prose(60) for _ in range(4)]
    texts = [None, None, "", " \n\t ", "!!! 123  ", "Ünö", "x", "one two", "a a a a a a a a a a a a a a a a a a a a a a a a"]
    texts += ["z" * 3000, "spam ham " * 400, prose(4000)]
    while len(texts) < count:
        kind = rng.random()
        if kind < 0.25:
            texts.append(rng.choice([t for t in texts if t]))
        elif kind < 0.4:
            tokens = rng.choice([t for t in texts if t and len(t) > 40]).split(" ")
            tokens[rng.randrange(len(tokens))] = "changed"
            texts.append(" ".join(tokens))
        elif kind < 0.7:
            texts.append(prose(rng.randint(0, 80)) + rng.choice(passages) + prose(rng.randint(0, 80)))
        else:
            texts.append(prose(rng.randint(1, 200)))
    out = []
    for n, text in enumerate(texts):
        lang = rng.choice(["en", "de", None])
        out.append((n if n % 17 else None, text, lang, rng.choice(["b", "a", "c", None, "ä", "a"]), len(text or "")))
    out += [out[20], out[20], out[0], out[3]]
    return [r + tuple(f"{c}{n % 3}" if n % 4 else None for c in CLASHES) for n, r in enumerate(out)]


def documents(spark, seed=3, count=60):
    return spark.createDataFrame(rows(seed, count), SCHEMA)


def keyed(found, *columns):
    """Rows as sorted tuples of some columns."""
    return sorted((tuple(r[c] for c in columns) for r in found), key=repr)
