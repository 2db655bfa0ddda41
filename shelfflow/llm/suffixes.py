"""Exact dedup of repeated byte strings by a distributed difference-cover suffix sort.

A string of ``length`` bytes that starts at two places or more of the corpus is removed at all of them. Sorting the
suffixes of every byte would move each byte many times over, so the suffixes are those of a shorter string: a text is
parsed into phrases at anchor points, the places where the hash of ``GRAM`` bytes is lowest among ``width`` places in a
row. Anchors depend on the bytes around them alone, so equal strings have equal anchors and phrases but for their edges, and the
string that starts at a byte belongs to the first anchor that ``width`` places from there give. The suffix sort over phrases:

1. *Sort sampled triples.* Of the phrases of a text, those at places 1 and 2 modulo 3 are the difference-cover sample. Their
   triples of phrase hashes are sorted over the cluster, in ranges, and named by rank. Every string of an anchor holds its
   first five phrases. Of two anchors with an equal string, both are sampled at one of the places 0, 1 or 2 further on:
   anchors where all the names there occur once have no repeated string and leave here.
2. *Recurse on names.* Names that repeat but cover fewer bytes than two strings of one anchor must share are named again: triples of
   names are sorted and ranked, until the names cover those bytes or are unique.
3. *Merge remaining suffixes.* Places 0 modulo 3 are ordered by their first phrase and the name after it. Merging with the sample
   compares one or two phrases and then names, as in any difference-cover sort with period three.
4. *Compare adjacent prefixes.* Neighbours in the order whose first bytes agree form a run. All repeats of a string
   have their anchors in one run.

Two anchors with the same bytes around them, from the first string's begin to the last one's end, share all strings. Only in runs with
different surroundings are the strings themselves compared, by 64-bit hashes, which settles every byte.

Defined cases: NULL and empty texts have no bytes. A repeated row is a text of its own, so strings in it repeat. Ids may be NULL
or repeat, they are only carried along. A character cut by a removed run leaves bytes that are no UTF-8: the bytes left come out as
binary. Other columns are dropped. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfflow.llm import packed
from shelfflow.llm.text import U64, byte_sums, flat, lowest, mix, powers, span_hashes
from shelfflow.sources.staging import stage

GRAM = 16
CHUNK_BYTES = 2 << 20
RANK_BITS = U64(40)


def _spread(length: int) -> int:
    """Places among which an anchor is chosen, so that five phrases lie within every string of their first anchor."""
    return (length - GRAM) // 6


def _shared_bytes(length: int) -> int:
    """Bytes of whole phrases that two anchors with an equal string share at least."""
    return length - 2 * _spread(length) - GRAM


def _spans_of(begin: np.ndarray, end: np.ndarray, size: int = 1 << 17) -> list[tuple[int, int]]:
    """Runs of neighbouring texts of about ``size`` bytes, so that what is in hand stays in the processor's cache."""
    spans, a = [], 0
    while a < len(begin):
        b = max(a + 1, int(np.searchsorted(end, begin[a] + size, "right")))
        spans.append((a, b))
        a = b
    return spans


class Anchors:
    """The anchors of a chunk: ``point``, the strings from ``low`` to ``high`` that belong to it, its phrase."""

    def __init__(self, batch: pa.RecordBatch, length: int):
        self.length = length
        self.data, self.offsets = flat(batch.column("text"))
        width = _spread(length)
        long = np.flatnonzero(np.diff(self.offsets) >= length)
        begin, end = self.offsets[:-1][long], self.offsets[1:][long]
        self.sums = byte_sums(self.data)
        self.point = self.low = self.high = self.end = np.zeros(0, np.int64)
        self.first = np.zeros(len(long) + 1, np.int64)
        if len(long):
            parts = [self._chosen(begin[a:b], end[a:b], width) for a, b in _spans_of(begin, end)]
            self.point, self.low, last, counts = (np.concatenate(x) for x in zip(*parts))
            text = np.repeat(np.arange(len(long)), counts)
            self.high = np.minimum(last, end[text] - length)
            self.first = np.concatenate([[0], np.cumsum(counts)])
            self.end = np.append(self.point[1:], 0)
            self.end[self.first[1:] - 1] = end
        self.phrase = (span_hashes(self.sums, self.point, self.end) >> U64(32)).astype(np.uint32) | np.uint32(1)
        self.owner = self.high >= self.low

    def _chosen(self, begin: np.ndarray, end: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """Of neighbouring texts: the anchors, the first and last run that names each, and their number in each text."""
        lo, hi = begin[0], end[-1]
        sums, (_, down) = self.sums[lo : hi + 1], powers(len(self.sums))
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[lo : hi - GRAM + 1])
        counts = end - begin - (GRAM + width - 1) + 1
        before = np.cumsum(counts) - counts
        runs = np.arange(counts.sum()) + np.repeat(begin - lo - before, counts)
        chosen = lowest(grams, width)[runs]
        new = np.append(True, chosen[1:] != chosen[:-1])
        new[before] = True
        at = np.flatnonzero(new)
        per_text = np.diff(np.searchsorted(at, np.append(before, len(runs))))
        return chosen[at] + lo, runs[at] + lo, runs[np.append(at[1:], len(runs)) - 1] + lo, per_text

    def prefix(self, at: np.ndarray, size: int) -> np.ndarray:
        """32-bit hashes of the first bytes after the anchors."""
        return (span_hashes(self.sums, self.point[at], self.point[at] + size) >> U64(32)).astype(np.uint32)

    def surroundings(self, at: np.ndarray) -> np.ndarray:
        """Hashes of all bytes of an anchor's strings, and where among them the anchor is."""
        around = span_hashes(self.sums, self.low[at], self.high[at] + self.length)
        offset, size = self.point[at] - self.low[at], self.high[at] - self.low[at]
        return mix(around ^ mix((offset * 100_003 + size).astype(U64)))

    def strings(self, at: np.ndarray) -> np.ndarray:
        """Where the strings of some anchors start."""
        counts = self.high[at] - self.low[at] + 1
        before = np.cumsum(counts) - counts
        return np.arange(counts.sum()) + np.repeat(self.low[at] - before, counts)


def _ahead(values: np.ndarray, left: np.ndarray, steps: int) -> np.ndarray:
    """The value some places further on, 0 beyond the text's end."""
    if steps == 0:
        return values
    out = np.zeros_like(values)
    if steps < len(values):
        out[:-steps] = values[steps:]
    out[left <= steps] = 0
    return out


def _distinct_rows(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows in order of their columns, and each row's place among them."""
    order = np.lexsort(columns[::-1])
    ordered = [c[order] for c in columns]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in ordered:
        new[1:] |= c[1:] != c[:-1]
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return [c[new] for c in ordered], place


ROWS = "bucket int, chunk long, size int, rows binary"


def _send(chunk: int, bucket: np.ndarray, columns: list[np.ndarray], place: np.ndarray, more=False) -> pa.RecordBatch:
    """One row per bucket, from distinct rows and each original row's place among them.

    The bucket numbers rise with the rows. Beside the columns goes how often the chunk has a row (up to two), and whether ``more``
    holds for any of them.
    """
    marks = np.minimum(np.bincount(place, minlength=len(bucket)), 2).astype(np.uint8)
    marks[place[np.broadcast_to(more, place.shape)]] |= 4
    columns = [*columns, marks]
    full, begin = np.unique(bucket, return_index=True)
    ends = np.append(begin[1:], len(bucket))
    rows = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(begin, ends)]
    return pa.RecordBatch.from_pydict(
        {
            "bucket": pa.array(full, pa.int32()),
            "chunk": pa.array([chunk] * len(full), pa.int64()),
            "size": pa.array(ends - begin, pa.int32()),
            "rows": pa.array(rows, pa.binary()),
        }
    )


def _gathered(table: pa.Table, kinds: list[type]) -> tuple[list[int], list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket: rows per chunk, the distinct rows, their counts, each row's place, and where ``more`` holds."""
    sizes = table["size"].to_pylist()
    parts: list[list[np.ndarray]] = [[] for _ in [*kinds, np.uint8]]
    for size, data in zip(sizes, table["rows"].to_pylist()):
        at = 0
        for held, kind in zip(parts, [*kinds, np.uint8]):
            held.append(np.frombuffer(data, kind, size, at))
            at += size * np.dtype(kind).itemsize
    *columns, marks = (np.concatenate(p) for p in parts)
    distinct, place = _distinct_rows(columns)
    n = len(distinct[0])
    return sizes, distinct, np.bincount(place, marks & 3, n), place, np.bincount(place, marks >> 2, n) > 0


def _reply(table: pa.Table, sizes: list[int], answers: np.ndarray, place: np.ndarray, left_open: int = 0) -> pa.Table:
    """Each chunk's answers in the order of its rows; ``open`` says once what the bucket leaves open."""
    parts = np.split(answers[place], np.cumsum(sizes)[:-1])
    answer = pa.array([packed.squeeze(p) for p in parts], pa.binary())
    still = pa.array([left_open] + [0] * (len(sizes) - 1), pa.int64())
    return pa.table(
        {"chunk": table["chunk"], "bucket": table["bucket"], "size": table["size"], "answer": answer, "open": still}
    )


REPLY = "chunk long, bucket int, size int, answer binary, open long"


def _replies(sent: DataFrame, of_bucket) -> DataFrame:
    """Staged, per chunk."""
    replies = sent.groupBy("bucket").applyInArrow(of_bucket, REPLY)
    answers = F.sort_array(F.collect_list(F.struct("bucket", "size", "answer"))).alias("answers")
    return stage(replies.groupBy("chunk").agg(answers, F.sum("open").alias("open")))


def _open(replies: DataFrame) -> int:
    """Names that repeat, don't cover enough and can still be extended."""
    return replies.agg(F.sum("open")).first()[0] or 0


def _received(answers: list[dict] | None, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The answers to all rows of a chunk and the buckets they come from."""
    parts = [np.empty(0, kind)]
    buckets = [np.empty(0, np.int64)]
    for part in answers or []:
        size = part["size"] * np.dtype(kind).itemsize
        parts.append(np.frombuffer(pa.decompress(part["answer"], size, "zstd"), kind))
        buckets.append(np.full(part["size"], part["bucket"]))
    return np.concatenate(parts), np.concatenate(buckets)


def _rank_rows(kinds: list[type]):
    """Names of a bucket's rows: twice the rank from 1 on, plus one if the row occurs twice or more."""

    def of_bucket(table: pa.Table) -> pa.Table:
        sizes, _, counts, place, more = _gathered(table, kinds)
        ranks = np.arange(1, len(counts) + 1, dtype=np.uint32) * np.uint32(2) + (counts >= 2)
        return _reply(table, sizes, ranks.astype(np.uint32), place, int((more & (counts >= 2)).sum()))

    return of_bucket


class Names:
    """What is known of the phrases of a chunk: names of sampled places, and names within names."""

    def __init__(self, phrase: np.ndarray, span: np.ndarray, first: np.ndarray, length: int, buckets: int):
        self.phrase, self.enough, self.buckets = phrase, _shared_bytes(length), buckets
        counts = np.diff(first)
        self.place = np.arange(len(phrase)) - np.repeat(first[:-1], counts)
        self.left = np.repeat(first[1:], counts) - np.arange(len(phrase))
        self.sample = np.flatnonzero(self.place % 3 != 0)
        self.name = np.zeros(len(phrase), U64)
        self.within = np.zeros(len(phrase), np.uint32)
        self.twice = np.zeros(len(phrase), bool)
        self.short = np.zeros(len(phrase), bool)
        # Bytes that a place's name covers: three phrases at first.
        self.covered = span + _ahead(span, self.left, 1) + _ahead(span, self.left, 2)

    def answered(self, row: dict, rounds: int) -> Names:
        if "names" in row:
            self._name(row["names"])
            for step in range(rounds):
                self._refine(row[f"round{step}"], 3 ** (step + 1))
        return self

    def triples(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct rows of three phrases for the sampled places."""
        return _distinct_rows([_ahead(self.phrase, self.left, k)[self.sample] for k in range(3)])

    def range_of(self, phrase: np.ndarray) -> np.ndarray:
        return (phrase.astype(U64) * U64(self.buckets) >> U64(32)).astype(np.int64)

    def _name(self, answers: list[dict] | None) -> None:
        _, place = self.triples()
        ranks, buckets = _received(answers, np.uint32)
        names = (buckets.astype(U64) << RANK_BITS) | (ranks >> np.uint32(1)).astype(U64)
        self.name[self.sample] = names[place]
        self.twice[self.sample] = (ranks & np.uint32(1)).astype(bool)[place]
        self.short = self.twice & (self.covered < self.enough)

    def names_of_names(self, step: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Distinct rows of three names, ``step`` places apart, for the places whose first name was short."""
        at = np.flatnonzero(self.short)
        columns = []
        for k in range(3):
            there = np.minimum(at + k * step, len(self.name) - 1)
            inside = self.left[at] > k * step
            columns += [np.where(inside, values[there], 0).astype(values.dtype) for values in (self.name, self.within)]
        return _distinct_rows(columns)

    def _refine(self, answers: list[dict] | None, step: int) -> None:
        _, place = self.names_of_names(step)
        ranks, _ = _received(answers, np.uint32)
        self.extend(step)
        self.within[self.short] = (ranks >> np.uint32(1))[place]

    def extend(self, step: int) -> None:
        """Names of three names cover what these cover."""
        at = np.flatnonzero(self.short)
        total = self.covered[at]
        for k in (1, 2):
            there = np.minimum(at + k * step, len(self.name) - 1)
            total = total + np.where(self.left[at] > k * step, self.covered[there], 0)
        self.covered[at] = total

    def unsure(self, at: np.ndarray, phrases: int) -> np.ndarray:
        """Whether the names of these places, of so many phrases, must be named again if they repeat."""
        return (self.covered[at] < self.enough) & (self.left[at] > phrases)

    def range_of(self, phrase: np.ndarray) -> np.ndarray:
        return (phrase.astype(U64) * U64(self.buckets) >> U64(32)).astype(np.int64)


class _Text:
    """A chunk's texts with their anchors and names."""

    def __init__(self, row: dict, length: int, buckets: int, rounds: int):
        self.chunk, self.length = row["chunk"], length
        self.batch = packed.unpack_batch(row["payload"])
        self.anchors = a = Anchors(self.batch, length)
        self.names = Names(a.phrase, a.end - a.point, a.first, length, buckets).answered(row, rounds)

    def candidates(self) -> np.ndarray:
        """Anchors of strings with a repeated name within two places."""
        twice, left = self.names.twice, self.names.left
        return np.flatnonzero(self.anchors.owner & (twice | _ahead(twice, left, 1) | _ahead(twice, left, 2)))

    def suffixes(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Merge rows of the candidates, each one's place among them, and the candidates.

        A row has the place modulo 3, one or two phrases, the name after them, and one more name: that of the suffix itself in
        the sample, that two places on outside of it; then the hashes of its first bytes and its surroundings.
        """
        a, n, at = self.anchors, self.names, self.candidates()
        kind = (n.place[at] % 3).astype(np.uint8)
        names = [[_ahead(values, n.left, k)[at] for values in (n.name, n.within)] for k in range(3)]
        after = [np.where(kind == 2, two, one) for one, two in zip(names[1], names[2])]
        other = [np.where(kind == 0, two, own) for own, two in zip(names[0], names[2])]
        second = np.where(kind == 1, np.uint32(0), _ahead(n.phrase, n.left, 1)[at])
        columns = [a.phrase[at], kind, second, *after, *other, a.prefix(at, _shared_bytes(self.length)), a.surroundings(at)]
        return *_distinct_rows(columns), at


SUFFIX = [np.uint32, np.uint8, np.uint32, U64, np.uint32, U64, np.uint32, np.uint32, U64]
ALONE, ALL, COMPARE, ALL_AND_COMPARE = range(4)


def _merged_order(first, kind, second, after, other) -> np.ndarray:
    """How many suffixes come before each one: the three kinds merged by phrases and names."""

    def dense(*columns) -> np.ndarray:
        return _distinct_rows(list(columns))[1]

    one, own = dense(first, *after), dense(*other)
    zero, ones, twos = (np.flatnonzero(kind == k) for k in range(3))
    sample = np.concatenate([ones, twos])

    def fewer(key: np.ndarray, among: np.ndarray, than: np.ndarray) -> np.ndarray:
        return np.searchsorted(np.sort(key[among]), key[than])

    # By two phrases and the name after both: for kind 0 that is the other name.
    far = dense(first, second, *[np.where(kind == 0, o, a) for a, o in zip(after, other)])
    before = np.zeros(len(kind), np.int64)
    before[zero] = fewer(one, zero, zero) + fewer(one, ones, zero) + fewer(far, twos, zero)
    before[ones] = fewer(own, sample, ones) + fewer(one, zero, ones)
    before[twos] = fewer(own, sample, twos) + fewer(far, zero, twos)
    return before


def _judge(table: pa.Table) -> pa.Table:
    """Merge a range of suffixes, compare neighbours, and say of each whether all, some or none of its strings may repeat."""
    sizes, distinct, counts, place, _ = _gathered(table, SUFFIX)
    first, kind, second, after, after_in, other, other_in, prefix, around = distinct
    before = _merged_order(first, kind, second, (after, after_in), (other, other_in))
    order = np.argsort(before, kind="stable")
    run = np.zeros(len(order), np.int64)
    run[order] = np.cumsum(np.append(True, prefix[order][1:] != prefix[order][:-1]))
    (runs, _), group = _distinct_rows([run, around])
    total = np.bincount(group, counts)
    different = np.bincount(runs)[runs]
    verdict = np.where(
        total >= 2, np.where(different > 1, ALL_AND_COMPARE, ALL), np.where(different > 1, COMPARE, ALONE)
    ).astype(np.uint8)
    return _reply(table, sizes, verdict[group], place)


def remove_repeated_strings(
    docs: DataFrame, length: int = 400, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Every row as ``id_column``, ``kept`` (binary: the bytes left), ``n_bytes``, ``n_removed`` and ``n_spans`` (removed runs)."""
    if length < GRAM + 12:
        raise ValueError(f"length must be at least {GRAM + 12}")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, total // (8 << 20) + 1)
    buckets = max(least, total // (32 << 20) + 1)
    texts = packed.chunks(rows, "text", CHUNK_BYTES, parts).drop("size")

    def each(frame: DataFrame, step, schema: str) -> DataFrame:
        """Apply a function to one chunk after another."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    yield step(batch.slice(n, 1).to_pylist()[0])

        return frame.mapInArrow(run, schema)

    def parse(row: dict) -> pa.RecordBatch:
        a = Anchors(packed.unpack_batch(row["payload"]), length)
        arrays = [a.phrase, (a.end - a.point).astype(np.uint32), a.first.astype(np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array([row["chunk"]]), *[pa.array([x.tobytes()], pa.binary()) for x in arrays]],
            names=["chunk", "phrase", "span", "first"],
        )

    # The phrases alone: naming needs no texts.
    phrases = packed.co_located(each(texts, parse, "chunk long, phrase binary, span binary, first binary"), parts)

    def names_of(row: dict, rounds: int) -> Names:
        phrase, span, first = (np.frombuffer(row[c], k) for c, k in (("phrase", np.uint32), ("span", np.uint32), ("first", np.int64)))
        return Names(phrase, span.astype(np.int64), first, length, buckets).answered(row, rounds)

    def send_triples(row: dict) -> pa.RecordBatch:
        names = names_of(row, 0)
        columns, place = names.triples()
        return _send(row["chunk"], names.range_of(columns[0]), columns, place, names.unsure(names.sample, 3))

    replies = _replies(each(phrases, send_triples, ROWS), _rank_rows([np.uint32] * 3))
    answers = {"names": replies}
    rounds = 0
    while _open(replies):

        def send_names(row: dict, rounds=rounds) -> pa.RecordBatch:
            names, step = names_of(row, rounds), 3 ** (rounds + 1)
            columns, place = names.names_of_names(step)
            names.extend(step)
            more = names.unsure(np.flatnonzero(names.short), 3 * step)
            return _send(row["chunk"], (columns[0] >> RANK_BITS).astype(np.int64), columns, place, more)

        replies = _replies(each(_with(phrases, answers), send_names, ROWS), _rank_rows([U64, np.uint32] * 3))
        answers[f"round{rounds}"] = replies
        rounds += 1

    known = _with(texts, answers)

    def over(frame: DataFrame, step, schema: str) -> DataFrame:
        return each(frame, lambda row: step(_Text(row, length, buckets, rounds), row), schema)

    def send_suffixes(text: _Text, row: dict) -> pa.RecordBatch:
        columns, place, _ = text.suffixes()
        return _send(text.chunk, text.names.range_of(columns[0]), columns, place)

    judged = _replies(over(known, send_suffixes, ROWS), _judge)
    known = _with(known, {"verdicts": judged})

    def verdicts(text: _Text, row: dict) -> tuple[np.ndarray, np.ndarray]:
        """The anchors to remove all strings of, and the strings to compare."""
        _, place, at = text.suffixes()
        verdict = _received(row["verdicts"], np.uint8)[0][place]
        return at[(verdict == ALL) | (verdict == ALL_AND_COMPARE)], at[verdict >= COMPARE]

    def hashes(text: _Text, starts: np.ndarray) -> np.ndarray:
        return span_hashes(text.anchors.sums, starts, starts + length)

    def send_strings(text: _Text, row: dict) -> pa.RecordBatch:
        keys = hashes(text, text.anchors.strings(verdicts(text, row)[1]))
        return packed.send(text.chunk, *packed.distinct(keys), buckets)

    compared = stage(packed.repeated(over(known, send_strings, packed.SENT)))
    known = _with(known, {"strings": compared})

    def write(text: _Text, row: dict) -> pa.RecordBatch:
        whole, some = verdicts(text, row)
        a = text.anchors
        starts = a.strings(some)
        keys = hashes(text, starts)
        sorted_keys, _ = packed.distinct(keys)
        again = packed.members(sorted_keys, packed.receive(row["strings"], sorted_keys, buckets), keys)
        edges = np.zeros(len(a.data) + 1, np.int64)
        edges += np.bincount(a.low[whole], minlength=len(edges))
        edges -= np.bincount(a.high[whole] + length, minlength=len(edges))
        edges += np.bincount(starts[again], minlength=len(edges))
        edges -= np.bincount(starts[again] + length, minlength=len(edges))
        gone = np.cumsum(edges)[:-1] > 0
        return _without(text.batch, a, gone)

    kind = rows.schema["id"].dataType.simpleString()
    columns = f"id {kind}, kept binary, n_bytes long, n_removed long, n_spans long"
    return over(known, write, columns).withColumnRenamed("id", id_column)


def _with(frame: DataFrame, answers: dict[str, DataFrame]) -> DataFrame:
    """The chunks with the answers of some steps, each in a column of its name."""
    for name, replies in answers.items():
        frame = packed.with_answers(frame, replies.select("chunk", "answers"), name)
    return frame


def _without(batch: pa.RecordBatch, a: Anchors, gone: np.ndarray) -> pa.RecordBatch:
    sizes = np.diff(a.offsets)
    removed = np.concatenate([[0], np.cumsum(gone)])
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    first = a.offsets[:-1][sizes > 0]
    begins[first] = gone[first]
    spans = np.concatenate([[0], np.cumsum(begins)])
    left = a.data[~gone]
    kept_at = a.offsets - removed[a.offsets]
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), batch.num_rows, [None, pa.py_buffer(kept_at.astype(np.int64)), pa.py_buffer(left)]
    )
    return pa.RecordBatch.from_pydict(
        {
            "id": batch.column("id"),
            "kept": kept.cast(pa.binary()),
            "n_bytes": pa.array(sizes),
            "n_removed": pa.array(np.diff(removed[a.offsets])),
            "n_spans": pa.array(np.diff(spans[a.offsets])),
        }
    )
