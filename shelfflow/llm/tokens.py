"""Token counts by compiled finite-state transducers, without running a tokenizer.

A byte-level BPE vocabulary is compiled into two deterministic transducers.

* The splitter reads code points by class and marks where pieces begin; it has ``STATES`` states. A batch of
  texts is cut into chunks of ``CHUNK`` code points that all run side by side. A first run takes each chunk through every state
  and gives its state map (from the state it is entered in to the one it is left in); the maps are composed by a parallel
  prefix scan, which tells the state each chunk is entered in; a second run marks the pieces.
* The counter reads the bytes of a piece. Its state holds, for every place where a token still growing may have begun, the place in the
  trie of tokens, the last token of the encoding up to there and how many tokens that is behind now; each transition
  carries the change of the number of tokens. BPE encodings have one last token for each prefix, and two tokens
  may follow one another if merging their bytes gives just those two, so the state decides all that follows. States are
  compiled when text first reaches them and forgotten when there are more than ``MAX_STATES``; a piece is
  counted in one run over its bytes, whatever its length.

Counts of short pieces are remembered, as far as ``MAX_PIECES`` go. Special tokens inside texts are found first and count one each, as the
library does by default; no begin or end is added. The vocabulary file is read once on the driver and broadcast: its size does not depend on
the data.

Defined cases: a NULL or empty text has 0 bytes and 0 tokens; a NULL id stays NULL; repeated rows are counted each for itself. All columns
come out; ``<prefix>n_bytes``, ``n_tokens`` and ``over_limit`` are added and replace columns of that name. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelfflow.llm.text import flat, sliced

CHUNK = 256
MAX_STATES = 200_000
MAX_PIECES = 500_000
LONG_PIECE = 64

# Classes of code points: letters by what they can be in a contraction, digits, other, apostrophe, space, other white space, and the end of a text.
LETTER, STMD, RV, E, L, NUMBER, OTHER, APOSTROPHE, SPACE, WHITE, END = range(11)
CLASSES = 11
# The letters of the contractions 's 't 'm 'd 're 've 'll.
IN_CONTRACTIONS = {"s": STMD, "t": STMD, "m": STMD, "d": STMD, "r": RV, "v": RV, "e": E, "l": L}

# States: at the start of a piece; in a run of letters, numbers, others; after one or several white characters, of which the last is a
# space or another; after an apostrophe that may open a contraction, and after its r or v, or l; after a contraction.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE, OPEN, OPEN_RV, OPEN_L, DONE = range(12)
STATES = 12
# Outputs: a piece begins here, or began one code point before.
HERE, BEFORE = 1, 2


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", WHITE)):
        for run in regex.finditer(pattern, text):
            out[ord(run[0][0]) : ord(run[0][-1]) + 1] = kind
    out[0xD800:0xE000] = OTHER
    out[ord(" ")], out[ord("'")] = SPACE, APOSTROPHE
    for letter, kind in IN_CONTRACTIONS.items():
        out[ord(letter)] = kind
    return out


@cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output of each state and class, flat."""
    to, out = np.zeros((STATES, CLASSES), np.uint8), np.zeros((STATES, CLASSES), np.uint8)
    letters, white = range(LETTER, L + 1), {SPACE: (ONE_SPACE, MORE_SPACE), WHITE: (ONE_WHITE, MORE_WHITE)}
    run = {**dict.fromkeys(letters, IN_LETTERS), NUMBER: IN_NUMBERS, OTHER: IN_OTHERS}
    for state in range(STATES):
        spaces = state in (ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE)
        attached = state in (ONE_SPACE, MORE_SPACE)  # the last space goes with what follows it
        late = BEFORE if state in (MORE_SPACE, MORE_WHITE, OPEN_RV, OPEN_L) else 0
        for kind in range(END):
            if kind in white:
                to[state, kind] = white[kind][spaces]
                out[state, kind] = 0 if spaces else HERE
            elif kind == APOSTROPHE:
                goes_on = attached or state in (IN_OTHERS, OPEN)
                to[state, kind] = IN_OTHERS if goes_on else OPEN
                out[state, kind] = 0 if goes_on else HERE
            else:
                to[state, kind] = run[kind]
                same = state == run[kind] or (state in (OPEN_RV, OPEN_L) and kind in letters) or (state == OPEN and kind == OTHER)
                out[state, kind] = 0 if attached or same else HERE
            if not (spaces and kind in white):
                out[state, kind] |= late
        to[state, END] = START
        out[state, END] = HERE | (late if state in (OPEN_RV, OPEN_L) else 0)
    for kind, state in ((STMD, DONE), (RV, OPEN_RV), (L, OPEN_L)):
        to[OPEN, kind], out[OPEN, kind] = state, 0
    to[OPEN_RV, E], out[OPEN_RV, E] = DONE, 0
    to[OPEN_L, L], out[OPEN_L, L] = DONE, 0
    return to.ravel(), out.ravel()


def entered_in(maps: np.ndarray) -> np.ndarray:
    """The state each chunk is entered in, given the state maps: a prefix scan that doubles its reach."""
    total, reach = maps.copy(), 1
    while reach < len(total):
        total[reach:] = np.take_along_axis(total[reach:], total[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return np.concatenate([[START], total[:-1, START]]).astype(np.intp)


def piece_starts(kinds: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Whether a piece begins at each code point; an ``END`` ends the piece before it."""
    to, out = splitter()
    lanes = -(-len(kinds) // chunk)
    grid = np.full(lanes * chunk, END, np.intp)
    grid[: len(kinds)] = kinds
    grid = np.ascontiguousarray(grid.reshape(lanes, chunk).T)
    maps = np.broadcast_to(np.arange(STATES, dtype=np.intp), (lanes, STATES))
    for step, column in enumerate(grid):
        maps = to[maps * CLASSES + column[:, None]].astype(np.intp)
        # Most chunks forget the state they were entered in after a few code points.
        if step == 15 and (maps == maps[:, :1]).all():
            maps = maps[:, :1]
    state = entered_in(np.broadcast_to(maps, (lanes, STATES)))
    marks = np.empty((chunk, lanes), np.uint8)
    for step, column in enumerate(grid):
        at = state * CLASSES + column
        marks[step] = out[at]
        state = to[at].astype(np.intp)
    marks = marks.T.reshape(-1)[: len(kinds)]
    starts = (marks & HERE) > 0
    starts[:-1] |= (marks[1:] & BEFORE) > 0
    return starts


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, as code points from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + n): b for n, b in enumerate(others)}}


class Counter:
    """The transducer from the bytes of a piece to its number of tokens, compiled as it is needed."""

    def __init__(self, tokens: dict[bytes, int], ranks: dict[tuple[bytes, bytes], int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.splits: dict[bytes, tuple[bytes, bytes, int] | None] = {}
        self.children: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for token in tokens:
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token.append(None)
                node = self.children[node][byte]
            self.token[node] = token
        self._forget()

    def _forget(self) -> None:
        self.states = [((0, b"", 0),)]
        self.number = {self.states[0]: 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]
        self.follows: dict[tuple[bytes, bytes], bool] = {}

    def derived(self, token: bytes) -> tuple[bytes, bytes, int] | None:
        """The last merge that makes a token of its bytes; None for a byte, and for what its bytes are not merged into."""
        if token not in self.splits:
            halves = [(token[:n], token[n:]) for n in range(1, len(token))]
            ranked = sorted((self.ranks[pair], pair) for pair in halves if pair in self.ranks)
            # Several merges can make the same token: the one whose halves come about and stand side by side.
            self.splits[token] = next(((*pair, rank) for rank, pair in ranked if self._meet(*pair, rank)), None)
        return self.splits[token]

    def _spine(self, token: bytes, side: int) -> list[tuple[bytes, float]] | None:
        """What stands at one end of a token while it is merged, from a byte to the token, each with the rank of the merge that ends it."""
        spine, ends = [], math.inf
        while True:
            spine.append((token, ends))
            if len(token) == 1:
                return spine[::-1]
            split = self.derived(token)
            if split is None:
                return None
            token, ends = split[side], split[2]

    def _meet(self, last: bytes, token: bytes, until: float = math.inf) -> bool:
        """Whether no merge before rank ``until`` crosses from ``last`` to ``token``, which both come about.

        A pair at the border is merged if its rank comes before the merges that end its two sides; of equal ranks the leftmost goes first.
        """
        left, right = self._spine(last, 1), self._spine(token, 0)
        if left is None or right is None:
            return False
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = left[i], right[j]
            rank = self.ranks.get((x, y))
            if rank is not None and rank < min(x_ends, until) and rank <= y_ends:
                return False
            if i == len(left) - 1 and j == len(right) - 1:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def may_follow(self, last: bytes, token: bytes) -> bool:
        """Whether ``token`` can come after ``last`` (empty: at the start): merging their bytes gives just the two."""
        key = (last, token)
        if key not in self.follows:
            self.follows[key] = self._meet(last, token) if last else self._spine(token, 0) is not None
        return self.follows[key]

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        """The transition from a state by a byte: the state after it and the change of the count."""
        alive, last, change = [], None, 0
        for node, before, behind in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            alive.append((child, before, behind))
            token = self.token[child]
            if last is None and token is not None and self.may_follow(before, token):
                last, change = token, behind + 1
        after = (*[(node, before, behind - change) for node, before, behind in alive if self.children[node]], (0, last, 0))
        if after not in self.number:
            self.number[after] = len(self.states)
            self.states.append(after)
            self.moves.append({})
        self.moves[state][byte] = (self.number[after], change)
        return self.moves[state][byte]

    def count(self, piece: bytes) -> int:
        """The number of tokens of a piece."""
        state = total = 0
        for byte in piece:
            move = self.moves[state].get(byte)
            if move is None:
                if len(self.states) > self.max_states:
                    kept = self.states[state]
                    self._forget()
                    state = self.number.setdefault(kept, len(self.states))
                    if state == len(self.states):
                        self.states.append(kept)
                        self.moves.append({})
                move = self._compile(state, byte)
            state, change = move
            total += change
        return total


class TokenCounter:
    """Counts the tokens of texts; compiled from the content of a ``tokenizers`` file with a byte-level BPE."""

    def __init__(self, definition: bytes, max_states: int = MAX_STATES, max_pieces: int = MAX_PIECES):
        spec = json.loads(definition)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        plain = all(not model.get(key) for key in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        added = spec.get("added_tokens") or []
        exact = not any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added)
        if model.get("type") not in (None, "BPE") or spec.get("normalizer") or not (plain and byte_level and exact):
            raise ValueError("only plain byte-level BPE without a normalizer can be compiled")
        of = _byte_of_symbol()

        def raw(symbols: str) -> bytes:
            return bytes(of[s] for s in symbols)

        special = {t["content"] for t in added}
        tokens = {raw(s): n for s, n in model["vocab"].items() if s not in special}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.counter = Counter(tokens, {(raw(a), raw(b)): n for n, (a, b) in enumerate(pairs)}, max_states)
        contents = sorted((s.encode() for s in special if s), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, contents))) if contents else None
        self.known: dict[bytes, int] = {}
        self.max_pieces = max_pieces

    def _counts(self, pieces: list[bytes]) -> np.ndarray:
        counts = list(map(self.known.get, pieces))
        if None in counts:
            for n, piece in enumerate(pieces):
                if counts[n] is None:
                    counts[n] = self.known.get(piece)
                    if counts[n] is None:
                        counts[n] = self.counter.count(piece)
                        if len(piece) <= LONG_PIECE:
                            if len(self.known) >= self.max_pieces:
                                self.known.clear()
                            self.known[piece] = counts[n]
        return np.array(counts, np.int64)

    def count(self, texts: list[bytes | None]) -> np.ndarray:
        """The number of tokens of each text (UTF-8)."""
        texts = [t or b"" for t in texts]
        ends = np.cumsum([len(t) + 1 for t in texts])  # a separator after each text
        joined = b"\0".join([*texts, b""])
        data = np.frombuffer(joined, np.uint8)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        kinds = classes()[np.frombuffer(joined.decode().encode("utf-32-le"), np.uint32)]
        kinds[np.searchsorted(lead, ends - 1)] = END
        total = np.zeros(len(texts), np.int64)
        if self.special:
            for n, text in enumerate(texts):
                for hit in self.special.finditer(text):
                    begin = int(ends[n]) - 1 - len(text)
                    kinds[slice(*np.searchsorted(lead, [begin + hit.start(), begin + hit.end()]))] = END
                    total[n] += 1
        places = np.flatnonzero(piece_starts(kinds))
        begins = lead[places]
        stops = np.append(begins[1:], len(data))
        real = kinds[places] != END
        begins, stops = begins[real], stops[real]
        counts = self._counts([joined[a:b] for a, b in zip(begins.tolist(), stops.tolist())])
        running = np.concatenate([[0], np.cumsum(counts)])
        upto = running[np.searchsorted(begins, ends)]
        return total + np.diff(upto, prepend=0)


_compiled: dict[int, tuple[bytes, TokenCounter]] = {}


def compiled(definition: bytes) -> TokenCounter:
    """One counter a worker process, kept from task to task."""
    key = hash(definition)
    if key not in _compiled or _compiled[key][0] != definition:
        _compiled.clear()
        _compiled[key] = (definition, TokenCounter(definition))
    return _compiled[key][1]


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, text_column: str = "text", prefix: str = "") -> DataFrame:
    """The rows with the bytes and tokens of their text and whether the tokens exceed ``limit``.

    ``tokenizer`` is the path of the vocabulary file on the driver.
    """
    definition = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())
    out = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType()}
    out = {f"{prefix}{name}": kind for name, kind in out.items()}
    kept = docs.drop(*[c for c in out if c != text_column])
    names = [c for c in kept.columns if c not in out]
    schema = T.StructType([*[kept.schema[c] for c in names], *[T.StructField(n, k) for n, k in out.items()]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = compiled(definition.value)
        for batch in sliced(batches, text_column):
            column = batch.column(text_column)
            n_tokens = counter.count(column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist())
            n_bytes = np.diff(flat(column)[1])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(n_bytes, pa.int64()), pa.array(n_tokens), pa.array(n_tokens > limit)],
                names=[*names, *out],
            )

    return kept.mapInArrow(count, schema)
