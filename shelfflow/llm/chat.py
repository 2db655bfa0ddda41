"""Chat formatting by schema fingerprinting.

Conversations come in many layouts: lists of messages under various names, prompt and response, instruction and
input, one row per turn. The layout of a record is told by its fingerprint, a hash of its nested field paths
and their kinds. ``LAYOUTS`` declares for each known layout where roles and texts are found; the
fingerprint selects the mapping, and the mapping alone turns the record into canonical turns.

Each turn is written as ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed. Within roles and texts every ``<|`` gets a
backslash after the ``<``, and one more if there are some already, so no control string can appear there and the text
can be read back exactly. In roles, backslashes and line feeds are written as ``\\\\`` and ``\\n`` first. The loss mask covers
the texts of assistant turns.

Turns of a conversation meet in one task in order, row after row: a conversation of any length is digested as a
stream, since its hashes are sequential, and no group is held in memory.

Defined cases: a NULL text or role is empty, turns without a number come first. Turns with the same number follow by role, then
text; repeated rows are repeated turns. A NULL conversation id is a conversation like any other. A record of an unknown layout, or
that is no JSON object, has no turns and is returned by ``unmapped``. Other columns are dropped. Empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def field_paths(value: object, path: str = "$") -> set[str]:
    """The paths of all fields with the kind of what they hold; elements of a list share one path."""
    if isinstance(value, dict):
        found = {f"{path}:object"}
        for name, inner in value.items():
            found |= field_paths(inner, f"{path}.{name}")
        return found
    if isinstance(value, list):
        found = {f"{path}:list"}
        for inner in value:
            found |= field_paths(inner, f"{path}[]")
        return found
    return {f"{path}:value"}


def fingerprint(paths: set[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(sorted(paths)).encode())


@dataclass(frozen=True)
class Layout:
    """Where a layout has its turns: in a list of messages, or in fields that each hold one turn."""

    paths: tuple[str, ...]
    messages: str = ""
    role: str = ""
    text: str = ""
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    @property
    def key(self) -> int:
        return fingerprint(set(self.paths))

    def read(self, record: dict) -> list[tuple[str, str]]:
        if self.turns:
            parts = ((role, [_text(record.get(name)) for name in names]) for role, names in self.turns)
            return [(role, "\n\n".join(p for p in texts if p) or texts[0]) for role, texts in parts]
        listed = record.get(self.messages) if self.messages else [record]
        found = ((_text(m.get(self.role)), _text(m.get(self.text))) for m in listed or [])
        return [(self.roles.get(role, role), text) for role, text in found]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _listed(name: str, role: str, text: str, **roles: str) -> Layout:
    paths = ("$:object", f"$.{name}:list", f"$.{name}[]:object", f"$.{name}[].{role}:value", f"$.{name}[].{text}:value")
    return Layout(paths, messages=name, role=role, text=text, roles=roles)


def _flat(*turns: tuple[str, tuple[str, ...]]) -> Layout:
    names = [n for _, fields in turns for n in fields]
    return Layout(("$:object", *(f"$.{n}:value" for n in names)), turns=turns)


# The field and role names of common public layouts.
DECLARED = [
    Layout(("$:object", "$.role:value", "$.text:value"), role="role", text="text"),
    _listed("messages", "role", "content"),
    _listed("messages", "role", "text"),
    _listed("conversation", "role", "content"),
    _listed("conversations", "from", "value", human="user", gpt="assistant"),
    _flat(("user", ("prompt",)), ("assistant", ("completion",))),
    _flat(("user", ("prompt",)), ("assistant", ("response",))),
    _flat(("user", ("question",)), ("assistant", ("answer",))),
    _flat(("user", ("instruction",)), ("assistant", ("output",))),
    _flat(("user", ("instruction", "input")), ("assistant", ("output",))),
    _flat(("user", ("instruction", "context")), ("assistant", ("response",))),
    _flat(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
]
LAYOUTS = {layout.key: layout for layout in DECLARED}


def canonical(record: str | None) -> list[tuple[str, str]] | None:
    """The turns of one JSON record, or None if its layout is unknown."""
    try:
        value = json.loads(record or "")
    except ValueError:
        return None
    layout = LAYOUTS.get(fingerprint(field_paths(value))) if isinstance(value, dict) else None
    return None if layout is None else layout.read(value)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def write_turn(role: str, text: str) -> str:
    role = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
    return f"{START}{role}\n{escape(text)}{END}\n"


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a written turn."""
    role, _, rest = segment[len(START) :].partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))
    return role, unescape(rest[: -len(END) - 1])


def format_turns(records: DataFrame, id_column: str, record_column: str, order_column: str | None = None) -> DataFrame:
    """A row per turn: ``conversation``, ``turn`` (its place), ``segment``, ``loss_start`` and ``loss_end`` in it, ``role``, ``text``.

    With an ``order_column``, records of one conversation are ordered by it, at a tie by the turns in them (``tie``).
    """
    order = F.col(order_column).cast("long") if order_column else F.lit(0).cast("long")
    rows = records.select(F.col(id_column).alias("conversation"), order.alias("record_order"), F.col(record_column).alias("record"))
    kind = rows.schema["conversation"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ties, turn, segments, starts, ends, roles, texts = ([] for _ in range(8))
            for n, record in enumerate(batch.column("record").to_pylist()):
                turns = canonical(record) or []
                tie = "\0".join(part for pair in turns for part in pair)
                for place, (role, text) in enumerate(turns):
                    ties.append(tie)
                    segment = write_turn(role, text)
                    begin = segment.index("\n") + 1
                    end = len(segment) - len(END) - 1
                    at.append(n)
                    turn.append(place)
                    segments.append(segment)
                    starts.append(begin if role == "assistant" else 0)
                    ends.append(end if role == "assistant" else 0)
                    roles.append(role)
                    texts.append(text)
            rows_at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conversation").take(rows_at),
                    batch.column("record_order").take(rows_at),
                    pa.array(ties, pa.string()),
                    pa.array(turn, pa.int64()),
                    pa.array(segments, pa.string()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends, pa.int64()),
                    pa.array(roles, pa.string()),
                    pa.array(texts, pa.string()),
                ],
                names=["conversation", "record_order", "tie", "turn", "segment", "loss_start", "loss_end", "role", "text"],
            )

    columns = "tie string, turn long, segment string, loss_start long, loss_end long, role string, text string"
    return rows.mapInArrow(write, f"conversation {kind}, record_order long, {columns}")


def unmapped(records: DataFrame, record_column: str) -> DataFrame:
    """The records whose layout is not declared."""
    names = records.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unknown = [canonical(r) is None for r in batch.column(record_column).to_pylist()]
            yield batch.select(names).filter(pa.array(unknown, pa.bool_()))

    return records.mapInArrow(keep, records.schema)


class _Digest:
    """What is read back from one conversation's segments."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, loss_start: int, loss_end: int) -> None:
        role, text = read_turn(segment)
        self.turns += 1
        self.turns_hash.update(f"{role}\n{text}\n".encode())
        if loss_end > loss_start:
            learned = unescape(segment[loss_start:loss_end])
            self.loss_chars += len(learned)
            self.loss_hash.update(learned.encode())
        self.chars += len(segment)

    def row(self) -> tuple:
        return self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars


DIGEST = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digest(turns: DataFrame) -> DataFrame:
    """Per conversation, digests of what its formatted text and loss mask say, read back turn by turn."""
    kind = turns.schema["conversation"].dataType
    key = ["conversation", "record_order", "tie", "turn"]
    ordered = turns.repartition("conversation").sortWithinPartitions(*key)
    ordered = ordered.select("conversation", "segment", "loss_start", "loss_end")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running = None, None
        arrow = None

        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], arrow), *[pa.array(c) for c in columns[1:]]], names=["conversation", *names]
            )

        for batch in batches:
            arrow = batch.column("conversation").type
            done = []
            for conversation, *segment in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if running is None or conversation != now:
                    if running is not None:
                        done.append((now, *running.row()))
                    now, running = conversation, _Digest()
                running.add(*segment)
            if done:
                yield rows(done)
        if running is not None:
            yield rows([(now, *running.row())])

    return ordered.mapInArrow(stream, f"conversation {kind.simpleString()}, {DIGEST}")
