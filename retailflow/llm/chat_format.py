"""Conversations as training text: a template marks the turns, a state machine checks their order.

The template is data: an opening and a closing string per role and whether the role's texts are learned.  The machine
is data too: a table of (state, role) to state, with one absorbing state for everything else.  Formatting gives one row
per segment of text (opening, text, closing) with its loss flag, never a whole conversation in one value; reading back
takes the segments' text alone and finds turns, roles and texts by the template's strings.

Control strings inside a text are broken up by an escape character after their first character, at every place where
one starts, and an escape character is doubled; so no control string lies in an escaped text, and a reader undoes it.
The template refuses strings with which text and marker together could make a control string.

Rows are dealt by conversation and sorted by turn, and each task streams over them with a state of constant size, so a
conversation of any length needs no more memory than its longest turn.  Its digest must see its turns in order, so one
conversation is one task's work.

Defined results: a null text is empty; a null role is the role of an empty name; a role without markers of its own is
marked by its name; turns are ordered by turn number (null first), then role and text; each row without a conversation
id is a conversation of its own with a null id; an empty table gives no rows; other columns are ignored.  A wrong order
of turns is formatted like any other and told by ``valid`` (no turn was out of order) and ``complete`` (valid, and the
last turn is one the machine may end in).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"
BROKEN = "broken"


@dataclass(frozen=True)
class Turn:
    """Markers of one role."""

    opening: str
    closing: str
    learned: bool = False


@dataclass(frozen=True)
class Template:
    """Markers by role, markers for any other role, and the order of roles."""

    roles: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("[SYS]", "[/SYS]"), "user": Turn("[INST]", "[/INST]"), "assistant": Turn("<s>", "</s>", True)})
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    ends: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self) -> None:
        heads = {c[:1] for c in self.controls}
        if len(self.openings) < len(self.roles) + 1:
            raise ValueError("two roles open alike")
        for c in self.controls:
            # A control string that starts inside another, or across a text and a marker, could not be told apart.
            if len(c) < 2 or ESCAPE in c or any(ch in heads for ch in c[1:]) or c[-1] in heads:
                raise ValueError(f"marker {c!r} cannot be told from its surroundings")

    @property
    def controls(self) -> list[str]:
        return sorted({m for t in self.roles.values() for m in (t.opening, t.closing)} | set(self.other))

    @property
    def openings(self) -> dict[str, str | None]:
        return {**{t.opening: role for role, t in self.roles.items()}, self.other[0]: None}

    def next_state(self, state: str, role: str) -> str:
        return self.moves.get((state, role), BROKEN)


class Escaper:
    def __init__(self, controls: list[str]):
        self.starts = re.compile("(?=" + "|".join(map(re.escape, controls)) + ")(.)", re.DOTALL)
        self.marks = re.compile(re.escape(ESCAPE) + r"(.)", re.DOTALL)

    def escape(self, text: str) -> str:
        return self.starts.sub(lambda m: m[1] + ESCAPE, text.replace(ESCAPE, ESCAPE + ESCAPE))

    def unescape(self, text: str) -> str:
        return self.marks.sub(r"\1", text)


def _sent(rows: Iterable[tuple], schema: pa.Schema, most_rows: int = 5_000, most_chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded rows and text."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most_rows or size >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*held)), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(map(list, zip(*held)), schema)], schema=schema)


def _by_conversation(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Dealt by conversation, rows without one spread out; each conversation in order and in one piece."""
    key = F.coalesce(F.col("conv_id"), F.xxhash64(*[c for c in rows.columns if c != "conv_id"]))
    return rows.repartition(key).sortWithinPartitions("conv_id", *order)


SEGMENTS = "conversation string, conv_id long, turn_index long, segment long, text string, loss boolean, state string"


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """``conversation, conv_id, turn_index, segment, text, loss, state``, one row per segment, numbered from 0.

    ``conversation`` is the id as text, or a name of its own for each row without one; ``state`` is that after the turn.
    """
    schema = pa.schema([("conversation", pa.string()), ("conv_id", pa.int64()), ("turn_index", pa.int64()), ("segment", pa.int64()), ("text", pa.string()),
                        ("loss", pa.bool_()), ("state", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escaper = Escaper(template.controls)
        task = TaskContext.get().partitionId()

        def segments():
            conv, state, turn, segment, begun = None, template.start, 0, 0, False
            name, nameless = "", 0
            for part in parts:
                for this, role, text in zip(part.column(0).to_pylist(), part.column(2), part.column(3)):
                    if this is None or this != conv or not begun:
                        conv, state, turn, segment, begun = this, template.start, 0, 0, True
                        name, nameless = (f"~{task}-{nameless}", nameless + 1) if this is None else (str(this), nameless)
                    role, text = role.as_py() or "", text.as_py() or ""
                    state = template.next_state(state, role)
                    known = template.roles.get(role)
                    if known is not None:
                        pieces = [(known.opening, False), (escaper.escape(text), known.learned), (known.closing, False)]
                    else:
                        opening, between, closing = template.other
                        pieces = [(f"{opening}{escaper.escape(role)}{between}", False), (escaper.escape(text), False), (closing, False)]
                    for piece, loss in pieces:
                        yield name, this, turn, segment, piece, loss, state
                        segment += 1
                    turn += 1

        yield from _sent(segments(), schema)

    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return _by_conversation(turns, ["turn", "role", "text"]).mapInArrow(run, SEGMENTS)


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long,"
        " valid boolean, complete boolean")


class _Reader:
    """One conversation read from its formatted text, piece by piece; what is held is the turn that is being read."""

    def __init__(self, conv_id: int | None, template: Template, escaper: Escaper, token: re.Pattern):
        self.conv_id = conv_id
        self.template, self.escaper, self.token = template, escaper, token
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.chars = self.loss_chars = 0
        self.state = template.start
        self.role: str | None = None
        self.open: str | None = None  # the marker last read inside a turn
        self.text: list[str] = []

    def feed(self, piece: str, loss: bool) -> None:
        self.chars += len(piece)
        if loss:
            # Segments end where texts do, so an escape is never cut.
            plain = self.escaper.unescape(piece)
            self.loss_chars += len(plain)
            self.learned.update(plain.encode())
        at = 0
        for mark in self.token.finditer(piece):
            self.text.append(piece[at:mark.start()])
            self._marker(mark[0])
            at = mark.end()
        self.text.append(piece[at:])

    def _marker(self, mark: str) -> None:
        held = self.escaper.unescape("".join(self.text))
        self.text = []
        opening, between, closing = self.template.other
        if self.open is None:
            if held or mark not in self.template.openings:
                raise ValueError("formatted text does not follow its template")
            self.role, self.open = self.template.openings[mark], mark
        elif mark == between and self.open == opening:
            self.role, self.open = held, mark
        elif mark == (closing if self.open == between else self.template.roles[self.role].closing):
            self.state = self.template.next_state(self.state, self.role)
            self.turns.update(f"{self.role}\n{held}\n".encode())
            self.n_turns += 1
            self.role = self.open = None
        else:
            raise ValueError("formatted text does not follow its template")

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars,
                self.state != BROKEN, self.state in self.template.ends)


def read_back(segments: DataFrame, template: Template = Template(), in_order: bool = False) -> DataFrame:
    """Per conversation what its formatted text says: turns, learned text, length, and whether the order holds.

    ``in_order``: the frame comes straight from `format_conversations`, whose rows lie in order already; segments read
    from a table are dealt and sorted anew.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("complete", pa.bool_())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        escaper = Escaper(template.controls)
        token = re.compile("|".join(map(re.escape, template.controls)))

        def conversations():
            conv, reader = None, None
            for part in parts:
                ids = part.column(1).to_pylist()
                for this, conv_id, text, loss in zip(part.column(0).to_pylist(), ids, part.column(2), part.column(3).to_pylist()):
                    if reader is None or this != conv:
                        if reader is not None:
                            yield reader.row()
                        conv, reader = this, _Reader(conv_id, template, escaper, token)
                    reader.feed(text.as_py(), loss)
            if reader is not None:
                yield reader.row()

        yield from _sent(conversations(), schema)

    if not in_order:
        segments = segments.repartition("conversation").sortWithinPartitions("conversation", "segment")
    return segments.select("conversation", "conv_id", "text", "loss").mapInArrow(run, READ)
