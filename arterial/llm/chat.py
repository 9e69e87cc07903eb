"""Chat formatting with a grammar round trip.

``<|im_start|>role\\n text <|im_end|>\\n`` per turn. Every turn is rendered, parsed again by a deterministic parser, and compared
with the source; a turn that comes back different is escaped and must then come back identical. Escaping puts one backslash
more into anything that looks like ``<|``, ``<\\|``, ``<\\\\|`` ..., so it is reversible, no escaped text holds a marker, and one
round of it is always enough. Roles are always escaped and the end marker cannot overlap itself, so a conversation comes back
if each of its turns does.

Turns pass one after the other in sorted partitions, through running digests and counters. A task holds one batch of turns and
one piece of formatted text, however long a conversation is.

Defined cases: a null text or role is empty; turns without a number come first; equal turn numbers (repeated rows) are
ordered by role and text; line breaks and backslashes in roles are escaped; an empty table gives no conversations; rows
without conversation id form one conversation. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
PIECE_CHARS = 4 << 20  # a piece of formatted text takes no further turn once it is as long
FIELDS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, "
    "n_escaped int, formatted string, loss_spans array<bigint>, piece int"
)
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
_SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in (f.split() for f in FIELDS.split(", "))])
_LOOKS_LIKE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _LOOKS_LIKE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
    """The formatted conversation and the flat start and end places of the texts under the loss mask."""
    out, at, spans = [], 0, []
    for role, body in turns:
        head = f"{START}{role}\n"
        if role == LOSS_ROLE:
            spans += [at + len(head), at + len(head) + len(body)]
        out.append(f"{head}{body}{END}\n")
        at += len(out[-1])
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """The turns of a formatted conversation, unescaped; None if it does not follow the grammar.

    Deterministic: a turn's head ends at the first line break, its text at the first end marker. Neither marker can stand in
    a text.
    """
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            return None
        line = formatted.find("\n", at)
        end = formatted.find(END, line)
        if line < 0 or end < 0 or not formatted.startswith("\n", end + len(END)):
            return None
        if START in formatted[line + 1 : end]:  # a reader of tokens would begin a turn there
            return None
        turns.append((unescape_role(formatted[at + len(START) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END) + 1
    return turns


def ready(role: str, body: str) -> tuple[str, str, bool]:
    """Role and text of a turn as they are rendered, and whether the text had to be escaped to come back."""
    inside = escape_role(role)
    if parse(render([(inside, body)])[0]) == [(role, body)]:
        return inside, body, False
    return inside, escape(body), True


def round_trip(turns: list[tuple[str, str]]) -> tuple[str, list[int], int]:
    """The formatted conversation, its spans under the loss mask, and the number of escaped turns."""
    done = [ready(*t) for t in turns]
    formatted, spans = render([t[:2] for t in done])
    return formatted, spans, sum(t[2] for t in done)


class _Conversation:
    """Counters and digests of what a reader gets back from a conversation, and the piece of it that is being built."""

    def __init__(self, conv: int | None):
        self.conv, self.piece, self.n_turns, self.n_escaped, self.chars, self.loss_chars = conv, 0, 0, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.parts: list[str] = []
        self.spans: list[int] = []
        self.held = 0

    def add(self, role: str, body: str) -> None:
        role_out, body_out, escaped = ready(role, body)
        formatted, spans = render([(role_out, body_out)])
        back = parse(formatted)
        if back != [(role, body)]:
            raise ValueError(f"turn {self.n_turns} of conversation {self.conv} does not come back")
        self.turns.update(f"{back[0][0]}\n{back[0][1]}\n".encode())
        if spans:
            loss = unescape(formatted[spans[0] : spans[1]])
            self.loss.update(loss.encode())
            self.loss_chars += len(loss)
        self.spans += [self.chars + at for at in spans]
        self.parts.append(formatted)
        self.held += len(formatted)
        self.chars += len(formatted)
        self.n_turns += 1
        self.n_escaped += escaped

    def take(self, last: bool) -> tuple:
        """The piece built so far as a row; the last one holds counts and digests."""
        counts = (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.n_escaped)
        row = (self.conv, *(counts if last else [None] * len(counts)), "".join(self.parts), self.spans, self.piece)
        self.parts, self.spans, self.held, self.piece = [], [], 0, self.piece + 1
        return row


def _record(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types)], schema=_SCHEMA)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations come one after the other, with their turns in order; batches may end anywhere."""
    now, rows, held = None, [], 0
    for batch in batches:
        for at in range(batch.num_rows):
            conv, role, body = (batch.column(k)[at].as_py() for k in range(3))
            if now is not None and (now.conv != conv or now.held >= PIECE_CHARS):
                held += now.held
                rows.append(now.take(last=now.conv != conv))
                if held >= PIECE_CHARS:
                    yield _record(rows)
                    rows, held = [], 0
            if now is None or now.conv != conv:
                now = _Conversation(conv)
            now.add(role, body)
    if now is not None:
        rows.append(now.take(last=True))
        yield _record(rows)


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): the formatted string, the spans under the loss
    mask, and counts and digests of what a reader gets back from it.

    A conversation of more than ``PIECE_CHARS`` comes in several rows, one per ``piece`` of whole turns: joined in the order
    of ``piece`` they are the formatted string, spans are places in all of it, and only the last row has n_turns and the
    other counts and digests. Turns meet in one shuffle by conversation, never more; a conversation is read by one task,
    since its digests need its turns in order, but never held by it.
    """
    turns = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    placed = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return placed.select("conv_id", "role", "text").mapInArrow(_format, FIELDS)
