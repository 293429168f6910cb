"""Chat formatting with a grammar round trip.

A turn is rendered as a header line, the text and an end line::

    ### Assistant:
    text
    </turn>

The grammar is regular: an unescaped header begins a turn, an unescaped end mark ends it, and a mark
is escaped by a backslash more than it has in the text. Text is first rendered as it is and parsed
again; if the turn that comes back differs, the text is escaped and parsed once more, which always
gives the source. Turns are delimited by themselves, so each is checked alone, and a conversation of
any length is worked on turn by turn.
"""

from __future__ import annotations

import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import rows_of

LABELS = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
_ROLES = {label: role for role, label in LABELS.items()}
END = "\n</turn>\n"
_MARK = re.compile(r"(?<!\\)\\*(?:###|</turn>)")
_ESCAPED = re.compile(r"(?<!\\)\\+(?:###|</turn>)")
#: A header: a label, or another role as a JSON string.
_HEADER = re.compile(r'### (?:([A-Z][a-z]+)|role ("(?:[^"\\]|\\.)*")):\n')


def escape(text: str) -> str:
    return _MARK.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[1:], text)


def _header(role: str) -> str:
    return f"### {LABELS[role]}:\n" if role in LABELS else f"### role {json.dumps(role)}:\n"


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """Roles and texts of a formatted conversation; None if it doesn't follow the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        begin = _header_at(formatted, at)
        if begin is None:
            return None
        role, at = begin
        end = _next_mark(formatted, at)
        # The end mark stands on a line of its own.
        if end is None or not formatted.startswith(END, end - 1):
            return None
        if end - 1 < at:
            return None
        turns.append((role, unescape(formatted[at : end - 1])))
        at = end - 1 + len(END)
    return turns


def _header_at(formatted: str, at: int) -> tuple[str, int] | None:
    found = _HEADER.match(formatted, at)
    if not found:
        return None
    label, other = found.groups()
    if label is not None and label not in _ROLES:
        return None
    return (_ROLES[label] if label is not None else json.loads(other)), found.end()


def _next_mark(formatted: str, at: int) -> int | None:
    """Place of the next mark that is not escaped."""
    for found in _MARK.finditer(formatted, at):
        if found.group()[0] != "\\":
            return found.start()
    return None


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends in it."""
    header = _header(role)
    for body in (text, escape(text)):
        formatted = header + body + END
        if parse(formatted) == [(role, text)]:
            return formatted, len(header), len(header) + len(body)
    raise AssertionError("escaped text does not come back")


def _turns(batches):
    schema = pa.schema([("formatted", pa.string()), ("text_start", pa.int64()), ("text_end", pa.int64()), ("loss", pa.bool_())])
    for batch in batches:
        columns = ([], [], [], [])
        for role, text in rows_of([batch], "role", "text"):
            role = role.decode() if role is not None else ""
            for column, value in zip(columns, (*render_turn(role, text.decode() if text else ""), role == "assistant"), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(c, f.type) for c, f in zip(columns, schema, strict=True))], schema=pa.schema([*batch.schema, *schema])
        )


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each turn with ``formatted``, the range ``text_start``-``text_end`` of its text in it, and ``loss``.

    The formatted turns of a conversation, in the order of ``turn``, make the formatted conversation; ``loss``
    marks the turns whose range is under the loss mask (those of the assistant). Input columns are ``conv_id``,
    ``turn``, ``role`` and ``text``, others are ignored; null roles and texts count as empty.
    """
    rows = conversations.select("conv_id", "turn", "role", "text")
    types = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(_turns, f"{types}, formatted string, text_start bigint, text_end bigint, loss boolean")


_DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.sha, self.loss_sha = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int, loss: bool) -> None:
        for role, text in parse(formatted):
            self.turns += 1
            self.sha.update(f"{role}\n{text}\n".encode())
        self.chars += len(formatted)
        if loss:
            text = unescape(formatted[start:end])
            self.loss_chars += len(text)
            self.loss_sha.update(text.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.sha.hexdigest(), "loss_chars": self.loss_chars,
            "loss_sha256": self.loss_sha.hexdigest(), "formatted_chars": self.chars,
        }


def _digest(batches):
    """One row per conversation from its formatted turns, which come one after another."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )
    current, done = None, []
    for conv_id, formatted, start, end, loss in rows_of(batches, "conv_id", "formatted", "text_start", "text_end", "loss"):
        if current is None or current.conv_id != conv_id:
            if current is not None:
                done.append(current.row())
            current = _Digest(conv_id)
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        current.add(formatted.decode(), start, end, loss)
    if current is not None:
        yield pa.RecordBatch.from_pylist([*done, current.row()], schema)


def conversation_digests(turns: DataFrame) -> DataFrame:
    """What the formatted turns say, read back by the parser: one row per conversation.

    Columns: ``conv_id``, ``n_turns``, ``turns_sha256`` (role, line feed, text, line feed per turn), ``loss_chars``
    and ``loss_sha256`` (all text under the loss mask, unescaped) and ``formatted_chars``. Turns come in the
    order of ``turn``, nulls first, equal ones in that of role and text. Rows without a ``conv_id`` are one
    conversation. Turns are streamed: a conversation with very many of them needs no more memory than one.
    """
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text", "formatted", "text_start", "text_end", "loss")
    sorted_rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_rows.select("conv_id", "formatted", "text_start", "text_end", "loss").mapInArrow(_digest, _DIGESTS)
