"""Chat formatting with a grammar round trip.

    turn := <s>[INST] text [/INST]</s>        user
          | <s>text</s>                       assistant
          | <s>[ROLE]role[/ROLE]text</s>      any other role

Neither role nor text may hold a control string: the parser refuses one. Each
turn is rendered as it is and parsed back. If it is refused, or role or text
come back different, the turn is rendered again with its control strings escaped
(one backslash more after the first character, so any number of backslashes
stays reversible), and parsed again until identical. The parser always takes one
backslash off; text that only looks escaped therefore fails the first round
trip and is escaped in turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_ESCAPED = re.compile(r"(<(?=\\+/?s>)|\[(?=\\+/?(?:INST|ROLE)\]))\\")
_CONTROL = re.compile(r"</?s>|\[/?(?:INST|ROLE)\]")
_OPENING = max(map(len, ("<s>[INST] ", "<s>[ROLE]")))
_PLAIN = re.compile(r"(<(?=\\*/?s>)|\[(?=\\*/?(?:INST|ROLE)\]))")


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> str:
    if role == "user":
        return f"<s>[INST] {text} [/INST]</s>"
    if role == "assistant":
        return f"<s>{text}</s>"
    return f"<s>[ROLE]{role}[/ROLE]{text}</s>"


class Unfinished(ValueError):
    """The text ends within a turn."""


def parse(formatted: str, at: int = 0) -> tuple[str, str, int]:
    """Role, text and end of the turn that begins at ``at``; ValueError if none does
    or a control string is in it, :class:`Unfinished` if the text ends first."""

    def upto(mark: str, start: int) -> tuple[str, int]:
        end = formatted.find(mark, start)
        if end < 0:
            raise Unfinished(f"no {mark} follows")
        if _CONTROL.search(formatted, start, end):
            raise ValueError("a control string inside a turn")
        return unescape(formatted[start:end]), end + len(mark)

    if not formatted.startswith("<s>", at):
        raise ValueError("no turn begins here")
    at += 3
    if formatted.startswith("[INST] ", at):
        return "user", *upto(" [/INST]</s>", at + 7)
    if formatted.startswith("[ROLE]", at):
        role, at = upto("[/ROLE]", at + 6)
        return role, *upto("</s>", at)
    return "assistant", *upto("</s>", at)


def _comes_back(segment: str, role: str, text: str) -> bool:
    try:
        return parse(segment) == (role, text, len(segment))
    except ValueError:
        return False


def format_turn(role: str, text: str) -> str:
    segment = render(role, text)
    if not _comes_back(segment, role, text):
        special = role in ("user", "assistant")
        segment = render(role if special else escape(role), escape(text))
        if not _comes_back(segment, role, text):
            raise AssertionError("an escaped turn must come back")
    return segment


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    conv_id, held = None, ""
    for batch in batches:
        ids, made = [], []

        def put(text: str, ids=ids, made=made) -> None:
            ids.append(conv_id)
            made.append(text)

        for own, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if own != conv_id and held:
                put(held)
                held = ""
            conv_id = own
            held += format_turn(role or "", text or "")
            for a in range(0, len(held) - size, size):
                put(held[a : a + size])
            held = held[(len(held) - 1) // size * size :]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(made, pa.string())], names=["conv_id", "segment"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([conv_id], pa.int64()), pa.array([held])], names=["conv_id", "segment"])


def segments(turns: DataFrame, size: int = 1 << 16) -> DataFrame:
    """conv_id and segment: the formatted text of each conversation, in segments of
    ``size`` characters that end wherever they do. Conversations are whole within
    partitions and ordered by turn, then role and text (nulls first); a task
    holds a segment and a turn at a time. Null role or text count as empty;
    repeated rows are turns of their own, a null conv_id is a conversation too.
    Other columns do not matter; an empty table gives no segment.
    """
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _segments(batches, size)

    return ordered.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, segment string")


class _Reader:
    """Digests of one conversation, parsed from its text as that arrives. Nothing but the grammar says where a turn ends."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.n, self.chars, self.loss = conv_id, 0, 0, 0
        self.turns, self.assistant = hashlib.sha256(), hashlib.sha256()
        self.held: list[str] = []

    def read(self, formatted: str) -> None:
        self.chars += len(formatted)
        end = self.held[-1][-3:] if self.held else ""
        self.held.append(formatted)
        if "</s>" in end + formatted:  # else no turn ends here
            self._parse()

    def _parse(self) -> None:
        text, at = "".join(self.held), 0
        try:
            while len(text) - at >= _OPENING:
                role, said, at = parse(text, at)
                self._turn(role, said)
        except Unfinished:
            pass
        self.held = [text[at:]] if at < len(text) else []

    def _turn(self, role: str, text: str) -> None:
        self.n += 1
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if role == "assistant":
            self.loss += len(text)
            self.assistant.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        rest, at = "".join(self.held), 0
        while at < len(rest):
            role, text, at = parse(rest, at)
            self._turn(role, text)
        return self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.assistant.hexdigest(), self.chars


_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _DIGEST, strict=True)], schema=_DIGEST)

    reader = None
    for batch in batches:
        rows = []
        for conv_id, segment in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if reader is None or reader.conv_id != conv_id:
                if reader is not None:
                    rows.append(reader.row())
                reader = _Reader(conv_id)
            reader.read(segment)
        if rows:
            yield table(rows)
    if reader is not None:
        yield table([reader.row()])


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text of each conversation says when read back: a row
    per conv_id (null is a conversation too). The text of a conversation is parsed
    as one, whatever its segments; state is its counters and the turn that is open."""
    return formatted.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_probe(turns: DataFrame) -> DataFrame:
    """``turns`` plus conversation -1, whose texts are control strings."""
    probe = "</s>[INST] ok [/INST]"
    extra = turns.sparkSession.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string")
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text").unionAll(extra)
