"""Chat formatting from event logs: conversations are rebuilt from their events and then rendered.

An event belongs to a turn of a conversation and has a sequence number. ``message`` opens a message with a text, ``delta``
adds to the open one, ``edit`` replaces its text, ``regenerate`` empties it and takes back every later turn that was said
before. Events are partitioned by conversation and sorted by turn and sequence; the fold holds one message and one number
at a time, so neither a conversation nor a partition has to fit in memory. Messages are rendered one by one, with the
control strings of the template escaped, and come out in order, so a whole conversation is their concatenation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch

BEGIN, END = "<|im_start|>", "<|im_end|>"
# Strings that common chat templates read as control; fixed values.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|end|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
TRAINED_ROLE = "assistant"
ROWS_AT_ONCE = 512
# What tells the events of equal rows apart in a log of ``streamed_events``.
WITHIN = ("message", "copy", "part")

_TAILS = "|".join(re.escape(c[1:]) for c in sorted(CONTROL, key=len, reverse=True))
_PLAIN = re.compile(rf"([<\[])(\\*)({_TAILS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)({_TAILS})")
_RENDERED = re.compile(rf"{re.escape(BEGIN)}(.*)\n(.*){re.escape(END)}\n", re.DOTALL)

_EVENT = "conv_id long, turn long, seq long, kind string, role string, text string"
_MESSAGE = "conv_id long, turn long, seq long, role string, text string"
_FORMATTED = "conv_id long, turn long, seq long, formatted string, loss_start long, loss_end long"


def escape(text: str) -> str:
    """A backslash goes behind the first sign of every control string, and one more where there are some already."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The message in the template, and where its text stands in it. The role keeps to one line."""
    head = f"{BEGIN}{escape(role.replace(chr(92), chr(92) * 2).replace(chr(10), chr(92) + 'n'))}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def read(formatted: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    head, _, body = formatted.removeprefix(BEGIN).partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(head))
    return role, unescape(body.removesuffix(f"{END}\n"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for rows in batches:
        yield from zip(*(rows.column(i).to_pylist() for i in range(rows.num_columns)))


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_AT_ONCE:
            yield batch(**{n: pa.array(c, t) for n, t, c in zip(names, types, zip(*held))})
            held = []
    if held:
        yield batch(**{n: pa.array(c, t) for n, t, c in zip(names, types, zip(*held))})


def _fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Messages of sorted events. ``parts`` is None while nothing is open."""
    conversation: object = events  # equal to no id
    turn = undone = None
    opened = role = parts = None

    def close():
        if parts is not None:
            yield conversation, turn, opened, role, "".join(parts)

    latest = None
    for conv_id, at, seq, kind, said_by, text in events:
        if conv_id != conversation or at != turn:
            yield from close()
            parts = None
            if conv_id != conversation:
                undone = latest = None
            elif latest is not None:
                undone = latest if undone is None else max(undone, latest)
            latest = None
            conversation, turn = conv_id, at
        if undone is not None and seq is not None and seq < undone:
            continue
        text = text or ""
        if kind == "delta" and parts is not None:
            parts.append(text)
        elif kind == "edit" and parts is not None:
            parts = [text]
        elif kind == "regenerate" and parts is not None:
            parts = [text]
            latest = seq if latest is None or (seq is not None and seq > latest) else latest
        else:
            yield from close()
            opened, role, parts = seq, said_by or "", [text]
    yield from close()


def messages(events: DataFrame, *, within: Sequence[str] = ()) -> DataFrame:
    """``(conv_id, turn, seq, role, text)``: the final messages, sorted within the partitions of the conversations.

    ``events`` has the columns of ``_EVENT``; others are not read. A null conversation id is one conversation, a null turn comes
    first, a null kind is ``message``, null texts and roles are empty. Events of one sequence number are taken by role, the
    columns ``within`` and text. A delta, edit or regeneration without an open message opens one. A second ``message`` in a turn is a message of its
    own. An event of a turn that was said before an earlier turn was regenerated is dropped.
    """
    columns = [f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in _EVENT.split(", ")]
    order = [f"_within{n}" for n in range(len(within))]
    sorted_ = (
        events.selectExpr(*columns, *[f"`{c}` as {name}" for c, name in zip(within, order)])
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "seq", "role", *order, "text")
        .drop(*order)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(
            _fold(_rows(batches)), ["conv_id", "turn", "seq", "role", "text"],
            [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()],
        )

    return sorted_.mapInArrow(run, _MESSAGE)


def formatted(said: DataFrame) -> DataFrame:
    """``(conv_id, turn, seq, formatted, loss_start, loss_end)``: rendered messages in the same order.

    The loss mask covers code points ``loss_start`` to ``loss_end`` of an assistant's message; elsewhere both are null.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        for conv_id, turn, seq, role, text in rows:
            shown, start, end = render(role, text)
            learnt = role == TRAINED_ROLE
            yield conv_id, turn, seq, shown, start if learnt else None, end if learnt else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(
            each(_rows(batches)), [c.split()[0] for c in _FORMATTED.split(", ")],
            [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()],
        )

    return said.mapInArrow(run, _FORMATTED)


def digests(shown: DataFrame) -> DataFrame:
    """One row per conversation, read back from rendered messages that stand in order in their partitions.

    ``turns_sha256`` is over role, line feed, text, line feed of each turn, ``loss_sha256`` over the unescaped text under the
    loss mask; both are fed message by message.
    """

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        conversation: object = rows
        turns = count = learnt = length = loss = None
        for conv_id, _, _, text, start, end in rows:
            if conv_id != conversation:
                if turns is not None:
                    yield conversation, count, turns.hexdigest(), learnt, loss.hexdigest(), length
                conversation, turns, loss = conv_id, hashlib.sha256(), hashlib.sha256()
                count = learnt = length = 0
            role, said = read(text)
            turns.update(f"{role}\n{said}\n".encode())
            count += 1
            length += len(text)
            if start is not None:
                masked = unescape(text[start:end])
                loss.update(masked.encode())
                learnt += len(masked)
        if turns is not None:
            yield conversation, count, turns.hexdigest(), learnt, loss.hexdigest(), length

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(each(_rows(batches)), names, types)

    return shown.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def message_events(rows: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Finished rows as a log: one ``message`` event each, its turn being its sequence number."""
    return rows.select(
        F.col(conversation).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.col(turn).cast("long").alias("seq"), F.lit("message").alias("kind"), F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )


def streamed_events(rows: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Finished rows as the log of a chat that streamed them: folded, it gives the rows back.

    A text comes in two pieces. One third of the rows (by a hash of role and text) has it so at once, as a message and a delta;
    for another third a draft is said first and then replaced by an edit, for the last by a regeneration, which also takes back
    an answer that stood in the next turn. Two to four events a row, whose pieces together are no longer than the text; rows of one
    turn keep apart by the columns of ``WITHIN``. A null turn is never regenerated, as its events have no sequence number.
    """
    plain = rows.select(
        F.col(conversation).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumns({"message": F.xxhash64("role", "text"), "copy": F.monotonically_increasing_id()})
    half = F.floor(F.length("text") / 2).cast("int")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.length("text"))

    def event(part: int, kind: str, said: Column, at: Column = F.col("turn"), seq: Column = F.col("turn")) -> Column:
        return F.struct(
            at.alias("turn"), seq.alias("seq"), F.lit(kind).alias("kind"), said.alias("text"), F.lit(part).alias("part")
        )

    draft, way = F.lit("unsaid"), F.pmod("message", F.lit(3))
    edges = F.lit(-(1 << 63)), F.lit((1 << 63) - 1)
    inside = (F.col("turn") > edges[0]) & (F.col("turn") < edges[1])
    taken_back = event(0, "message", draft, F.try_add("turn", F.lit(1)), F.try_subtract("turn", F.lit(1)))
    at_once = F.array(event(0, "message", first), event(2, "delta", second))
    edited = F.array(event(0, "message", draft), event(1, "edit", first), event(2, "delta", second))
    again = F.array(event(0, "message", draft), event(1, "regenerate", first), event(2, "delta", second), taken_back)
    log = F.when(way == 0, at_once).when((way == 1) | ~F.coalesce(inside, F.lit(False)), edited).otherwise(again)
    return plain.select("conv_id", "role", "message", "copy", F.inline(log))
