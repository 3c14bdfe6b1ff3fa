"""Licence notices and identifier tags in texts.

An Aho-Corasick automaton runs once over the words of a text and finds the phrases of licence notices and the tags that
announce a licence expression. What follows a tag is read by a shunting-yard parser: ``or`` binds least, then ``and``,
then ``with``. Its evaluation says which licences are in force: of alternatives the most permissive one, of licences that
hold together all of them with the least permission, and an exception takes away half of what a licence lacks.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch

# Fixed values of the query's contract: phrases, as words, and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# More phrases of notices.
PHRASES = {
    "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "european union public licence": "eupl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "dedicated to the public domain": "public-domain",
    "this is free and unencumbered software": "unlicense",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "all rights reserved": "reserved",
}
# Tags, as words, that a colon or an equals sign and an expression follow.
TAGS = ("spdx license identifier", "license expression", "license id")
# What a label permits, from nothing (0) to everything (1).
PERMISSION = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0,
    "mit": 0.95, "isc": 0.95, "bsd": 0.95, "bsl": 0.95,
    "apache": 0.9, "cc-by": 0.9,
    "mpl": 0.6, "epl": 0.6, "eupl": 0.55, "lgpl": 0.5, "cc-by-sa": 0.45,
    "gpl": 0.3, "agpl": 0.2,
    "cc-by-nd": 0.15, "cc-by-nc": 0.1, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.05,
    "reserved": 0.0,
}
UNKNOWN_PERMISSION = 0.25

# A-Z in lower case, and a space for every other ASCII character that is neither digit nor letter.
_TO_WORDS = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_AFTER_TAG = re.compile(rb"[ \t]*[:=][ \t]*([^\r\n]*)")
_TOKENS = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.+:_-]*)", re.ASCII)
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


class Terms(NamedTuple):
    """What an expression or a part of it amounts to."""

    score: float
    labels: set[str]


class Found(NamedTuple):
    n_words: int
    base: list[tuple[int, str]]
    labels: set[str]
    expressions: list[str]
    in_force: set[str]
    score: float


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    """Patterns stand between spaces, so they meet whole words only; several kinds may share one pattern."""
    kinds: dict[str, list[tuple[str, str]]] = {}
    for kind, names in (("base", BASE_PHRASES), ("phrase", PHRASES), ("tag", dict.fromkeys(TAGS, ""))):
        for phrase, label in names.items():
            kinds.setdefault(phrase, []).append((kind, label))
    automaton = ahocorasick.Automaton()
    for phrase, meanings in kinds.items():
        automaton.add_word(f" {phrase} ", (phrase.count(" ") + 1, tuple(meanings)))
    automaton.make_automaton()
    return automaton


def label_of(identifier: str) -> str:
    """The label whose name an identifier begins with, the longest of several; without one the identifier itself."""
    name = identifier.lower()
    fits = [label for label in PERMISSION if name == label or (name.startswith(label) and name[len(label)] in "-+.v0123456789")]
    return max(fits, key=len, default=name)


def postfix(expression: str) -> tuple[list[str], int]:
    """The expression in postfix order, as far as it is one, and its length: it ends before the first token that does not fit.

    Operators without a right side are left out, open brackets close at the end.
    """
    out: list[str] = []
    held: list[str] = []
    operand_next, at = True, 0
    while (found := _TOKENS.match(expression, at)) is not None:
        token = found.group(1)
        operator = token.lower() if token.lower() in _PRECEDENCE else None
        if operand_next:
            if operator or token == ")":
                break
            if token == "(":
                held.append(token)
            else:
                out.append(token)
                operand_next = False
        elif operator:
            while held and held[-1] != "(" and _PRECEDENCE[held[-1]] >= _PRECEDENCE[operator]:
                out.append(held.pop())
            held.append(operator)
            operand_next = True
        elif token == ")" and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        else:
            break
        at = found.end()
    if operand_next:  # what waits for a right side that never came
        while held and held[-1] == "(":
            held.pop()
        if held:
            held.pop()
    return out + [token for token in reversed(held) if token != "("], at


def evaluate(tokens: list[str]) -> Terms | None:
    """What a postfix expression amounts to; null for an empty one."""
    stack: list[Terms | str] = []

    def terms(value: Terms | str) -> Terms:
        if isinstance(value, Terms):
            return value
        label = label_of(value)
        return Terms(PERMISSION.get(label, UNKNOWN_PERMISSION), {label})

    for token in tokens:
        if token not in _PRECEDENCE:
            stack.append(token)
            continue
        right, left = stack.pop(), terms(stack.pop())
        if token == "with":  # the right side names an exception
            stack.append(Terms((left.score + 1) / 2, left.labels))
            continue
        right = terms(right)
        if token == "and":
            few, many = sorted((left.labels, right.labels), key=len)
            many |= few
            stack.append(Terms(min(left.score, right.score), many))
        else:
            stack.append(max(left, right, key=lambda t: t.score))
    return terms(stack[-1]) if stack else None


def identifiers(tokens: list[str]) -> list[str]:
    """The licences that a postfix expression names, without exceptions."""
    names, exception = [], [False]
    for token in reversed(tokens):  # an operator comes before its right side, that before its left side
        within = exception.pop()
        if token in _PRECEDENCE:
            exception += [within, within or token == "with"]
        elif not within:
            names.append(token)
    return names


def scan_text(text: str | None) -> Found:
    """Everything found in one text, in time in proportion to its length."""
    raw = (text or "").encode()
    spaced = raw.translate(_TO_WORDS)
    words = spaced.split()
    joined = f" {b' '.join(words).decode('latin-1')} " if words else ""
    base: list[tuple[int, str]] = []
    phrases: list[tuple[int, str]] = []
    tags: list[int] = []
    seen = passed = 0  # spaces up to the place looked at
    for end, (length, meanings) in _automaton().iter(joined):
        passed += joined.count(" ", seen, end)
        seen = end
        for kind, label in meanings:
            if kind == "tag":
                tags.append(passed)
                continue
            phrases.append((passed - length, label))
            if kind == "base":
                base.append(phrases[-1])
    labels, in_force, expressions, scores = {label for _, label in phrases}, set(), [], []
    spans: list[tuple[int, int]] = []  # of expressions, in words
    if tags:
        inside = np.frombuffer(spaced, dtype=np.uint8) != 0x20
        ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1  # of every word, in bytes
        for after in tags:
            follows = _AFTER_TAG.match(raw, int(ends[after - 1]))
            line = follows.group(1).decode() if follows else ""
            tokens, length = postfix(line)
            terms = evaluate(tokens)
            if terms:
                spans.append((after, int(np.searchsorted(ends, follows.start(1) + length, side="right"))))
                labels |= {label_of(name) for name in identifiers(tokens)}
                in_force |= terms.labels
                expressions.append(" ".join(tokens))
                scores.append(terms.score)
    for first, label in phrases:  # one that is an identifier's words is judged with its expression
        at = bisect_right(spans, (first, len(words))) - 1
        if at < 0 or first >= spans[at][1]:
            in_force.add(label)
            scores.append(PERMISSION.get(label, UNKNOWN_PERMISSION))
    return Found(len(words), sorted(base), labels, expressions, in_force, min(scores, default=0.0))


def scan(documents: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """What every row of ``documents`` says about licences, in one pass without a shuffle.

    ``n_words``; ``base``, the places ``(start, label)`` of the contract's phrases in order; ``labels``, all labels, sorted;
    ``expressions``, those after tags, in postfix order; ``in_force``, the labels left when every ``or`` is decided, sorted;
    ``score``, the least permission of all that was found, 0 where nothing was. Null texts count as empty ones, null ids and
    repeated rows stay, other columns are not read.
    """
    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    place = pa.struct([("start", pa.int64()), ("label", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [scan_text(t.as_py()) for t in rows.column("text")]
            names = pa.list_(pa.string())
            yield batch(
                id=rows.column("id"), n_words=pa.array([f.n_words for f in found], pa.int64()),
                base=pa.array([[{"start": s, "label": l} for s, l in f.base] for f in found], pa.list_(place)),
                labels=pa.array([sorted(f.labels) for f in found], names),
                expressions=pa.array([f.expressions for f in found], names),
                in_force=pa.array([sorted(f.in_force) for f in found], names),
                score=pa.array([f.score for f in found], pa.float64()),
            )

    return source.mapInArrow(
        run,
        "id long, n_words long, base array<struct<start: long, label: string>>, labels array<string>,"
        " expressions array<string>, in_force array<string>, score double",
    )
