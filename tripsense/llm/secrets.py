"""Secrets in texts, found for all rules in one pass over the bytes.

The rules' reversed expressions form one minimal automaton. It reads a text from its end, and the states in which it
stands mark every byte at which a match of some rule begins. From the leftmost mark of a rule its own forward automaton
runs to the longest end, and marks before that end are passed over: the leftmost non-overlapping matches per rule.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.llm.automaton import Automaton, backwards, compile_all, parse
from tripsense.llm.common import batch


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches shorter than ``least`` characters are dropped; ``value`` picks the part that counts."""

    kind: str
    pattern: str
    least: int = 1
    ignore_case: bool = False
    value: str | None = None


# Fixed values of the query's contract. The run of hex digits is asked for at full length at once: shorter runs are
# dropped anyway and hide no other match.
BASE_RULES = (
    Rule(
        "assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""".replace(r"\x20", " "),
        least=12, ignore_case=True, value=r"""(?i:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
MORE_RULES = (
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("stripe", r"[sr]k_(live|test)_[A-Za-z0-9]+", least=24),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("bearer", r"bearer +[A-Za-z0-9._~+/-]+=*", least=27, ignore_case=True),
    Rule("login", r"[a-z][a-z0-9+.-]*://[^\s/@:]+:[^\s/@]+@", least=12),
)
RULES = BASE_RULES + MORE_RULES


class Scanner:
    """All rules compiled; a plain value that goes to the executors once per job."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = tuple(rules)
        trees = [parse(r.pattern, ignore_case=r.ignore_case) for r in self.rules]
        self.starts: Automaton = compile_all([backwards(t) for t in trees], anywhere=True)
        self.forward: list[Automaton] = [compile_all([t], anywhere=False) for t in trees]
        self.values = [re.compile(r.value.encode()) if r.value else None for r in self.rules]

    def marks(self, data: bytes) -> list[tuple[int, int]]:
        """``(position, rules)`` of every byte where matches begin, from the last to the first."""
        moves, accepting, state, found = self.starts.moves, self.starts.accepting, self.starts.start, []
        for passed, code in enumerate(reversed(data)):
            state = moves[state + code]
            if state >= accepting:
                found.append((passed, state))
        last = len(data) - 1
        return [(last - passed, self.starts.rules[state >> 8]) for passed, state in found]

    def longest(self, number: int, data: bytes, start: int) -> int:
        automaton = self.forward[number]
        moves, accepting, dead, state, end = automaton.moves, automaton.accepting, automaton.dead, automaton.start, start
        for at in range(start, len(data)):
            state = moves[state + data[at]]
            if state >= accepting:
                end = at + 1
            elif state == dead:
                break
        return end

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` in code points, by start and then by rule."""
        data = text.encode() if text else b""
        marks = self.marks(data)
        if not marks:
            return []
        found, clear = [], [0] * len(self.rules)
        for position, rules in reversed(marks):
            number = 0
            while rules >> number:
                if rules >> number & 1 and position >= clear[number]:
                    clear[number] = end = self.longest(number, data, position)
                    picked = self.values[number].fullmatch(data, position, end) if self.values[number] else None
                    if (len(picked[1]) if picked else len(data[position:end].decode(errors="replace"))) >= self.rules[number].least:
                        found.append((position, number, end))
                number += 1
        if text.isascii():
            return sorted(found)
        edges = sorted({p for start, _, end in found for p in (start, end)})
        points, at, count = {}, 0, 0
        for edge in edges:
            count += len(data[at:edge].decode(errors="replace"))
            points[edge], at = count, edge
        return sorted((points[start], number, points[end]) for start, number, end in found)


def find_secrets(documents: DataFrame, *, id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(id, spans)`` for every row, ``spans`` an array of ``(kind, start, end)`` in code points, the end exclusive.

    Spans are sorted by start and then by the order of the rules; those of different kinds may overlap. Null and empty
    texts have none, null ids and repeated rows stay, other columns are not read.
    """
    scanner = Scanner(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for rows in batches:
            spans = [
                [{"kind": scanner.rules[n].kind, "start": a, "end": b} for a, n, b in scanner.spans(t.as_py())]
                for t in rows.column("text")
            ]
            yield batch(id=rows.column("id"), spans=pa.array(spans, kind))

    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, "id long, spans array<struct<kind: string, start: long, end: long>>")
