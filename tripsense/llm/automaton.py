"""Regular expressions over bytes, compiled into one minimal deterministic automaton.

The syntax: literals, ``\\`` escapes, classes with ranges and ``^``, groups, ``|``, and the quantifiers ``? * + {m} {m,}
{m,n}``. Compilation goes over a tree, a nondeterministic automaton of byte sets, subset construction on classes of
bytes that no set tells apart, and minimisation by refining partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Node = tuple


def parse(pattern: str, *, ignore_case: bool = False) -> Node:
    """A tree of ``("set", bytes)``, ``("cat", nodes)``, ``("or", nodes)`` and ``("rep", node, least, most)``."""
    at = 0

    def char_set(codes: set[int]) -> Node:
        if ignore_case:
            codes = codes | {ord(chr(c).swapcase()) for c in codes if c < 128 and chr(c).isalpha()}
        return ("set", frozenset(codes))

    def escaped() -> set[int]:
        nonlocal at
        at += 1
        symbol = pattern[at - 1]
        return {9, 10, 11, 12, 13, 32} if symbol == "s" else {ord({"n": "\n", "t": "\t"}.get(symbol, symbol))}

    def in_brackets() -> Node:
        nonlocal at
        negated = pattern[at] == "^"
        at += negated
        codes: set[int] = set()
        while pattern[at] != "]":
            at += 1
            if pattern[at - 1] == "\\":
                codes |= escaped()
            elif pattern[at] == "-" and pattern[at + 1] != "]":
                codes |= set(range(ord(pattern[at - 1]), ord(pattern[at + 1]) + 1))
                at += 2
            else:
                codes.add(ord(pattern[at - 1]))
        at += 1
        return ("set", frozenset(range(256)) - codes) if negated else char_set(codes)

    def counts() -> tuple[int, int | None]:
        nonlocal at
        end = pattern.index("}", at)
        least, comma, most = pattern[at:end].partition(",")
        at = end + 1
        return int(least), (int(most) if most else None) if comma else int(least)

    def atom() -> Node:
        nonlocal at
        at += 1
        match pattern[at - 1]:
            case "(":
                inner = alternatives()
                at += 1
                return inner
            case "[":
                return in_brackets()
            case "\\":
                return char_set(escaped())
            case symbol:
                return char_set({ord(symbol)})

    def sequence() -> Node:
        nonlocal at
        parts = []
        while at < len(pattern) and pattern[at] not in "|)":
            part = atom()
            while at < len(pattern) and pattern[at] in "?*+{":
                at += 1
                match pattern[at - 1]:
                    case "?":
                        part = ("rep", part, 0, 1)
                    case "*":
                        part = ("rep", part, 0, None)
                    case "+":
                        part = ("rep", part, 1, None)
                    case _:
                        part = ("rep", part, *counts())
            parts.append(part)
        return ("cat", parts)

    def alternatives() -> Node:
        nonlocal at
        options = [sequence()]
        while at < len(pattern) and pattern[at] == "|":
            at += 1
            options.append(sequence())
        return ("or", options)

    tree = alternatives()
    if at != len(pattern):
        raise ValueError(f"cannot read {pattern!r} from {at}")
    return tree


def backwards(node: Node) -> Node:
    """The tree of the reversed words."""
    match node:
        case ("set", _):
            return node
        case ("cat", parts):
            return ("cat", [backwards(p) for p in reversed(parts)])
        case ("or", options):
            return ("or", [backwards(o) for o in options])
        case ("rep", inner, least, most):
            return ("rep", backwards(inner), least, most)
    raise ValueError(node)


class _Graph:
    """A nondeterministic automaton: empty steps and steps on byte sets."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def add(self, node: Node, start: int) -> int:
        """Adds paths for ``node`` from ``start``; the state at their end."""
        match node:
            case ("set", codes):
                end = self.state()
                self.steps[start].append((codes, end))
                return end
            case ("cat", parts):
                for part in parts:
                    start = self.add(part, start)
                return start
            case ("or", options):
                end = self.state()
                for option in options:
                    self.empty[self.add(option, start)].append(end)
                return end
            case ("rep", inner, least, most):
                for _ in range(least):
                    start = self.add(inner, start)
                if most is None:
                    loop = self.state()
                    self.empty[start].append(loop)
                    self.empty[self.add(inner, loop)].append(loop)
                    return loop
                end = self.state()
                self.empty[start].append(end)
                for _ in range(most - least):
                    start = self.add(inner, start)
                    self.empty[start].append(end)
                return end
        raise ValueError(node)

    def closure(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for following in self.empty[todo.pop()]:
                if following not in seen:
                    seen.add(following)
                    todo.append(following)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``moves[state * 256 + byte]`` is the next state times 256; accepting states come last, from ``accepting`` on.

    ``rules[state // 256]`` holds a bit for each pattern that ends in the state. State 0 is the start; ``dead`` is a state
    that nothing leaves and that accepts nothing, or -1.
    """

    moves: list[int]
    rules: list[int]
    accepting: int
    start: int
    dead: int


def compile_all(trees: list[Node], *, anywhere: bool) -> Automaton:
    """One automaton for all trees; with ``anywhere`` a match may begin at every byte read."""
    graph = _Graph()
    root = graph.state()
    ends = {}
    for number, tree in enumerate(trees):
        begin = graph.state()
        graph.empty[root].append(begin)
        ends[graph.add(tree, begin)] = 1 << number
    columns = np.zeros((256, 0), dtype=bool)
    for codes in {codes for steps in graph.steps for codes, _ in steps}:
        columns = np.column_stack([columns, np.isin(np.arange(256), list(codes))])
    _, kind_of = np.unique(columns, axis=0, return_inverse=True) if columns.shape[1] else (None, np.zeros(256, dtype=int))
    kind_of = kind_of.ravel()
    sample = [int(np.flatnonzero(kind_of == k)[0]) for k in range(kind_of.max() + 1)]

    first = graph.closure({root})
    number_of, todo, table = {first: 0}, [first], []
    while todo:
        states = todo.pop(0)
        row = []
        for code in sample:
            reached = {to for s in states for codes, to in graph.steps[s] if code in codes}
            following = graph.closure(reached) | (first if anywhere else frozenset())
            if following not in number_of:
                number_of[following] = len(number_of)
                todo.append(following)
            row.append(number_of[following])
        table.append(row)
    moves = np.array(table)
    rules = np.zeros(len(number_of), dtype=np.int64)
    for states, number in number_of.items():
        for state in states:
            rules[number] |= ends.get(state, 0)
    return _minimal(moves, rules, kind_of)


def _minimal(moves: np.ndarray, rules: np.ndarray, kind_of: np.ndarray) -> Automaton:
    block = np.unique(rules, return_inverse=True)[1]
    while True:
        _, finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    _, member = np.unique(block, return_index=True)
    order = np.argsort(rules[member] > 0, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    small = rank[block[moves[member[order]]]]
    ends = rules[member[order]]
    stuck = [s for s in range(len(small)) if ends[s] == 0 and (small[s] == s).all()]
    return Automaton(
        moves=(small[:, kind_of] * 256).ravel().tolist(), rules=ends.tolist(),
        accepting=int((ends == 0).sum()) * 256, start=int(rank[block[0]]) * 256, dead=stuck[0] * 256 if stuck else -1,
    )
