"""Fill-in-the-middle: texts cut at two token boundaries and put together in another order.

The boundaries of a text's tokens are a compressed set of code point offsets in the manner of Roaring bitmaps: offsets are
dealt by their upper bits to containers of ``CONTAINER`` values, and each container is an array, a bitmap or a list of
runs, whichever is smallest. Cumulative cardinalities find the container that holds the k-th boundary, and a select inside
it gives the offset, so both cuts come from two searches and no list of tokens is ever made.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch

# Fixed values of the query's contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90
SPM_BELOW = 20
SEED = 1

CONTAINER = 1 << 16


class ArrayContainer:
    """Few values, as they are."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)

    @staticmethod
    def bytes(values: np.ndarray, runs: int) -> int:
        return 2 * len(values)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """Many scattered values: a bit each, with the number of bits before every 64-bit word."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(CONTAINER, dtype=np.uint8)
        bits[values] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def bytes(values: np.ndarray, runs: int) -> int:
        return CONTAINER // 8

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return at * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Values in a row: where each run begins, and the number of values before it."""

    def __init__(self, values: np.ndarray):
        first = np.flatnonzero(np.diff(values, prepend=-2) != 1)
        self.starts, self.before = values[first].astype(np.uint16), first.astype(np.int64)

    @staticmethod
    def bytes(values: np.ndarray, runs: int) -> int:
        return 4 * runs

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def container(values: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted values below ``CONTAINER``."""
    runs = int(np.count_nonzero(np.diff(values) != 1)) + 1
    return min((RunContainer, ArrayContainer, BitmapContainer), key=lambda kind: kind.bytes(values, runs))(values)


class BoundarySet:
    """A sorted set of offsets that answers which is the k-th."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.containers: list[ArrayContainer | BitmapContainer | RunContainer] = []
        self.before = [0]

    def add(self, key: int, values: np.ndarray) -> None:
        """Offsets ``key * CONTAINER`` plus each of the sorted ``values``; keys come in ascending order."""
        if len(values):
            self.keys.append(key)
            self.containers.append(container(values))
            self.before.append(self.before[-1] + len(values))

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, k: int) -> int:
        at = bisect_right(self.before, k) - 1
        return self.keys[at] * CONTAINER + self.containers[at].select(k - self.before[at])


def boundaries(text: str) -> BoundarySet:
    """Offsets at which a token begins, and the end: a token is a run of the letters A-Z, a-z or any other code point."""
    held = BoundarySet()
    inside = False  # whether the code point before is a letter
    for key in range(len(text) // CONTAINER + 1):
        points = np.frombuffer(text[key * CONTAINER : (key + 1) * CONTAINER].encode("utf-32-le"), dtype="<u4")
        letter = (points | 0x20) - 0x61 < 26
        goes_on = letter.copy()
        goes_on[1:] &= letter[:-1]
        goes_on[:1] &= inside
        begins = np.flatnonzero(~goes_on)
        if len(points) < CONTAINER:
            begins = np.append(begins, len(points))
        else:
            inside = bool(letter[-1])
        held.add(key, begins)
    return held


def cut_numbers(id: int | None, seed: int = SEED) -> tuple[int, ...]:
    """Four numbers of 32 bits that a row's id decides; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    return tuple(int(digest[at : at + 8], 16) for at in range(0, 32, 8))


def transformed(text: str, id: int | None, seed: int = SEED) -> tuple[int, str, str, int | None, int | None]:
    """``(tokens, form, output, prefix_chars, middle_chars)`` of a text."""
    edges = boundaries(text)
    n = len(edges) - 1
    h1, h2, h3, h4 = cut_numbers(id, seed)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= PLAIN_FROM:
        return n, "plain", text, None, None
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    low, high = edges.select(one), edges.select(two)
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h4 % 100 < SPM_BELOW:
        return n, "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", low, high - low
    return n, "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", low, high - low


def restored(output: str, form: str) -> str:
    """The text that an output was made from; no cut text contains a mark, so the first of each is the one set there."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output.removeprefix(first).split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return two + middle + one if form == "spm" else one + middle + two


def fill_in_middle(documents: DataFrame, *, id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """``(id, n, form, output, prefix_chars, middle_chars)`` for every row of ``documents``, in one pass without a shuffle.

    ``form`` is ``plain`` (the text as it is; both lengths null), ``psm`` or ``spm``. Null texts count as empty ones and
    stay plain, null ids are cut like others, repeated rows stay, other columns are not read.
    """
    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            made = [transformed(t.as_py() or "", i.as_py(), seed) for t, i in zip(rows.column("text"), rows.column("id"))]
            n, form, output, prefix, middle = zip(*made) if made else ((),) * 5
            yield batch(
                id=rows.column("id"), n=pa.array(n, pa.int64()), form=pa.array(form, pa.string()),
                output=pa.array(output, pa.string()),
                prefix_chars=pa.array(prefix, pa.int64()), middle_chars=pa.array(middle, pa.int64()),
            )

    return source.mapInArrow(run, "id long, n long, form string, output string, prefix_chars long, middle_chars long")


def round_trip(made: DataFrame) -> DataFrame:
    """``made`` with ``restored``, each text rebuilt from output and form alone."""
    columns = made.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = [restored(o.as_py(), f.as_py()) for o, f in zip(rows.column("output"), rows.column("form"))]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], names=[*columns, "restored"])

    return made.mapInArrow(run, f"{schema}, restored string")
