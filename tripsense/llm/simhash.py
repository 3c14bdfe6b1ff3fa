"""SimHash fingerprints and near-duplicate groups through a Gray-ordered hierarchical index.

Fingerprints are reduced to distinct ones first. Two that differ in at most three bits agree on two of five bit
blocks, so ten tables of two-block keys bring every link into some cell. In a cell the fingerprints are sorted by
Gray rank, which puts neighbours with shared bits side by side, and a tree is laid over the order: a node holds the bits
on which all below it agree and that no node above it holds. A search walks down with the differences gathered so far
and drops a node with everything below it once they pass the limit. Cells above ``CELL_ROWS`` are dealt over pairs of
parts, so no task holds more than two parts, and a cell gives back a spanning forest, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch, cut, numbers, sorted_groups
from tripsense.llm.components import components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
CELL_ROWS = 8192
FANOUT = 8
SHINGLES_AT_ONCE = 1 << 16
FRONTIER = 1 << 20

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bit b is set if it is set in over half of the shingle hashes; no word: zero; fewer words: one shingle."""
    tokens = text.encode().lower().split() if text else []  # of bytes: A-Z only
    if not tokens:
        return 0
    count = max(1, len(tokens) - shingle_words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, count, SHINGLES_AT_ONCE):
        block = tokens[start : min(start + SHINGLES_AT_ONCE, count) + shingle_words - 1]
        rows = max(1, len(block) - shingle_words + 1)
        shingles = map(b" ".join, zip(*(block[i:] for i in range(shingle_words)))) if len(tokens) >= shingle_words else [b" ".join(tokens)]
        hashes = np.fromiter(map(_hash, shingles), dtype="<u8", count=rows)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > count, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(documents: DataFrame, *, id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, _text_hash, code)`` for every row; the code is the fingerprint as a signed long.

    Null and empty texts have code zero, rows with a null id keep it, and repeated rows stay. Other columns are not read.
    """
    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            codes = [fingerprint(t.as_py(), shingle_words) for t in rows.column("text")]
            yield batch(id=rows.column("id"), _text_hash=rows.column("_text_hash"), code=pa.array(codes, pa.int64()))

    hashed = source.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit("\0"))))
    return hashed.mapInArrow(run, "id long, _text_hash long, code long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    ranks = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        ranks = ranks ^ (ranks >> np.uint64(shift))
    return ranks


class GrayIndex:
    """A tree over Gray-sorted codes; ``levels[0]`` is the root level, the last one the codes themselves.

    Per level: ``mask`` has the bits that a node adds to those of the nodes above it, ``pattern`` their values and
    ``free`` how many bits still vary below it.
    """

    def __init__(self, codes: np.ndarray):
        self.codes = codes[np.argsort(gray_rank(codes), kind="stable")]
        ones, union = [self.codes], [self.codes]
        while len(ones[-1]) > 1:
            starts = np.arange(0, len(ones[-1]), FANOUT)
            ones.append(np.bitwise_and.reduceat(ones[-1], starts))
            union.append(np.bitwise_or.reduceat(union[-1], starts))
        self.levels = []
        above = np.zeros(1, dtype=np.uint64)
        for low, high in zip(reversed(ones), reversed(union)):
            shared = ~(low ^ high)
            if self.levels:
                above = np.repeat(above, FANOUT)[: len(low)]
            self.levels.append((shared & ~above, low, 64 - np.bitwise_count(shared).astype(np.int64)))
            above = shared

    def links(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions of codes at most ``limit`` bits apart, later with earlier, in batches.

        Where all below a node are surely within the limit of a code, the code and the node's first are given
        together with the node's own neighbours in order, which joins the same codes.
        """
        total = len(self.codes)
        step = 256
        for first in range(0, total, step):
            here = np.arange(first, min(first + step, total))
            asked, node, gone = here, np.zeros(len(here), dtype=np.int64), np.zeros(len(here), dtype=np.int64)
            for depth, (mask, pattern, free) in enumerate(self.levels):
                if depth:
                    asked, gone = np.repeat(asked, FANOUT), np.repeat(gone, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                span = FANOUT ** (len(self.levels) - 1 - depth)
                inside = (node < len(mask)) & (node * span < asked)
                asked, node, gone = asked[inside], node[inside], gone[inside]
                gone = gone + np.bitwise_count((self.codes[asked] ^ pattern[node]) & mask[node])
                near = gone <= limit
                asked, node, gone = asked[near], node[near], gone[near]
                if span > 1:
                    whole = (gone + free[node] <= limit) & ((node + 1) * span <= asked)
                    if whole.any():
                        yield asked[whole], node[whole] * span
                        for one in np.unique(node[whole]):
                            run = np.arange(one * span, (one + 1) * span)
                            yield run[1:], run[:-1]
                        asked, node, gone = asked[~whole], node[~whole], gone[~whole]
            for start in range(0, len(asked), FRONTIER):
                yield asked[start : start + FRONTIER], node[start : start + FRONTIER]


def forest(codes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between distinct codes: each linked code with its group's first."""
    index = GrayIndex(codes)
    label = np.arange(len(codes))
    for later, earlier in index.links(limit):
        while True:
            one, two = label[later], label[earlier]
            open_ = one != two
            if not open_.any():
                break
            later, earlier = later[open_], earlier[open_]
            np.minimum.at(label, np.maximum(one, two)[open_], np.minimum(one, two)[open_])
            while (label != (jumped := label[label])).any():
                label = jumped
    moved = np.flatnonzero(label != np.arange(len(codes)))
    return index.codes[moved], index.codes[label[moved]]


def _block_pairs() -> list[int]:
    edges = [0, 13, 26, 39, 52, 64]
    masks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(masks, 2)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def links(codes: DataFrame, *, limit: int = MAX_DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``(a, b)``: edges between codes that join exactly those that chains of links of ``limit`` bits join.

    ``codes`` has one long column ``code``, every value once. ``limit`` is at most 3: five blocks, two of them equal.
    """
    if limit > 3:
        raise ValueError("five blocks with two equal ones find links of up to three bits")
    keyed = codes.select(
        F.col("code"),
        F.posexplode(F.array(*[F.col("code").bitwiseAND(F.lit(_signed(m))) for m in _block_pairs()])).alias("tab", "key"),
    )
    cells = keyed.groupBy("tab", "key").agg(F.count("*").alias("rows")).filter("rows > 1")
    parts = F.ceil(F.col("rows") / F.lit(cell_rows)).cast("int")
    dealt = keyed.join(cells, ["tab", "key"]).select(
        "tab", "key", "code", parts.alias("parts"), F.pmod(F.xxhash64("code"), parts).cast("int").alias("part")
    )
    meeting = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.least(F.col("part"), other) * F.col("parts") + F.greatest(F.col("part"), other),
    )
    placed = dealt.select("tab", "key", "code", F.explode(meeting).alias("pair"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in sorted_groups(batches, ["tab", "key", "pair"]):
            a, b = forest(numbers(rows, "code").view(np.uint64), limit)
            if len(a):
                yield batch(a=pa.array(a.view(np.int64)), b=pa.array(b.view(np.int64)))

    grouped = placed.repartition("tab", "key", "pair").sortWithinPartitions("tab", "key", "pair")
    return grouped.mapInArrow(run, "a long, b long")


def near_duplicates(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text",
    shingle_words: int = SHINGLE_WORDS, limit: int = MAX_DISTANCE, cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """``(id, _text_hash, code, root, component_id)`` for every row of ``documents``.

    ``root`` names the group by a code, ``component_id`` is its smallest id (null if it has none). Null and empty
    texts share the code zero and so a group; an empty table gives an empty one.
    """
    marked = cut(fingerprints(documents, id=id, text=text, shingle_words=shingle_words))
    by_code = marked.groupBy("code").agg(F.min("id").alias("first_id"))
    linked = components(links(by_code.select("code"), limit=limit, cell_rows=cell_rows))
    rooted = by_code.join(linked.withColumnRenamed("node", "code"), "code", "left").select(
        "code", "first_id", F.coalesce("root", "code").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return marked.join(rooted.join(smallest, "root").select("code", "root", "component_id"), "code").select(
        "id", "_text_hash", "code", "root", "component_id"
    )


def keep_one(documents: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``documents`` with one row of each group: that with the smallest id (nulls last), then the smallest other values."""
    return keep_first(documents, near_duplicates(documents, id=id, text=text, **options), id=id, text=text)


def keep_first(documents: DataFrame, groups: DataFrame, *, id: str, text: str) -> DataFrame:
    """One row of ``documents`` for each ``root`` of ``groups``, chosen as ``keep_one`` says."""
    rank = F.struct(F.col("id").isNull(), F.col("id"), F.col("_text_hash"))
    kept = groups.groupBy("root").agg(F.min(rank).alias("k")).select(
        F.col("k.id").alias("_id"), F.col("k._text_hash").alias("_hash")
    )
    keyed = documents.select(
        F.struct("*").alias("row"), F.col(id).cast("long").alias("_id"),
        F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("\0"))).alias("_hash"),
    )
    chosen = keyed.alias("d").join(
        kept.alias("k"), F.col("d._id").eqNullSafe(F.col("k._id")) & (F.col("d._hash") == F.col("k._hash")), "left_semi"
    )
    return chosen.groupBy("_id", "_hash").agg(F.min("row").alias("row")).select("row.*")
