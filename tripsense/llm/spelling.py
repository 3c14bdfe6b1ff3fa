"""Spelling variants: words one edit apart, found through Bloom-guided neighbourhoods.

Every word of the vocabulary makes the words that one deletion or one replacement turns it into; an insertion is the
deletion of the longer word. Only hashes of these edits are made, a batch of equally long words at a time, and probed
against blocked Bloom filters of the vocabulary, one shard of filters for each word length. Edits that a filter lets pass
are spelled out and meet the vocabulary in an exact join, which removes what the filter let pass by mistake.

A filter holds ``BITS_PER_WORD`` bits a word. Lengths with more than ``SHARD_WORDS`` words have several shards, and the
shards are broadcast in rounds of at most ``ROUND_WORDS`` words (64 MB), so a larger vocabulary takes more rounds, not
larger broadcasts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch, cut

# Fixed values of the query's contract.
LEAST_LENGTH = 7
LEAST_COUNT = 2
FORM_FACTOR = 10
THINNED = 31

BITS_PER_WORD = 16
BLOCK_BITS = 512
SHARD_WORDS = 1 << 22
ROUND_WORDS = 1 << 25
# Longer words share their shards.
LONGEST_CLASS = 64
PIECE_CHARS = 1 << 20
COUNTED_AT_ONCE = 200_000
PROBES_AT_ONCE = 1 << 19
SEED = 23

_LETTERS = "A-Za-zÀ-ÿ"
_RUN = re.compile(f"[{_LETTERS}]+")
_END = re.compile(f"[^{_LETTERS}]")
# What a replacement can put in: the letters of a run after A-Z are lower-cased.
ALPHABET = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], dtype=np.uint32)

_rng = np.random.default_rng(SEED)
_BASE = int(_rng.integers(1, 1 << 62)) * 2 + 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_VALUES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _pieces(text: str) -> Iterator[str]:
    """The text in parts that cut no run; a run is kept whole however long it is."""
    start = 0
    while start < len(text):
        end = start + PIECE_CHARS
        if end < len(text):
            found = _END.search(text, end)
            end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def thinned(run: str, id_crc: int) -> str:
    """The run, without one of its code points where its hash is divisible; ``id_crc`` is the crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), id_crc)
    if h % THINNED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def text_words(text: str | None, id: int | None) -> Counter[str]:
    """Occurrences of the words of a text that are long enough; a null text has none, a null id counts as no digits."""
    words: Counter[str] = Counter()
    if not text:
        return words
    id_crc = zlib.crc32(f"{'' if id is None else id}:".encode())
    for piece in _pieces(text):
        runs = Counter(_RUN.findall(piece.encode().lower().decode()))  # of bytes: A-Z only
        for run, n in runs.items():
            if len(run) >= LEAST_LENGTH:
                word = thinned(run, id_crc)
                if len(word) >= LEAST_LENGTH:
                    words[word] += n
    return words


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def code_points(words: list[str]) -> np.ndarray:
    """A row of code points for each of several equally long words."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), -1)


def word_codes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row of code points: a polynomial whose edits are cheap, then mixed."""
    terms = _VALUES[points & 0xFF] * _powers(_BASE, points.shape[1])
    return _mixed(terms.sum(axis=1, dtype=np.uint64))


def deletions(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, code)`` of the words without one letter; of a run of equal letters only the first goes."""
    terms = _VALUES[points & 0xFF] * _powers(_BASE, points.shape[1])
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    after = terms.sum(axis=1, dtype=np.uint64)[:, None] - before - terms
    codes = _mixed(before + after * np.uint64(_UNBASE))
    new = np.ones(points.shape, dtype=bool)
    new[:, 1:] = points[:, 1:] != points[:, :-1]
    row, place = np.nonzero(new)
    return row, place, codes[row, place]


def replacements(points: np.ndarray, places: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place, letter, code)`` of the words with one letter made a larger one, so each pair comes up once."""
    powers = _powers(_BASE, points.shape[1])
    whole = (_VALUES[points & 0xFF] * powers).sum(axis=1, dtype=np.uint64)
    here = points[:, places]
    row, place, letter = np.nonzero(ALPHABET[None, None, :] > here[:, :, None])
    moved = _VALUES[ALPHABET[letter] & 0xFF] - _VALUES[here[row, place] & 0xFF]
    return row, place + (places.start or 0), letter, _mixed(whole[row] + moved * powers[places][place])


class Filter:
    """A blocked Bloom filter: eight words of 64 bits a block, one bit of each a key."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    @staticmethod
    def size(words: int) -> int:
        """Number of blocks for so many words."""
        return max(1, -(-words * BITS_PER_WORD // BLOCK_BITS))

    @classmethod
    def of(cls, codes: np.ndarray, blocks: int) -> Filter:
        held = np.zeros((blocks, 8), dtype=np.uint64)
        at, turned = cls.block_of(codes, blocks), cls.turned(codes)
        for n in range(8):
            np.bitwise_or.at(held[:, n], at, cls.bit(turned, n))
        return cls(held)

    @staticmethod
    def block_of(codes: np.ndarray, blocks: int) -> np.ndarray:
        return ((codes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)

    @staticmethod
    def turned(codes: np.ndarray) -> np.ndarray:
        """The bits that choose the bit in each word of a block."""
        return _mixed(codes + np.uint64(0x9E3779B97F4A7C15))

    @staticmethod
    def bit(turned: np.ndarray, n: int) -> np.ndarray:
        return np.uint64(1) << ((turned >> np.uint64(6 * n)) & np.uint64(63))

    def hits(self, codes: np.ndarray) -> np.ndarray:
        """Positions of the codes that may be in the filter; never without one that is."""
        left = np.arange(len(codes))
        block, turned = self.block_of(codes, len(self.blocks)), self.turned(codes)
        for n in range(8):
            kept = self.blocks[block, n] & self.bit(turned, n) != 0
            left, block, turned = left[kept], block[kept], turned[kept]
        return left


def shard_of(codes: np.ndarray, shards: int) -> np.ndarray:
    """By bits that choose no block within a shard."""
    return (_mixed(codes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)) * np.uint64(shards) >> np.uint64(24)


def _probe(codes: np.ndarray, length: int, filters: dict[int, tuple[int, dict[int, Filter]]]) -> np.ndarray:
    """Positions of the codes that some filter of their length in this round lets pass."""
    shards, held = filters.get(min(length, LONGEST_CLASS), (1, {}))
    if shards == 1:
        return held[0].hits(codes) if held else np.zeros(0, dtype=np.int64)
    own = shard_of(codes, shards)
    found = []
    for shard, filter_ in held.items():
        mine = np.flatnonzero(own == shard)
        found.append(mine[filter_.hits(codes[mine])])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def positives(words: list[str], filters: dict[int, tuple[int, dict[int, Filter]]]) -> Iterator[tuple[int, str]]:
    """``(position, edit)``: for several equally long words, their edits that the filters let pass."""
    length = len(words[0])
    rows_at_once = max(1, PROBES_AT_ONCE // (length * len(ALPHABET)))
    places_at_once = max(1, PROBES_AT_ONCE // len(ALPHABET))
    for start in range(0, len(words), rows_at_once):
        some = words[start : start + rows_at_once]
        points = code_points(some)
        row, place, code = deletions(points)
        for hit in _probe(code, length - 1, filters):
            word, at = some[row[hit]], int(place[hit])
            yield start + int(row[hit]), word[:at] + word[at + 1 :]
        for first in range(0, length, places_at_once):
            row, place, letter, code = replacements(points, slice(first, min(length, first + places_at_once)))
            for hit in _probe(code, length, filters):
                word, at = some[row[hit]], int(place[hit])
                yield start + int(row[hit]), word[:at] + chr(ALPHABET[letter[hit]]) + word[at + 1 :]


def vocabulary(documents: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of all words of the texts that occur ``LEAST_COUNT`` times; counted per task before the shuffle."""
    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return batch(word=pa.array(list(held), pa.string()), n=pa.array(list(held.values()), pa.int64()))

        for rows in batches:
            for own, said in zip(rows.column("id"), rows.column("text")):
                for word, n in text_words(said.as_py(), own.as_py()).items():
                    held[word] += n
                if len(held) >= COUNTED_AT_ONCE:
                    yield counted()
                    held.clear()
        yield counted()

    counted = source.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _by_length(rows: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    words = rows.column("word").to_pylist()
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        yield length, at, [words[k] for k in at]


def _with_codes(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            codes, classes = np.zeros(rows.num_rows, dtype=np.uint64), np.zeros(rows.num_rows, dtype=np.int32)
            for length, at, some in _by_length(rows):
                step = max(1, PROBES_AT_ONCE // length)
                for start in range(0, len(some), step):
                    codes[at[start : start + step]] = word_codes(code_points(some[start : start + step]))
                classes[at] = min(length, LONGEST_CLASS)
            yield batch(word=rows.column("word"), n=rows.column("n"), code=pa.array(codes.view(np.int64)), length=pa.array(classes))

    return words.mapInArrow(run, "word string, n long, code long, length int")


def plan_rounds(counts: dict[int, int], shard_words: int, round_words: int) -> list[list[tuple[int, int, int, int]]]:
    """Rounds of ``(length, shards, shard, blocks)`` that hold about ``round_words`` words each at most."""
    rounds, held = [[]], 0
    for length, words in sorted(counts.items()):
        shards = max(1, -(-words // shard_words))
        for shard in range(shards):
            share = -(-words // shards)
            if rounds[-1] and held + share > round_words:
                rounds.append([])
                held = 0
            rounds[-1].append((length, shards, shard, Filter.size(share)))
            held += share
    return rounds


def _filters(coded: DataFrame, wanted: list[tuple[int, int, int, int]], shards: dict[int, int]) -> dict[int, tuple[int, dict[int, Filter]]]:
    """The filters of a round. Tasks make the bits of their words, which are joined by block before they come here."""
    blocks = {(length, shard): size for length, _, shard, size in wanted}
    lengths = sorted({length for length, *_ in wanted})

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            codes, own = rows.column("code").to_numpy().view(np.uint64), rows.column("length").to_numpy()
            for length in np.unique(own).tolist():
                here = codes[own == length]
                places = shard_of(here, shards[length]) if shards[length] > 1 else np.zeros(len(here), dtype=np.uint64)
                for shard in np.unique(places).tolist():
                    if (length, shard) not in blocks:
                        continue
                    mine = here[places == shard]
                    at, turned = Filter.block_of(mine, blocks[length, shard]), Filter.turned(mine)
                    yield batch(
                        length=pa.array(np.full(len(mine), length, dtype=np.int32)),
                        shard=pa.array(np.full(len(mine), shard, dtype=np.int32)), block=pa.array(at.astype(np.int64)),
                        **{f"w{n}": pa.array(Filter.bit(turned, n).view(np.int64)) for n in range(8)},
                    )

    fields = ", ".join(f"w{n} long" for n in range(8))
    made = coded.filter(F.col("length").isin(lengths)).select("code", "length").mapInArrow(
        bits, f"length int, shard int, block long, {fields}"
    )
    joined = made.groupBy("length", "shard", "block").agg(*[F.bit_or(f"w{n}").alias(f"w{n}") for n in range(8)])
    # At most ROUND_WORDS * BITS_PER_WORD bits, whatever the vocabulary.
    found = joined.toArrow()
    out: dict[int, tuple[int, dict[int, Filter]]] = {}
    own, places, at = (found.column(c).to_numpy() for c in ("length", "shard", "block"))
    values = np.column_stack([found.column(f"w{n}").to_numpy().view(np.uint64) for n in range(8)])
    for (length, shard), size in blocks.items():
        mine = (own == length) & (places == shard)
        held = np.zeros((size, 8), dtype=np.uint64)
        held[at[mine]] = values[mine]
        out.setdefault(length, (shards[length], {}))[1][shard] = Filter(held)
    return out


def near_words(coded: DataFrame, *, shard_words: int = SHARD_WORDS, round_words: int = ROUND_WORDS) -> DataFrame:
    """``(word, n, near, near_n)`` both ways for all pairs of words that are exactly one edit apart.

    ``coded`` is a vocabulary with codes that is read several times, so it should be a written one.
    """
    spark = coded.sparkSession
    counts = {r["length"]: r["words"] for r in coded.groupBy("length").agg(F.count("*").alias("words")).collect()}
    rounds = plan_rounds(counts, shard_words, round_words)
    shards = {length: total for part in rounds for length, total, *_ in part}
    exact = coded.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = None
    for wanted in rounds:
        filters = spark.sparkContext.broadcast(_filters(coded, wanted, shards) if counts else {})

        def run(batches: Iterator[pa.RecordBatch], filters=filters) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                for _, at, some in _by_length(rows):
                    found = list(positives(some, filters.value))
                    if found:
                        here, edits = zip(*found)
                        yield batch(
                            word=pa.array([some[k] for k in here], pa.string()),
                            n=rows.column("n").take(pa.array(at[list(here)])), near=pa.array(edits, pa.string()),
                        )

        passed = coded.select("word", "n").mapInArrow(run, "word string, n long, near string")
        met = passed.join(exact, "near").select("word", "n", "near", "near_n")
        pairs = met if pairs is None else pairs.unionByName(met)
    return pairs.select(
        F.explode(
            F.array(
                F.struct("word", "n", "near", "near_n"),
                F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
            )
        ).alias("pair")
    ).select("pair.*")


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)``: forms followed to the last. Counts grow along a chain, so doubling its steps soon ends it."""
    chains = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut(chains.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not moved.agg(F.max("moved")).first()[0]:
            return moved.select("word", "root")
        chains = moved.select("word", "root")


def variants(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text",
    shard_words: int = SHARD_WORDS, round_words: int = ROUND_WORDS,
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of the texts of ``documents``.

    ``form`` is the most frequent word one edit away, the smaller of two, if it is ``FORM_FACTOR`` times as frequent, else
    null; ``root`` is where following the forms ends. Null and empty texts have no words; rows with a null id count as
    such with no digits; repeated rows count again; other columns are not read; an empty table gives an empty result.
    """
    coded = cut(_with_codes(vocabulary(documents, id=id, text=text)))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    around = near_words(coded, shard_words=shard_words, round_words=round_words).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best")
    )
    much = -F.col("best.less") >= FORM_FACTOR * F.col("n")
    judged = cut(
        coded.select("word", "n").join(around, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(much, F.col("best.near")).alias("form"), F.when(much, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
