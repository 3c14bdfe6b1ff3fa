"""Benchmark passages in documents, by latent semantic retrieval and an exact check.

Texts are cut into passages of ``CHUNK_WORDS`` words and weighed by TF-IDF over the words that occur in the benchmark; other
words cannot add to any similarity with it. A randomised SVD of the matrix of all passages, to which the benchmark's own
are added with equal weight in sum, gives a latent space: every partition multiplies its rows with a random matrix and
back, the products are added up, and a Nystroem step turns the sum into singular vectors. Windows of
passages, each as long as the item needs, are compared with all benchmark items by cosine there, which is how paraphrases are
found. For every candidate the longest common subsequence of words decides, with a look at the item's answer where it is a
paraphrase.

Copies do not hang on the cosine: a place that holds a copy's share of an item's words holds some of its rarest ones, so an
index of those gives every copy (``Rare``), whatever rank, window and weights are. Items too short for either are
matched as phrases.

The benchmark is the stated query set. Documents are encoded once, against the words of the whole benchmark; it is searched
in blocks of about ``BLOCK_WORDS`` words, each in one job, so what goes to the executors is bounded. Nothing of the
documents is gathered but sums over terms. Long texts are worked on in runs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch, cut

CHUNK_WORDS = 24
SEGMENT_WORDS = 72
RANK = 64
OVERSAMPLE = 16
# The least IDF of a term; none is without weight, however common.
LEAST_WEIGHT = 0.05
# Of the words that a copy needs at least, this share must be among the item's rarest ones.
RARE_SHARE = 0.4
LEAST_COSINE = 0.55
# Shares of an item's words, in order: a copy, and a paraphrase that must hold the answer too.
COPY_SHARE = 0.7
PARAPHRASE_SHARE = 0.5
ANSWER_SHARE = 0.5
ANSWER_WORDS = 8
# Shorter items are matched as phrases, word by word; those below the second figure say too little to be told from chance.
LEAST_ITEM_WORDS = 8
LEAST_PHRASE_WORDS = 4
BLOCK_WORDS = 50_000
# The words of the whole benchmark go to every executor.
MOST_TERMS = 5_000_000
TERMS_PER_ROW = 64
DOCUMENTS_AT_ONCE = 32
# Words of documents that are projected, and cosines that are held, at a time.
WORDS_AT_ONCE = 1 << 16
COSINES_AT_ONCE = 1 << 22
SEED = 5

_WORDS = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


@dataclass
class Item:
    """A benchmark item by word numbers; ``answer`` counts the words of its answer."""

    id: int
    words: list[int]
    answer: Counter

    def __post_init__(self) -> None:
        self.places: dict[int, int] = {}
        for at, word in enumerate(self.words):
            self.places[word] = self.places.get(word, 0) | 1 << at

        self.sorted = np.array(sorted(self.places), dtype=np.int32)
        self.phrase = len(self.words) < LEAST_ITEM_WORDS
        self.span = len(self.words) if self.phrase else len(self.words) + len(self.words) // 4 + 4

    def of_item(self, words: np.ndarray) -> np.ndarray:
        """Which of ``words`` the item has."""
        at = np.minimum(np.searchsorted(self.sorted, words), len(self.sorted) - 1)
        return self.sorted[at] == words

    def common(self, words: list[int]) -> int:
        """Length of the longest common subsequence with ``words``, a bit for each word of the item."""
        full = (1 << len(self.words)) - 1
        row = full
        for word in words:
            hit = row & self.places[word]
            row = ((row + hit) | (row - hit)) & full
        return len(self.words) - row.bit_count()

    def best(self, words: np.ndarray, places: np.ndarray) -> tuple[float, int, bool]:
        """The best share of the item's words found in order in a span of a quarter more than its length; where it first
        starts; whether the answer is there. Of a phrase, all words must stand one behind the other."""
        length = len(self.words)
        if self.phrase:
            return self._as_phrase(words, places)
        top, start, answered = 0, -1, False
        ends = np.searchsorted(places, places + self.span)
        needed = int(np.ceil(PARAPHRASE_SHARE * length))
        starts = np.flatnonzero(ends - np.arange(len(places)) >= needed)
        at = 0
        while at < len(starts):
            low = int(starts[at])
            here = words[low : ends[low]].tolist()
            count = self.common(here)
            if count >= needed:
                found = Counter(here)
                answer = sum(min(n, found[w]) for w, n in self.answer.items())
                top, start, answered = count, int(places[low]), answer >= ANSWER_SHARE * self.answer.total()
                needed = count + 1
            # A later span has at most as many in common as this one, and one more for every word that it adds.
            at = max(at + 1, int(np.searchsorted(ends[starts], ends[low] + needed - count)))
        return top / length, start, answered

    def _as_phrase(self, words: np.ndarray, places: np.ndarray) -> tuple[float, int, bool]:
        length = len(self.words)
        for low in np.flatnonzero(words == self.words[0]).tolist():
            if words[low : low + length].tolist() == self.words and places[low + length - 1] - places[low] == length - 1:
                return 1.0, int(places[low]), True
        return 0.0, -1, False


class Block:
    """A block of the benchmark: its vocabulary, its items and their passages."""

    def __init__(self, rows: list):
        self.vocabulary: dict[str, int] = {}
        self.items: list[Item] = []
        for row in rows:
            said = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(row["text"])]
            if len(said) < LEAST_PHRASE_WORDS:
                continue
            answer = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(row["answer"])] or said[-ANSWER_WORDS:]
            self.items.append(Item(row["id"], said, Counter(answer)))
        self.segments = [
            (number, item.words[at : at + SEGMENT_WORDS])
            for number, item in enumerate(self.items)
            for at in range(0, max(1, len(item.words) - SEGMENT_WORDS // 2), SEGMENT_WORDS)
            if not item.phrase
        ]
        self.owner = np.array([number for number, _ in self.segments], dtype=np.int64)
        # A passage lies within so many chunks, wherever it begins.
        self.window = np.array([1 + -(-len(said) // CHUNK_WORDS) for _, said in self.segments], dtype=np.int64)

    def local(self, numbers: dict[str, int]) -> np.ndarray:
        """For the numbers of all words of the benchmark those in the block, -1 for others."""
        out = np.full(len(numbers), -1, dtype=np.int32)
        for word, number in self.vocabulary.items():
            out[numbers[word]] = number
        return out

    def segment_rows(self, idf: np.ndarray) -> np.ndarray:
        """TF-IDF of the items' passages, of unit length."""
        rows = np.zeros((len(self.segments), len(self.vocabulary)))
        for at, (_, said) in enumerate(self.segments):
            np.add.at(rows[at], said, 1.0)
        rows *= idf
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


class Rare:
    """Index of the rarest words of each item, for finding every document part that can hold a copy of it.

    Of ``n`` words an item needs ``t`` in one span. Any ``n - t + j`` of its words then have ``j`` there, and the rarest are
    taken.
    """

    def __init__(self, items: list[Item], idf: np.ndarray):
        self.needed = np.ones(len(items), dtype=np.int64)
        self.spans = np.array([item.span for item in items], dtype=np.int64)
        pairs = []
        for number, item in enumerate(items):
            least = len(item.words) if item.phrase else int(np.ceil(COPY_SHARE * len(item.words)))
            self.needed[number] = max(1, int(RARE_SHARE * least))
            said = np.array(item.words)
            rarest = said[np.argsort(-idf[said], kind="stable")[: len(said) - least + self.needed[number]]]
            pairs += [(term, number) for term in np.unique(rarest).tolist()]
        terms, self.owners = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2).T
        self.starts = np.searchsorted(terms, np.arange(len(idf) + 1))

    def candidates(self, document: np.ndarray, place: np.ndarray, term: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """By document and item, from which place to which it can be; words come in the order of documents and places."""
        times = self.starts[term + 1] - self.starts[term]
        at = np.repeat(np.arange(len(term)), times)
        before = np.cumsum(times) - times
        item = self.owners[np.arange(len(at)) + np.repeat(self.starts[term] - before, times)]
        key = document[at] * len(self.needed) + item
        order = np.argsort(key, kind="stable")
        key, item, place = key[order], item[order], place[at[order]].astype(np.int64)
        last = np.arange(len(key)) + self.needed[item] - 1
        inside = last < len(key)
        first, last = np.flatnonzero(inside), last[inside]
        held = (key[first] == key[last]) & (place[last] - place[first] < self.spans[item[first]])
        first, last = first[held], last[held]
        keys, starts = np.unique(key[first], return_index=True)
        if not len(keys):
            return {}
        ends = np.concatenate([starts[1:], [len(first)]]) - 1
        spans = self.spans[item[first[starts]]]
        low, high = place[first[starts]] - spans, place[last[ends]] + spans
        return {divmod(k, len(self.needed)): (a, b) for k, a, b in zip(keys.tolist(), low.tolist(), high.tolist())}


@dataclass
class Space:
    """The latent space: ``directions`` maps term weights to coordinates, ``values`` are the singular values."""

    idf: np.ndarray
    directions: np.ndarray
    values: np.ndarray


def _encode(documents: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Per document the numbers of its words that the benchmark has, and where they stand; others fall out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sizes, places, terms = [], [], []
            for text in rows.column("text"):
                said = words_of(text.as_py())
                numbers = np.fromiter(map(vocabulary.get, said, repeat(-1)), dtype=np.int32, count=len(said))
                at = np.flatnonzero(numbers >= 0).astype(np.int32)
                sizes.append(len(said))
                places.append(at.tobytes())
                terms.append(numbers[at].tobytes())
            yield batch(
                id=rows.column("id"), _text_hash=rows.column("_text_hash"), size=pa.array(sizes, pa.int64()),
                places=pa.array(places, pa.binary()), terms=pa.array(terms, pa.binary()),
            )

    return documents.mapInArrow(run, "id long, _text_hash long, size long, places binary, terms binary")


def _decoded(batches: Iterator[pa.RecordBatch], local: np.ndarray) -> Iterator[tuple]:
    """Of a few documents at a time: ids, hashes, per document its places and terms, and all chunks in one numbering."""
    for many in batches:
        for start in range(0, many.num_rows, DOCUMENTS_AT_ONCE):
            rows = many.slice(start, DOCUMENTS_AT_ONCE)
            places = [np.frombuffer(p, dtype=np.int32) for p in rows.column("places").to_pylist()]
            terms = [local[np.frombuffer(t, dtype=np.int32)] for t in rows.column("terms").to_pylist()]
            places = [p[t >= 0] for p, t in zip(places, terms)]
            terms = [t[t >= 0] for t in terms]
            chunks = -(-rows.column("size").to_numpy() // CHUNK_WORDS)
            first = np.concatenate([[0], np.cumsum(chunks)])
            chunk = np.concatenate([f + p // CHUNK_WORDS for f, p in zip(first, places)])
            yield rows.column("id").to_pylist(), rows.column("_text_hash").to_pylist(), places, terms, first, chunk, np.concatenate(terms)


def _sparse(chunk: np.ndarray, term: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, terms and TF-IDF weights of chunks."""
    keys, counts = np.unique(chunk.astype(np.int64) * len(idf) + term, return_counts=True)
    return keys // len(idf), keys % len(idf), (counts * idf[keys % len(idf)]).astype(np.float32)


def _weighed(rows: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The chosen rows, each times its weight."""
    chosen = rows[at]
    chosen *= weight[:, None]
    return chosen


def _runs(row: np.ndarray) -> Iterator[slice]:
    """Parts of sorted rows, of about ``WORDS_AT_ONCE`` entries, that cut no row."""
    start = 0
    while start < len(row):
        end = start + WORDS_AT_ONCE
        end = int(np.searchsorted(row, row[end])) if end < len(row) else len(row)
        if end == start:  # one row fills it
            end = int(np.searchsorted(row, row[start], side="right"))
        yield slice(start, end)
        start = end


def _sums(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of rows with equal keys; the keys are sorted."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(rows, starts, axis=0)


def _inverse_frequency(encoded: DataFrame, local: np.ndarray, terms: int) -> tuple[np.ndarray, int]:
    """IDF over all passages of all documents, and the number of passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, passages = np.zeros(terms, dtype=np.int64), 0
        for *_, first, chunk, term in _decoded(batches, local):
            keys = np.unique(chunk.astype(np.int64) * terms + term)
            seen += np.bincount(keys % terms, minlength=terms)
            passages += int(first[-1])
        known = np.flatnonzero(seen)
        yield batch(term=pa.array([-1, *known.tolist()], pa.int32()), n=pa.array([passages, *seen[known].tolist()], pa.int64()))

    counts = {r["term"]: r["n"] for r in encoded.mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    passages = counts.pop(-1, 0)
    found = np.zeros(terms)
    found[list(counts)] = list(counts.values())
    return np.maximum(np.log((passages + 1) / (found + 1)), LEAST_WEIGHT), passages


def _latent_space(encoded: DataFrame, block: Block, local: np.ndarray, rank: int) -> Space:
    """Singular vectors of the passages of documents and benchmark, from one product with a random matrix."""
    terms = len(block.vocabulary)
    idf, passages = _inverse_frequency(encoded, local, terms)
    width = min(terms, rank + OVERSAMPLE)
    random = np.random.default_rng(SEED).standard_normal((terms, width)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms, width))
        for *_, chunk, term in _decoded(batches, local):
            rows, columns, weights = _sparse(chunk, term, idf)
            for run in _runs(rows):
                _, row = np.unique(rows[run], return_inverse=True)
                column, weight = columns[run], weights[run]
                weight = weight / np.sqrt(np.bincount(row, weight.astype(float) ** 2))[row].astype(np.float32)
                _, sketch = _sums(row, _weighed(random, column, weight))
                order = np.argsort(column, kind="stable")
                touched, added = _sums(column[order], _weighed(sketch, row[order], weight[order]))
                total[touched] += added
        for start in range(0, terms, TERMS_PER_ROW):
            part = total[start : start + TERMS_PER_ROW]
            if part.any():
                yield batch(start=pa.array([start], pa.int32()), part=pa.array([part.tobytes()], pa.binary()))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for rows in batches:
            for start, part in zip(rows.column("start").to_pylist(), rows.column("part").to_pylist()):
                values = np.frombuffer(part)
                held[start] = held[start] + values if start in held else values
        for start, values in held.items():
            yield batch(start=pa.array([start], pa.int32()), part=pa.array([values.tobytes()], pa.binary()))

    parts = encoded.mapInArrow(run, "start int, part binary").repartition(F.col("start")).mapInArrow(add, "start int, part binary")
    product = np.zeros((terms, width))
    for row in parts.collect():  # the vocabulary of a block times the width of the sketch
        values = np.frombuffer(row["part"]).reshape(-1, width)
        product[row["start"] : row["start"] + len(values)] = values
    own = block.segment_rows(idf)
    product += max(1, passages) / max(1, len(own)) * (own.T @ (own @ random))
    return Space(idf, *_nystroem(product, random.astype(float), rank))


def _nystroem(product: np.ndarray, random: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvectors of a positive matrix, and the roots of its eigenvalues, from its product with ``random``."""
    shift = 1e-9 * max(np.linalg.norm(product), 1e-30)
    shifted = product + shift * random
    core = random.T @ shifted
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    usable = values > values.max(initial=0) * 1e-12
    half = shifted @ (vectors[:, usable] / np.sqrt(values[usable]))
    left, sizes, _ = np.linalg.svd(half, full_matrices=False)
    real = np.sqrt(np.maximum(sizes**2 - shift, 0))[:rank]
    return left[:, :rank][:, real > 0], real[real > 0]


def _projected(chunk: np.ndarray, term: np.ndarray, chunks: int, onto: np.ndarray) -> np.ndarray:
    """Latent sums of all chunks."""
    held = np.zeros((chunks, onto.shape[1]), dtype=np.float32)
    row, column, counts = _sparse(chunk, term, np.ones(len(onto)))
    for run in _runs(row):
        touched, sums = _sums(row[run], _weighed(onto, column[run], counts[run]))
        held[touched] = sums
    return held


def _windows(held: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Unit vectors of the ``size`` chunks from each chunk on, within its document."""
    last = np.repeat(first[1:], np.diff(first))
    window = held.copy()
    for ahead in range(1, size):
        inside = np.flatnonzero(np.arange(len(held)) + ahead < last)
        window[inside] += held[inside + ahead]
    return window / np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-12)


def _matches(encoded: DataFrame, block: Block, local: np.ndarray, space: Space, least_cosine: float) -> DataFrame:
    onto = (space.directions * space.idf[:, None]).astype(np.float32)
    own = block.segment_rows(space.idf) @ space.directions
    own = (own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    items, rare, sizes = block.items, Rare(block.items, space.idf), np.unique(block.window).tolist()
    owner, window_of = block.owner, block.window
    lengths = np.array([len(item.words) for item in items], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, places, said, first, chunk, term in _decoded(batches, local):
            if not len(term):
                continue
            held = _projected(chunk, term, int(first[-1]), onto)
            document = np.repeat(np.arange(len(ids)), np.diff(first))
            candidates = rare.candidates(np.repeat(np.arange(len(ids)), [len(p) for p in places]), np.concatenate(places), term)
            windows = {}
            for size in sizes:
                mine = np.flatnonzero(window_of == size)
                windows[size] = _windows(held, first, size)
                step = max(1, COSINES_AT_ONCE // len(mine))
                for start in range(0, len(held), step):
                    near, segment = np.nonzero(windows[size][start : start + step] @ own[mine].T >= least_cosine)
                    at, of = near + start, owner[mine[segment]]
                    begin = (at - first[document[at]]) * CHUNK_WORDS
                    order = np.argsort(key := document[at] * len(items) + of, kind="stable")
                    keys, edges = np.unique(key[order], return_index=True)
                    if not len(keys):
                        continue
                    low = np.minimum.reduceat((begin - lengths[of])[order], edges)
                    high = np.maximum.reduceat((begin + CHUNK_WORDS * size + lengths[of])[order], edges)
                    for one, a, b in zip(keys.tolist(), low.tolist(), high.tolist()):
                        pair = divmod(one, len(items))
                        before = candidates.get(pair, (a, b))
                        candidates[pair] = (min(a, before[0]), max(b, before[1]))
            best: dict[tuple[int, int], tuple] = {}
            for (d, number), reach in candidates.items():
                item = items[number]
                low, high = np.searchsorted(places[d], reach)
                inside = np.flatnonzero(item.of_item(said[d][low:high])) + low
                if len(inside) < PARAPHRASE_SHARE * len(item.words):
                    continue
                share, start, answered = item.best(said[d][inside], places[d][inside])
                if share >= COPY_SHARE or share >= PARAPHRASE_SHARE and answered:
                    cosine = None if item.phrase else 0.0
                    for segment in np.flatnonzero(owner == number):
                        at, size = int(first[d]) + start // CHUNK_WORDS, int(window_of[segment])
                        around = windows[size][max(int(first[d]), at - size + 1) : at + 1] @ own[segment]
                        cosine = max(cosine, float(around.max()))
                    best[d, number] = (share, cosine, start)
            if best:
                yield batch(
                    id=pa.array([ids[d] for d, _ in best], pa.int64()), _text_hash=pa.array([hashes[d] for d, _ in best], pa.int64()),
                    item_id=pa.array([items[n].id for _, n in best], pa.int64()),
                    share=pa.array([v[0] for v in best.values()], pa.float64()), cosine=pa.array([v[1] for v in best.values()], pa.float64()),
                    start_word=pa.array([v[2] for v in best.values()], pa.int64()),
                )

    return encoded.mapInArrow(run, "id long, _text_hash long, item_id long, share double, cosine double, start_word long")


def _benchmark(items: DataFrame, id: str, text: str, answer: str | None) -> DataFrame:
    return items.select(
        F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
        (F.col(answer).cast("string") if answer else F.lit(None).cast("string")).alias("answer"),
    )


def _vocabulary(known: DataFrame) -> dict[str, int]:
    """A number for every word of the benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = {w for column in ("text", "answer") for t in rows.column(column) for w in words_of(t.as_py())}
            yield batch(word=pa.array(sorted(found), pa.string()))

    words = known.mapInArrow(run, "word string").distinct().limit(MOST_TERMS + 1).collect()
    if len(words) > MOST_TERMS:
        raise ValueError(f"the benchmark has more than {MOST_TERMS} different words; search it in parts")
    return {word: number for number, word in enumerate(sorted(row["word"] for row in words))}


def _blocks(known: DataFrame, block_words: int) -> Iterator[Block]:
    total = known.agg(F.sum(F.regexp_count("text", F.lit(r"\w+")))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for number in range(blocks):
        rows = known.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == number).orderBy("id", "text").collect()
        block = Block(rows)
        if block.items:
            yield block


def contaminated(
    documents: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", item_answer: str | None = None,
    rank: int = RANK, least_cosine: float = LEAST_COSINE, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``(id, _text_hash, item_id, share, cosine, start_word)``: which documents hold which benchmark items.

    ``share`` of the item's words stand in order from word ``start_word`` on. Without an answer column the last
    ``ANSWER_WORDS`` words of an item count as its answer. Items of fewer than ``LEAST_ITEM_WORDS`` words are found as whole
    phrases only (without a cosine), those of fewer than ``LEAST_PHRASE_WORDS`` never. Null and empty texts hold nothing,
    null ids and repeated rows stay, other columns are not read.
    """
    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).withColumn(
        "_text_hash", F.xxhash64(F.coalesce("text", F.lit("\0")))
    )
    known = _benchmark(items, item_id, item_text, item_answer)
    numbers = _vocabulary(known)
    encoded = cut(_encode(source, numbers)) if numbers else None
    found = None
    for block in _blocks(known, block_words):
        local = block.local(numbers)
        space = _latent_space(encoded, block, local, rank)
        part = _matches(encoded, block, local, space, least_cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return source.limit(0).select(
            "id", "_text_hash", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("share"),
            F.lit(0.0).alias("cosine"), F.lit(0).cast("long").alias("start_word"),
        )
    return found


def keep_clean(documents: DataFrame, items: DataFrame, *, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item."""
    held = contaminated(documents, items, id=id, text=text, **options).select(
        F.col("id").alias("_id"), F.col("_text_hash").alias("_hash")
    ).distinct()
    keyed = documents.select(
        F.struct("*").alias("row"), F.col(id).cast("long").alias("_row_id"),
        F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("\0"))).alias("_row_hash"),
    )
    return keyed.join(
        held, F.col("_row_id").eqNullSafe(F.col("_id")) & (F.col("_row_hash") == F.col("_hash")), "left_anti"
    ).select("row.*")
