"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text, their beginnings of four to eight letters, and the beginnings that several
different words share; each is hashed to one of ``BUCKETS``. Buckets that tell the two labels apart in the training sample,
alone or as one of a pair, keep a weight and a vector; the score of a text is the logistic function of all weights plus the
inner products of all pairs of vectors, so two terms that are harmless apart can be toxic together.
"""

from __future__ import annotations

import io
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsense.llm.common import batch

# The machine is fitted in one task on about so many labelled rows at most, chosen by hashed ids.
TRAIN_ROWS = 20_000
FOLDS = 5
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 7, 8)
# A bucket is kept for what it says alone if it is in so many texts and among the best of so many; what pairs say is looked at
# among the buckets that vary most, and both buckets of a pair are kept whose texts are so many deviations from what the two
# say apart.
KEPT_BUCKETS = 4096
LEAST_SUPPORT = 3
PAIRED_BUCKETS = 1024
PAIR_DEVIATIONS = 6.0
FACTORS = 8
EPOCHS = 30
BATCH = 256
RATE = 0.1
PENALTY = 1e-4
SEED = 7
THRESHOLD = 0.5
_CACHE_WORDS = 400_000

_WORDS = re.compile(r"[^\W\d_]+")


def _bucket(term: str) -> int:
    return xxhash.xxh64_intdigest(term) & (BUCKETS - 1)


def held_out(id: Column, folds: int = FOLDS) -> Column:
    """Whether a row's label is kept from training; null ids count as the empty text."""
    return F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")) % folds == 0


class Terms:
    """Buckets of a text; words seen before are looked up."""

    def __init__(self, wanted: frozenset[int] | None = None):
        self.wanted = wanted
        self.known: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}

    def _of_word(self, word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """The word's own bucket, and those of its beginnings."""
        if len(self.known) > _CACHE_WORDS:
            self.known.clear()
        whole = (_bucket("w " + word),)
        begins = tuple(_bucket(f"p {word[:n]}") for n in PREFIXES if len(word) >= n)
        if self.wanted is not None:
            whole = tuple(b for b in whole if b in self.wanted)
            begins = tuple(b for b in begins if b in self.wanted or shared(b) in self.wanted)
        self.known[word] = whole, begins
        return whole, begins

    def __call__(self, text: str | None) -> list[int]:
        found: set[int] = set()
        begun: Counter[int] = Counter()
        for word in set(_WORDS.findall(text.lower())) if text else ():
            whole, begins = self.known.get(word) or self._of_word(word)
            found.update(whole)
            if begins:
                begun.update(begins)
        found.update(begun)
        found.update(shared(b) for b, n in begun.items() if n > 1)
        return sorted(found if self.wanted is None else found & self.wanted)


def shared(bucket: int) -> int:
    """The bucket for a beginning that several words have."""
    return (bucket * 0x9E3779B1 + 0x7F4A7C15) & (BUCKETS - 1)


class Machine:
    """A fitted factorization machine on chosen buckets."""

    def __init__(self, buckets: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.buckets, self.bias, self.weights, self.vectors = buckets, bias, weights, vectors

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        """Between 0 and 1 for each list of buckets; buckets without weight count nothing."""
        sizes = np.array([len(r) for r in rows], dtype=np.int64)
        flat = np.array([b for r in rows for b in r], dtype=np.int64)
        at = np.minimum(np.searchsorted(self.buckets, flat), max(0, len(self.buckets) - 1))
        known = self.buckets[at] == flat if len(self.buckets) else np.zeros(len(flat), dtype=bool)
        owner = np.repeat(np.arange(len(rows)), sizes)[known]
        margin, _ = _margins(self.bias, self.weights, self.vectors, at[known], owner, len(rows))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))

    def to_bytes(self) -> bytes:
        sink = io.BytesIO()
        np.savez(sink, buckets=self.buckets, bias=self.bias, weights=self.weights, vectors=self.vectors)
        return sink.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Machine:
        with np.load(io.BytesIO(data)) as held:
            return cls(held["buckets"], float(held["bias"]), held["weights"], held["vectors"])


def _margins(bias, weights, vectors, terms, owner, rows):
    """Margins, and per row the sums of its terms' vectors."""
    sums = np.zeros((rows, vectors.shape[1]))
    np.add.at(sums, owner, vectors[terms])
    squares = np.bincount(owner, (vectors[terms] ** 2).sum(axis=1), rows)
    return bias + np.bincount(owner, weights[terms], rows) + 0.5 * ((sums**2).sum(axis=1) - squares), sums


def choose(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The buckets with the largest signed deviation between the labels, and those of pairs that say more than they do."""
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)
    toxic = np.repeat(labels, [len(r) for r in rows]) if rows else np.zeros(0)
    seen = np.bincount(flat, minlength=BUCKETS)
    bad = np.bincount(flat, weights=toxic, minlength=BUCKETS)
    rate = labels.mean() if len(labels) else 0.0
    spread = np.sqrt(np.maximum(seen * rate * (1 - rate), 1e-9)) + 1
    away = np.where(seen >= LEAST_SUPPORT, np.abs(bad - seen * rate) / spread, 0)
    best = np.argsort(-away, kind="stable")[:KEPT_BUCKETS]
    return np.union1d(best[away[best] > 1], paired(rows, labels, seen, bad, rate))


def paired(rows: list[np.ndarray], labels: np.ndarray, seen: np.ndarray, bad: np.ndarray, rate: float) -> np.ndarray:
    """Buckets of pairs whose texts are labelled otherwise than the two buckets let expect when their effects are added."""
    varied = np.argsort(-seen * (len(rows) - seen), kind="stable")[:PAIRED_BUCKETS]
    varied = np.sort(varied[(seen[varied] >= LEAST_SUPPORT) & (seen[varied] < len(rows))])
    if not len(varied) or rate in (0.0, 1.0):
        return varied[:0]
    both, toxic = np.zeros((len(varied), len(varied))), np.zeros((len(varied), len(varied)))
    for start in range(0, len(rows), BATCH * 8):
        some = rows[start : start + BATCH * 8]
        held = np.zeros((len(some), len(varied)), dtype=np.float32)
        for at, row in enumerate(some):
            place = np.minimum(np.searchsorted(varied, row), len(varied) - 1)
            held[at, place[varied[place] == row]] = 1
        both += held.T @ held
        toxic += held.T @ (held * labels[start : start + len(some), None].astype(np.float32))
    own = bad[varied] / seen[varied]
    expected = np.clip(own[:, None] + own[None, :] - rate, 0, 1) * both
    away = np.abs(toxic - expected) / (np.sqrt(both * rate * (1 - rate)) + 1)
    np.fill_diagonal(away, 0)
    return varied[away.max(axis=1) > PAIR_DEVIATIONS]


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Logistic loss by AdaGrad steps over shuffled batches; without both labels everything scores the known one's side."""
    buckets = choose(rows, labels)
    rng = np.random.default_rng(SEED)
    weights, vectors = np.zeros(len(buckets)), rng.normal(0, 0.05, (len(buckets), FACTORS))
    rate = (labels.sum() + 0.5) / (len(labels) + 10)
    bias = float(np.log(rate / (1 - rate)))
    if not len(buckets):
        return Machine(buckets, bias, weights, vectors)
    held = []
    for row in rows:
        at = np.minimum(np.searchsorted(buckets, row), len(buckets) - 1)
        held.append(at[buckets[at] == row])
    sizes = np.array([len(h) for h in held])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(held)
    total_w, total_v, total_b = np.full(len(weights), 1e-6), np.full(vectors.shape, 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(held))
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            terms = np.concatenate([flat[starts[c] : starts[c + 1]] for c in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes[chosen])
            margin, sums = _margins(bias, weights, vectors, terms, owner, len(chosen))
            error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]
            each = error[owner]
            grad_w = np.bincount(terms, each, len(weights)) / len(chosen) + PENALTY * weights
            grad_v = np.zeros_like(vectors)
            np.add.at(grad_v, terms, each[:, None] * (sums[owner] - vectors[terms]))
            grad_v = grad_v / len(chosen) + PENALTY * vectors
            grad_b = float(error.mean())
            total_w += grad_w**2
            total_v += grad_v**2
            total_b += grad_b**2
            weights -= RATE * grad_w / np.sqrt(total_w)
            vectors -= RATE * grad_v / np.sqrt(total_v)
            bias -= RATE * grad_b / total_b**0.5
    return Machine(buckets, bias, weights, vectors)


def train(documents: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", train_rows: int = TRAIN_ROWS) -> Machine:
    """A machine from labelled ids that are not held out, about ``train_rows`` of them if there are more.

    Which ones, their hash decides; ids with several labels count as labelled if any of them is 1, and of several texts of an
    id the smallest is taken. Rows without a label are left out.
    """
    known = labels.select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label")).filter(
        F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_id"))
    ).groupBy("_id").agg(F.max("_label").alias("_label"))
    share = min(1.0, train_rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # About train_rows rows of two numbers are broadcast, whatever the input.
    labelled = documents.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("text")).join(
        F.broadcast(chosen), "_id"
    ).groupBy("_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.max("_label").alias("_label"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Terms()
        for rows in batches:
            found = [np.array(of(t.as_py()), dtype=np.int32) for t in rows.column("text")]
            yield batch(
                id=rows.column("_id"), label=rows.column("_label"),
                terms=pa.array([f.tobytes() for f in found], pa.binary()),
            )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for held in batches:
            rows += zip(held.column("id").to_pylist(), held.column("terms").to_pylist(), held.column("label").to_pylist())
        rows.sort()
        machine = fit([np.frombuffer(t, dtype=np.int32) for _, t, _ in rows], np.array([y for _, _, y in rows], dtype=float))
        yield batch(machine=pa.array([machine.to_bytes()], pa.binary()))

    found = labelled.mapInArrow(terms, "id long, label int, terms binary")
    return Machine.from_bytes(bytes(found.repartition(1).mapInArrow(learn, "machine binary").first()["machine"]))


def score(documents: DataFrame, machine: Machine, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, _text_hash, score)`` for every row. Null and empty texts have the score of no terms; null ids and repeated
    rows stay; other columns are not read."""
    wanted = frozenset(machine.buckets.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(wanted)
        for rows in batches:
            scores = machine.scores([terms(t.as_py()) for t in rows.column("text")])
            yield batch(id=rows.column("id"), _text_hash=rows.column("_text_hash"), score=pa.array(scores, pa.float64()))

    source = documents.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    hashed = source.withColumn("_text_hash", F.xxhash64(F.coalesce("text", F.lit("\0"))))
    return hashed.mapInArrow(run, "id long, _text_hash long, score double")


def keep_harmless(documents: DataFrame, machine: Machine, *, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` whose score is below ``threshold``, in one pass without a shuffle."""
    wanted = frozenset(machine.buckets.tolist())
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(wanted)
        for rows in batches:
            scores = machine.scores([terms(t) for t in rows.column(at).to_pylist()])
            yield rows.filter(pa.array(scores < threshold))

    return documents.mapInArrow(run, documents.schema)
