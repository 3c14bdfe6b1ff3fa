"""A mix of sources by target weights, in fixed-length blocks.

The documents of a source, in a pseudorandom order, form one stream of words, read twice in a row and cut into blocks of
``BLOCK_WORDS``. The target gives every source its number of output slots. Output shards draw how many of their slots
come from which source: a multinomial draw under the condition that all shards together use exactly the slots of each
source, made by halving the range of shards again and again, so every shard finds its own counts from seeds alone. Slot
numbers go through one pseudorandom permutation per source and reading, which keeps the second reading for after the
first, and blocks and slots meet in a join on the block number. Positions in the streams are prefix sums in two steps,
so a source with most of the rows is spread over many tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripsense.llm.common import batch, cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 1024
SLOTS_PER_SHARD = 256
ROWS_PER_BUCKET = 50_000
LEAST_BUCKETS = 256
# Targets and draws go over all sources in one task, so their number is bounded.
MOST_SOURCES = 10_000
SEED = 20_240_229
_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = re.compile(_WORD)
_EXACT_DRAW = 500_000_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``(source, number, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources by code point, null last, weigh as ``weights`` repeated, and share ``share`` times all words. No target is
    above ``MOST_REPEATS`` times its source; what that leaves over goes to the others by weight. With the sources sorted
    by the level at which they are full, the common level follows from sums over those before and after.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    limit = F.col("source_size") * MOST_REPEATS
    weighed = sizes.select("source", "source_size", rank.alias("number")).withColumn(
        "weight", F.array(*[F.lit(float(w)) for w in weights])[F.col("number") % len(weights)]
    ).withColumn("full_at", limit / F.col("weight"))
    by_level = Window.orderBy("full_at", "number")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(F.desc("full_at"), F.desc("number")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = weighed.withColumn(
        "level",
        (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(limit).over(before), F.lit(0)))
        / F.sum("weight").over(after),
    )
    common = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "number", "level"))).over(everything)
    return levels.select(
        "source", "number", "source_size",
        F.least(limit.cast("double"), F.coalesce(common["level"], F.lit(float("inf"))) * F.col("weight")).alias("target"),
    )


def _positions(sized: DataFrame, buckets: int) -> DataFrame:
    """``start``: the words of the row's source that come before it, in an order made of buckets of hashed ids."""
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64(F.lit("mix"), "id", "_text_hash"), F.lit(buckets)))
    totals = dealt.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("number", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("number", "bucket").orderBy("id", "_text_hash").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        offsets, ["number", "bucket"]
    ).withColumn("start", F.col("offset") + F.col("inside")).drop("bucket", "offset", "inside")


def _draw(rng: np.random.Generator, counts: np.ndarray, take: int) -> np.ndarray:
    """How many of ``take`` slots out of ``counts`` per source fall to the left half, without putting back."""
    taken = np.zeros_like(counts)
    left, rest = take, int(counts.sum())
    for k, count in enumerate(counts.tolist()):
        rest -= count
        least, most = max(0, left - rest), min(count, left)
        if least == most:
            taken[k] = least
        elif count + rest <= _EXACT_DRAW:
            taken[k] = rng.hypergeometric(count, rest, left)
        else:  # beyond numpy's range the normal limit is as good as exact
            p = count / (count + rest)
            spread = (left * p * (1 - p) * rest / (count + rest)) ** 0.5
            taken[k] = min(most, max(least, round(left * p + spread * rng.standard_normal())))
        left -= int(taken[k])
    return taken


def shard_counts(slots: np.ndarray, shard: int, shards: int, per_shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The shard's number of slots per source, and how many slots of each source all shards before it use."""
    low, high, counts, before = 0, shards, slots.copy(), np.zeros_like(slots)
    while high - low > 1:
        middle = (low + high) // 2
        size = min((middle - low) * per_shard, int(counts.sum()))
        left = _draw(np.random.default_rng([seed, low, high]), counts, size)
        if shard < middle:
            high, counts = middle, left
        else:
            low, before, counts = middle, before + left, counts - left
    return counts, before


def permute(values: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A pseudorandom permutation of 0 to size - 1: a four-round Feistel network, walked until inside the range."""
    if size <= 1:
        return values.copy()
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = values.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for turn in range(4):
            mixed = (right + np.uint64((seed * 1_000_003 + turn * 7_919) % (1 << 63))) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            left, right = right, left ^ (mixed & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= size
    return out.astype(np.int64)


def _slots(spark, sources: list, block_words: int, per_shard: int, seed: int) -> DataFrame:
    """``(number, block, shard, slot, take)``: which block of which source fills which slot, and its words used."""
    sizes = [int(s["source_size"]) for s in sources]
    goal = [int(round(s["target"])) for s in sources]
    slots = np.array([-(-g // block_words) for g in goal], dtype=np.int64)
    shards = max(1, -(-int(slots.sum()) // per_shard))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for shard in rows.column("id").to_pylist():
                counts, before = shard_counts(slots, shard, shards, per_shard, seed)
                number = np.repeat(np.arange(len(slots)), counts)
                own = np.concatenate([np.arange(b, b + c) for b, c in zip(before, counts)]) if len(counts) else number
                block, take = np.empty_like(own), np.full(len(own), block_words)
                for k in np.unique(number):
                    here = number == k
                    block[here] = _block(own[here], sizes[k], block_words, seed + 31 * int(k))
                    last = here & (own == slots[k] - 1)
                    take[last] = goal[k] - (slots[k] - 1) * block_words
                order = np.argsort(np.random.default_rng([seed, shard, 1]).random(len(own)), kind="stable")
                yield batch(
                    number=pa.array(number, pa.int32()), block=pa.array(block, pa.int64()),
                    shard=pa.array(np.full(len(own), shard), pa.int64()),
                    slot=pa.array(np.argsort(order), pa.int32()), take=pa.array(take, pa.int64()),
                )

    tasks = max(1, min(shards, spark.sparkContext.defaultParallelism * 4))
    return spark.range(0, shards, numPartitions=tasks).mapInArrow(
        run, "number int, block long, shard long, slot int, take long"
    )


def _block(slot: np.ndarray, size: int, block_words: int, seed: int) -> np.ndarray:
    """Blocks that start in the first reading come first, permuted; then the others, the short last one at the end."""
    first = -(-size // block_words)
    second = -(-MOST_REPEATS * size // block_words) - first
    early = slot < first
    out = np.empty_like(slot)
    out[early] = permute(slot[early], first, seed)
    rest = slot[~early] - first
    moved = rest < second - 1
    rest[moved] = permute(rest[moved], second - 1, seed + 17)
    out[~early] = first + rest
    return out


def mix(
    documents: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, block_words: int = BLOCK_WORDS,
    slots_per_shard: int = SLOTS_PER_SHARD, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """The rows with their sizes and targets, and the pieces that fill the output blocks.

    Rows: ``(id, _text_hash, number, start, size, source, source_size, target)``, one per row of ``documents``.
    Pieces: ``(shard, slot, place, number, start, id, _text_hash, size, reading, first_word, end_word)``: words
    ``first_word`` to ``end_word`` of the row that starts at ``start`` in source ``number`` stand at ``place`` in the slot.
    Null and empty texts have no words and no pieces; null sources are one source; null ids and repeated rows take part
    like others. An empty table gives empty results; more than ``MOST_SOURCES`` sources are an error. Equal input gives equal output.
    """
    spark = documents.sparkSession
    sized = cut(
        documents.select(
            F.col(id).cast("long").alias("id"),
            F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("\0"))).alias("_text_hash"),
            F.col(source).cast("string").alias("source"), word_count(F.col(text).cast("string")).alias("size"),
        )
    )
    stats = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    targets = cut(source_targets(stats.select("source", "source_size"), weights=weights, share=share))
    sources = targets.orderBy("number").limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; give a coarser source column")
    rows = sized.count()
    known = sized.alias("d").join(
        targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source"))
    ).select("d.id", "d._text_hash", "d.source", "d.size", "t.number", "t.source_size", "t.target")
    placed = _positions(known, max(LEAST_BUCKETS, -(-rows // ROWS_PER_BUCKET)))

    position = F.col("start") + F.col("reading") * F.col("source_size")
    pieces = (
        placed.filter("size > 0")
        .withColumn("reading", F.explode(F.sequence(F.lit(0), F.lit(MOST_REPEATS - 1))))
        .withColumn("at", position)
        .withColumn(
            "block",
            F.explode(F.expr(f"sequence(at div {block_words}, (at + size - 1) div {block_words})")),
        )
    )
    begin = F.greatest(F.col("at"), F.col("block") * block_words)
    end = F.least(F.col("at") + F.col("size"), F.col("block") * block_words + F.col("take"))
    filled = (
        # The planner takes the slots for as small as the range of shards they are made from.
        pieces.join(_slots(spark, sources, block_words, slots_per_shard, seed).hint("merge"), ["number", "block"])
        .withColumn("first_word", begin - F.col("at"))
        .withColumn("end_word", end - F.col("at"))
        .filter("end_word > first_word")
        .select(
            "shard", "slot", (begin - F.col("block") * block_words).alias("place"), "number", "start", "id", "_text_hash",
            "size", "reading", "first_word", "end_word",
        )
    )
    return placed, filled


def taken_words(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """``placed`` with ``taken``, the words of the row that the mix uses, repeats counted."""
    used = pieces.groupBy("number", "start").agg(F.sum(F.col("end_word") - F.col("first_word")).alias("taken"))
    with_words = placed.filter("size > 0").join(used, ["number", "start"], "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0))
    )
    return with_words.unionByName(placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long")))


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The given ranges of words of a text as they stand there, one line for each range."""
    edges = [(m.start(), m.end()) for m in _WORDS.finditer(text)]
    return "\n".join(text[edges[a][0] : edges[b - 1][1]] for a, b in spans)


def mixed_documents(documents: DataFrame, *, id: str = "doc_id", text: str = "text", chars: str = "n_chars", **options) -> DataFrame:
    """The mix as rows of ``documents``: one for each row and reading of which words are used, with just these words.

    A text used whole stays as it is; of others the used ranges stand one to a line, and ``chars`` is counted anew.
    """
    columns = documents.columns
    schema = documents.schema
    _, pieces = mix(documents, id=id, text=text, **options)
    used = pieces.groupBy("number", "start", "reading", "id", "_text_hash").agg(
        F.array_sort(F.collect_list(F.struct("first_word", "end_word"))).alias("_spans"), F.first("size").alias("_size")
    )
    distinct = (
        documents.select(
            F.struct("*").alias("_row"), F.col(id).cast("long").alias("_id"),
            F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("\0"))).alias("_text_hash"),
        )
        .groupBy("_id", "_text_hash")
        .agg(F.min("_row").alias("_row"))
    )
    joined = used.alias("u").join(
        distinct.alias("d"),
        (F.col("u._text_hash") == F.col("d._text_hash")) & F.col("u.id").eqNullSafe(F.col("d._id")),
    ).select("d._row", "u._spans", "u._size")
    at = columns.index(text)
    count_at = columns.index(chars) if chars in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts, lengths = [], []
            arrays = rows.column("_row").flatten()
            for one, spans, size in zip(arrays[at].to_pylist(), rows.column("_spans").to_pylist(), rows.column("_size").to_pylist()):
                merged: list[list[int]] = []
                for span in spans:
                    if merged and merged[-1][1] == span["first_word"]:
                        merged[-1][1] = span["end_word"]
                    else:
                        merged.append([span["first_word"], span["end_word"]])
                whole = merged == [[0, size]]
                texts.append(one if whole else cut_words(one, merged))
                lengths.append(len(texts[-1]))
            arrays[at] = pa.array(texts, arrays[at].type)
            if count_at is not None:
                arrays[count_at] = pa.array(lengths, arrays[count_at].type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return joined.mapInArrow(run, schema)
