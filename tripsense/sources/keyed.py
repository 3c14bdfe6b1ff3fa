"""Parquet tables with a primary key, a file index and commits.

Rows are spread over directories by a hash of the id, the first key column, and every commit writes new files. Beside them
stands an index: per file the range of its ids and a Bloom filter of them, made by aggregates over what was written. A
guarded insert joins the ids of its batch to the index and opens only the files that may hold one of them.

A commit is a small numbered file that names the index parts in force. It is put in place by a rename that fails if the
number is taken, so readers see all of a write or nothing, and of two writers the second checks its keys again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripsense.operators.first_writer import first_writer_wins
from tripsense.operators.ordering import join_null_safe
from tripsense.session import shuffles_freed
from tripsense.sources.commits import delete, names_in, put_if_absent
from tripsense.sources.schemas import conform, optional

BUCKETS = 16
BUCKET = "id_bucket"
# Of a file's filter: about 16 bits an id, four of them set, all in one word.
BITS_PER_ID = 16
BITS_SET = 4
# Index parts of so many commits are joined into one.
MOST_PARTS = 64
# So many keys are broadcast to a join at most.
MOST_BROADCAST = 1 << 17
# A batch is laid out in rounds of about so many rows, of which there are only a few: each reads the batch.
ROUND_ROWS = 1 << 22
MOST_ROUNDS = 4

_INDEX = f"file string, {BUCKET} int, low long, high long, rows long, ids long, bloom array<long>"


def _spread(id: Column | str) -> Column:
    return F.xxhash64(F.lit("bloom"), id)


def _mask(id: Column | str) -> Column:
    """The bits of an id in its word of a filter."""
    bits = F.xxhash64(F.lit("bits"), id)
    mask = F.lit(0).cast("long")
    for n in range(BITS_SET):
        place = F.shiftrightunsigned(bits, 6 * n).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def _word(id: Column | str, words: Column) -> Column:
    return F.pmod(_spread(id), words).cast("int")


@dataclass(frozen=True)
class State:
    """The commit that a reader or writer works on: its number, -1 before the first, and the index parts in force."""

    version: int
    parts: tuple[str, ...]


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path``; the first column of ``key`` is a long, the id."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: tuple[str, ...]
    buckets: int = BUCKETS

    # files

    def _at(self, *parts: str) -> str:
        return "/".join([self.path.rstrip("/"), *parts])

    def _delete(self, *parts: str) -> None:
        delete(self.spark, self._at(*parts))

    # commits

    def state(self) -> State:
        """The newest commit."""
        names = names_in(self.spark, self._at("_commits"))
        versions = [int(name.removesuffix(".json")) for name in names if name.endswith(".json") and not name.startswith((".", "_"))]
        if not versions:
            return State(-1, ())
        text = self.spark.sparkContext.wholeTextFiles(self._at("_commits", f"{max(versions):020d}.json")).first()[1]
        return State(max(versions), tuple(json.loads(text)["parts"]))

    def _commit(self, after: State, parts: Sequence[str]) -> bool:
        """Put the next commit in place; false if another writer was there first."""
        return put_if_absent(self.spark, self._at("_commits"), f"{after.version + 1:020d}.json", json.dumps({"parts": list(parts)}))

    # index

    def index(self, state: State | None = None) -> DataFrame:
        """``file, id_bucket, low, high, rows, ids, bloom`` of the files in force."""
        state = state or self.state()
        if not state.parts:
            return self.spark.createDataFrame([], _INDEX)
        return self.spark.read.schema(_INDEX).parquet(*[self._at("index", part) for part in state.parts])

    def _index_of(self, part: str) -> DataFrame:
        """The index rows of a part's files, from the ids alone: exchanges by id and by file, none of them sorting a file.

        A filter's words are laid out as sorted (word, bits) slots, every word present: a lookup by word in a map of them
        would scan the map once per word, the square of a file's ids.
        """
        id = self.key[0]
        name = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/[^/]+/[^/]+)$", 1)
        ids = (
            self.spark.read.parquet(self._at("data", part)).select(name.alias("file"), BUCKET, F.col(id).alias("id"))
            .groupBy("file", BUCKET, "id").agg(F.count(F.lit(1)).alias("rows"))
        )
        sized = ids.groupBy("file", BUCKET).agg(F.ceil(F.count(F.lit(1)) * BITS_PER_ID / 64).cast("int").alias("words"))
        words = (
            ids.join(sized, ["file", BUCKET])
            .groupBy("file", BUCKET, "words", _word("id", F.col("words")).alias("word"))
            .agg(
                F.min("id").alias("low"), F.max("id").alias("high"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("ids"),
                F.bit_or(_mask("id")).alias("bits"),
            )
        )
        blank = sized.select("file", BUCKET, "words", F.explode(F.sequence(F.lit(0), F.col("words") - 1)).alias("word"), F.lit(0).cast("long").alias("bits"))
        slots = (
            words.select("file", BUCKET, "words", "word", "bits").unionByName(blank)
            .groupBy("file", BUCKET, "words", "word").agg(F.bit_or("bits").alias("bits"))
            .groupBy("file", BUCKET, "words").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("set"))
        )
        files = words.groupBy("file", BUCKET, "words").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"), F.sum("ids").alias("ids"),
        ).join(slots, ["file", BUCKET, "words"])
        bloom = F.transform("set", lambda slot: slot["bits"])
        return files.select("file", BUCKET, "low", "high", "rows", "ids", bloom.alias("bloom"))

    def candidates(self, ids: DataFrame, state: State | None = None) -> DataFrame:
        """Index rows of the files that may hold one of ``ids``, a column named as the table's id."""
        id = self.key[0]
        asked = ids.select(F.col(id).alias("_id")).distinct().withColumn("_bucket", self._bucket(F.col("_id")))
        files = self.index(state)
        held = F.get(F.col("bloom"), _word("_id", F.size("bloom")))
        met = (F.col(BUCKET) == F.col("_bucket")) & F.col("_id").between(F.col("low"), F.col("high")) & (held.bitwiseAND(_mask("_id")) == _mask("_id"))
        return files.join(asked, met, "left_semi")

    # rows

    def _bucket(self, id: Column) -> Column:
        return F.pmod(F.xxhash64(id), F.lit(self.buckets)).cast("int")

    def _rows_of(self, files: Sequence[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], optional(self.schema))
        return self.spark.read.schema(optional(self.schema)).parquet(*[self._at(name) for name in files])

    def read(self, state: State | None = None) -> DataFrame:
        """All rows in force; the table is empty when nothing has been committed.

        Of a bucket of a part all files are in force or none, as compaction takes buckets whole, so directories are read, whose
        number does not grow with the files in them.
        """
        folder = F.regexp_extract("file", r"^(.*)/[^/]+$", 1).alias("folder")
        return self._rows_of([row["folder"] for row in self.index(state).select(folder).distinct().collect()])

    def read_ids(self, ids: DataFrame) -> DataFrame:
        """All rows of ``ids``, from the files that may hold them."""
        files = [row["file"] for row in self.candidates(ids).select("file").collect()]
        return self._rows_of(files).join(ids.select(self.key[0]).distinct(), self.key[0], "left_semi")

    def _stage(self, rows: DataFrame, rounds: int = 1) -> str | None:
        """Write rows as a part that no commit names yet, with its index; none if there are no rows.

        In ``rounds`` a share of the buckets is written at a time, so that no more than that lies on disk as an exchange.

        The rebalance hint shuffles by bucket but lets adaptive execution split a bucket that a long trip makes large and
        merge small ones, so files come out near the advisory size. Sorting keeps an id's rows together: later aggregations
        combine nearly all of them before their exchange, and a lookup skips row groups by the id range.
        """
        part = uuid.uuid4().hex
        placed = conform(rows, self.schema).withColumn(BUCKET, self._bucket(F.col(self.key[0])))
        for n in range(rounds):
            share = placed.filter(F.col(BUCKET) % rounds == n) if rounds > 1 else placed
            laid_out = share.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.key)
            laid_out.write.mode("append").partitionBy(BUCKET).parquet(self._at("data", part))
        if not any(name.startswith(BUCKET) for name in names_in(self.spark, self._at("data", part))):
            self._delete("data", part)
            return None
        self._index_of(part).write.parquet(self._at("index", part))
        return part

    def _drop(self, part: str) -> None:
        self._delete("data", part)
        self._delete("index", part)

    def _parts_after(self, state: State, added: str) -> list[str]:
        """The index parts with one more; many are written as one first."""
        if len(state.parts) < MOST_PARTS:
            return [*state.parts, added]
        joined = uuid.uuid4().hex
        self.index(state).write.parquet(self._at("index", joined))
        return [joined, added]

    def append(self, rows: DataFrame) -> None:
        """Add rows whose keys are known to be new."""
        part = self._stage(rows)
        while part is not None:
            state = self.state()
            if self._commit(state, self._parts_after(state, part)):
                return

    def insert(self, batch: DataFrame, arrival: Sequence[str] = ()) -> int:
        """Add the rows whose keys are not in the table; of several with one key the first by ``arrival``.

        Copies inside the batch are reduced first, so what meets the table is unique by key and cannot be skewed. Returns the
        number of distinct keys offered. A writer that was overtaken checks its keys against the newer state.

        The batch is computed once and written below ``batches`` of the table until the end. What is asked about it needs its keys
        only: whole rows are exchanged to reduce copies, if there are any, and to lay out what is new, a share at a time. The
        shuffle files of each step go before the next.
        """
        place = uuid.uuid4().hex
        try:
            with shuffles_freed(self.spark), shuffles_freed(batch.sparkSession):
                rows = self._kept(batch, place, "given")
                copies = rows.groupBy(*self.key).agg(F.count(F.lit(1)).alias("copies"))
                offered, most = copies.agg(F.count(F.lit(1)), F.max("copies")).first()
                if offered and most > 1:
                    rows = self._kept(first_writer_wins(rows, self.key, arrival), place, "rows")
                    self._delete("batches", place, "given")
                layout = {"rounds": min(MOST_ROUNDS, -(-offered // ROUND_ROWS))} if offered > ROUND_ROWS else {}
                while offered:
                    state = self.state()
                    part = self._stage(self._unknown(rows, offered, state, place), **layout)
                    if part is None or self._commit(state, self._parts_after(state, part)):
                        break
                    self._drop(part)
            return offered
        finally:
            self._delete("batches", place)

    def _kept(self, rows: DataFrame, place: str, name: str) -> DataFrame:
        """``rows`` as written for the time of one insert, with the one zero that grouping by a key leaves of two."""
        types = {field.name: field.dataType for field in self.schema.fields}
        columns = []
        for column, kind in rows.dtypes:
            value = F.col(f"`{column}`")
            if kind == "void":  # holds nulls only and cannot be written
                if column not in types:
                    continue
                value = value.cast(types[column])
            elif column in self.key and kind in ("float", "double"):
                value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
            columns.append(value.alias(column))
        written = rows.select(*columns)
        written.write.parquet(self._at("batches", place, name), compression="zstd")
        return self.spark.read.schema(optional(written.schema)).parquet(self._at("batches", place, name))

    def _unknown(self, rows: DataFrame, offered: int, state: State, place: str) -> DataFrame:
        """The rows whose keys are not in the table; which these are is found from the keys alone."""
        keys = list(self.key)
        # Compressed files say little of how many rows they hold: by their size alone a large batch would be broadcast.
        batch = rows if offered <= MOST_BROADCAST else rows.hint("merge")
        files = [row["file"] for row in self.candidates(batch, state).select("file").collect()] if state.parts else []
        if not files:
            return rows
        # Reduced to the batch's keys before the anti-join, so a table side with long trips is never shuffled whole.
        present = self._rows_of(files).select(*keys).join(batch.select(*keys), keys, "left_semi")
        unknown = self._kept(batch.select(*keys).join(present, keys, "left_anti"), place, f"unknown-{state.version}")
        found = unknown.count()
        if found == offered:
            return rows
        # A null key is never present, so it is looked up null-safe.
        return join_null_safe(rows, F.broadcast(unknown) if found <= MOST_BROADCAST else unknown.hint("merge"), keys, "left_semi")

    def compact(self, most_files: int = 8) -> int:
        """Write the rows of crowded buckets anew, in larger files; returns how many files that replaces."""
        while True:
            state = self.state()
            index = self.index(state).withColumn("part", F.element_at(F.split("file", "/"), 2))
            crowded = index.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("files"), F.countDistinct("part").alias("parts"))
            chosen = [row[BUCKET] for row in crowded.filter((F.col("files") > most_files) & (F.col("parts") > 1)).collect()]
            if not chosen:
                return 0
            old = [row["file"] for row in index.filter(F.col(BUCKET).isin(chosen)).select("file").collect()]
            part, rest = self._stage(self._rows_of(old)), uuid.uuid4().hex
            index.filter(~F.col(BUCKET).isin(chosen)).drop("part").write.parquet(self._at("index", rest))
            if self._commit(state, [rest, part]):
                return len(old)
            self._drop(part)
            self._delete("index", rest)
