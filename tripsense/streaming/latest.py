"""The live view of every trip, kept current by a stream, and the feed of predictions it is made from.

The view is a table of two layers: a snapshot of all trips, and the changes of the micro-batches since. Partial states merge
(``operators.latest``), so a micro-batch writes what it says itself without looking at what is known, the stream holds no
state, and a replayed batch replaces its own change. Every so many batches the layers are merged into a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripsense.operators.latest import merged_states, partial_state, shown
from tripsense.sources.commits import delete, exists, names_in
from tripsense.sources.messages import parse_messages
from tripsense.sources.schemas import PREDICTION_SCHEMA
from tripsense.streaming.sinks import start_batches

SNAPSHOT_EVERY = 16
MESSAGE_ID = ("bookingid", "batch_id", "window_idx")


def _header(name: str) -> Column:
    return F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))["value"].cast("string").cast("long")


def prediction_feed(messages: DataFrame) -> DataFrame:
    """Prediction messages with ``has_label``, false when the JSON object has no such field at all.

    Feed it to :func:`start_latest_state` with ``order="offset"``: messages are keyed by trip, so the offset
    orders those of one trip. Where messages have ``headers``, what they say of the message comes as ``batch_id`` and
    ``window_idx``. Rejected messages are left to :func:`tripsense.streaming.ingest.start_rejects`.
    """
    parsed = parse_messages(messages, PREDICTION_SCHEMA)
    present = F.coalesce(F.array_contains(F.json_object_keys("value"), "label"), F.lit(False))
    feed = parsed.withColumn("has_label", present).filter("NOT rejected").drop("value", "rejected")
    if "headers" not in feed.columns:
        return feed
    return feed.withColumns({"batch_id": _header("batch_id"), "window_idx": _header("window_idx")}).drop("headers")


def each_once(feed: DataFrame, *, arrived: str = "timestamp", within: str = "1 hour") -> DataFrame:
    """A feed with headers without the messages that a sink has published again.

    A repeat is known by trip, batch and window. Identities are kept for ``within`` after their message, which is what bounds
    the state; a repeat that comes later than that passes.
    """
    return feed.withWatermark(arrived, within).dropDuplicatesWithinWatermark(list(MESSAGE_ID))


def partial_schema(order: str) -> T.StructType:
    def newest(kind: T.DataType) -> T.StructType:
        return T.StructType([T.StructField("at", T.LongType()), T.StructField("value", kind)])

    return T.StructType([
        T.StructField("bookingid", T.LongType()), T.StructField("speed", newest(T.DoubleType())),
        T.StructField("time", newest(T.DoubleType())), T.StructField("label", newest(T.IntegerType())),
        T.StructField(order, T.LongType()),
    ])


def _layers(spark: SparkSession, path: str, upto: int | None = None) -> tuple[int, list[str]]:
    """The newest snapshot's batch (-1: none) and the folders to read: that snapshot and the changes after it."""

    def batches(layer: str) -> list[int]:
        names = [name for name in names_in(spark, f"{path}/{layer}") if name.startswith("batch_id=")]
        numbers = sorted(int(name.removeprefix("batch_id=")) for name in names)
        return [n for n in numbers if (upto is None or n <= upto) and exists(spark, f"{path}/{layer}/batch_id={n}/_SUCCESS")]

    newest = max(batches("snapshots"), default=-1)
    folders = [f"{path}/changes/batch_id={n}" for n in batches("changes") if n > newest]
    return newest, folders + ([f"{path}/snapshots/batch_id={newest}"] if newest >= 0 else [])


def _merged(spark: SparkSession, folders: list[str], order: str) -> DataFrame:
    schema = partial_schema(order)
    if not folders:
        return spark.createDataFrame([], schema)
    return merged_states(spark.read.schema(schema).parquet(*folders), order)


def start_latest_state(
    messages: DataFrame,
    order: str,
    path: str,
    checkpoint: str,
    *,
    label_present: str | None = None,
    snapshot_every: int = SNAPSHOT_EVERY,
    keep: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write what each micro-batch changes, and a snapshot after every ``snapshot_every`` batches.

    A snapshot leaves out trips whose newest ``order`` is more than ``keep`` behind the newest of all (none by default), so
    with it the view is bounded by the trips that are alive. What a snapshot has taken in is deleted when the next one is
    there, so a reader has that long to finish.
    """
    path = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        states = partial_state(batch, order, label_present=label_present)
        states.write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        if (batch_id + 1) % snapshot_every:
            return
        # A replay finds its own snapshot, or one that was cut off; it is made again from the one before.
        before, folders = _layers(spark, path, batch_id)
        if before == batch_id:
            return
        view = _merged(spark, folders, order)
        if keep is not None:
            newest = view.agg(F.max(order)).first()[0]
            view = view.filter(F.col(order) >= F.lit(newest) - keep)
        view.write.mode("overwrite").parquet(f"{path}/snapshots/batch_id={batch_id}")
        for layer, last in (("changes", before), ("snapshots", before - 1)):
            for name in names_in(spark, f"{path}/{layer}"):
                if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= last:
                    delete(spark, f"{path}/{layer}/{name}")

    return start_batches(messages, write, checkpoint, trigger=trigger)


def read_latest_state(spark: SparkSession, path: str, order: str) -> DataFrame:
    """The view as of the last micro-batch: one snapshot and the changes since."""
    _, folders = _layers(spark, path.rstrip("/"))
    return shown(_merged(spark, folders, order), order)
