"""Count windows on a stream: short per-trip buffers in keyed state, with an idle flush by timers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tripsense.operators.windows import IDLE_SECONDS, WINDOW_SIZE, WINDOW_STEP, check_window
from tripsense.session import keyed_state_options

STATE = "trip"
_TAGS = [T.StructField("bookingid", T.LongType()), T.StructField("window_idx", T.LongType()), T.StructField("is_tail", T.BooleanType())]


class TripBuffer(StatefulProcessor):
    """The samples of one trip that later windows need: one state value a trip, and one timer where idle trips go."""

    def __init__(self, sample: T.StructType, order: Sequence[str], size: int, step: int, idle_ms: int | None):
        self.names, self.order, self.size, self.step, self.idle_ms = sample.names, list(order), size, step, idle_ms
        self.out = Row(*[field.name for field in _TAGS], *sample.names)
        self.schema = T.StructType([
            T.StructField("next_window", T.LongType()), T.StructField("last_seen", T.LongType()), T.StructField("held", T.ArrayType(sample)),
        ])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.trip = handle.getValueState(STATE, self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self.trip.get()
        number, held = (known[0], [tuple(row) for row in known[2]]) if known is not None else (0, [])
        # A shuffle leaves rows in no order. Their number is limited by the source's trigger limit.
        for row in sorted(rows, key=lambda row: [row[name] for name in self.order]):
            held.append(tuple(row[name] for name in self.names))
            if len(held) == self.size:
                for sample in held:
                    yield self.out(key[0], number, False, *sample)
                del held[: self.step]
                number += 1
        now = None
        if self.idle_ms is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            if known is None:
                self.handle.registerTimer(now + self.idle_ms + 1)
        self.trip.update((number, now, held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        number, last_seen, held = self.trip.get()
        due = last_seen + self.idle_ms + 1
        if timerValues.getCurrentProcessingTimeInMs() < due:  # seen again since the timer was set
            self.handle.registerTimer(due)
            return
        for sample in held:
            yield self.out(key[0], number, True, *sample)
        self.trip.clear()

    def close(self) -> None:
        pass


def stream_count_windows(
    samples: DataFrame,
    *,
    order: Sequence[str] = ("second",),
    size: int = WINDOW_SIZE,
    step: int = WINDOW_STEP,
    idle_seconds: float | None = IDLE_SECONDS,
) -> DataFrame:
    """Samples tagged with ``window_idx`` and ``is_tail``; a sample appears once per window it is in.

    State per trip is a counter, a time and fewer than ``size`` samples in their own types; only the trips of a micro-batch are
    written. Within a micro-batch a trip's samples are taken by ``order`` (columns without nulls); across batches, as they
    arrive. More than ``idle_seconds`` after its last sample the rest of a trip goes out as one short window and the trip is
    forgotten; timers fire without new input. ``None`` turns that off, which a run over a fixed set of files needs in order
    to end by itself.

    Rows without a trip id belong in a reject table and must not reach this operator. Keyed state needs the state store of
    ``session.keyed_state_options``, which is set here where the session has another.
    """
    check_window(size, step)
    for name, value in keyed_state_options().items():
        samples.sparkSession.conf.set(name, value)
    sample = T.StructType([T.StructField(f.name, f.dataType) for f in samples.schema.fields if f.name != "bookingid"])
    idle_ms = None if idle_seconds is None else int(idle_seconds * 1000)
    return samples.groupBy("bookingid").transformWithState(
        TripBuffer(sample, order, size, step, idle_ms),
        outputStructType=T.StructType(_TAGS + sample.fields),
        outputMode="append",
        timeMode="none" if idle_ms is None else "processingTime",
    )


def leftover_windows(spark: SparkSession, checkpoint: str, windows: T.StructType) -> DataFrame:
    """What a stream that has ended still holds: the last, short window of every trip, read from its state.

    ``windows`` is the schema of :func:`stream_count_windows`. A run over a fixed set of files with
    ``idle_seconds=None`` emits full windows only; with these rows its output is whole.
    """
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    held = state.select(
        F.col("key.bookingid").alias("bookingid"), F.col("value.next_window").alias("window_idx"), F.lit(True).alias("is_tail"),
        F.explode("value.held").alias("sample"),
    )
    return held.select("bookingid", "window_idx", "is_tail", "sample.*").select(*windows.names)
