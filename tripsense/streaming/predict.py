"""Window features, scoring and prediction messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripsense.functions.features import fill_missing, trip_features
from tripsense.operators.windows import IDLE_SECONDS, WINDOW_SIZE, WINDOW_STEP
from tripsense.sources.schemas import PREDICTION_SCHEMA
from tripsense.streaming.count_windows import stream_count_windows
from tripsense.streaming.sinks import BatchWriter, start_batches

WINDOW_KEYS = ("bookingid", "window_idx", "is_tail")

Scorer = Callable[[DataFrame], DataFrame]


def prediction_messages(scored: DataFrame, *extra: str) -> DataFrame:
    return scored.select(
        "bookingid",
        *extra,
        F.col("second").alias("time"),
        F.col("avg_speed").alias("speed"),
        F.col("prediction").cast("int").alias("label"),
    )


def topic_messages(messages: DataFrame, batch_id: int) -> DataFrame:
    """Key, value and headers for the prediction topic.

    The key keeps a trip's predictions in order. A topic sink may repeat a batch after a failure; the headers
    carry what a reader needs to recognise a message it has seen, and the version of the model where it is known.
    """
    told = {"batch_id": F.lit(batch_id), "window_idx": F.col("window_idx")}
    if "model_version" in messages.columns:
        told["model_version"] = F.col("model_version")
    headers = F.array(
        *[
            F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))
            for name, value in told.items()
        ]
    )
    return messages.select(
        F.col("bookingid").cast("string").alias("key"),
        F.to_json(F.struct(*PREDICTION_SCHEMA.names)).alias("value"),
        headers.alias("headers"),
    )


def topic_batches(options: dict[str, str]) -> BatchWriter:
    """Publish predictions; ``options`` as from :func:`tripsense.sources.messages.topic_sink_options`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        topic_messages(batch, batch_id).write.format("kafka").options(**options).option("includeHeaders", True).save()

    return write


def window_features(window_samples: DataFrame) -> DataFrame:
    """The trip features per window, missing values filled exactly as for training."""
    return fill_missing(trip_features(window_samples, WINDOW_KEYS))


def start_predictions(
    samples: DataFrame,
    scorer: Scorer,
    write: BatchWriter,
    checkpoint: str,
    *,
    order: Sequence[str] = ("second",),
    size: int = WINDOW_SIZE,
    step: int = WINDOW_STEP,
    idle_seconds: float | None = IDLE_SECONDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score every window of a micro-batch in one job and hand the messages to ``write``.

    ``scorer`` maps features to a ``prediction`` column: a loaded model, a fixed rule, or a
    :class:`~tripsense.modelling.registry.ModelFollower` that looks for a new version at each batch.
    """
    windows = stream_count_windows(samples, order=order, size=size, step=step, idle_seconds=idle_seconds)

    def score(batch: DataFrame, batch_id: int) -> None:
        write(scored_messages(batch, scorer), batch_id)

    return start_batches(windows, score, checkpoint, trigger=trigger)


def scored_messages(window_samples: DataFrame, scorer: Scorer) -> DataFrame:
    scored = scorer(window_features(window_samples))
    version = ["model_version"] if "model_version" in scored.columns else []
    return prediction_messages(scored, "window_idx", "is_tail", *version)
