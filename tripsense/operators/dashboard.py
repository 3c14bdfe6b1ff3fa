"""Dashboard panels over consolidated trips, each a conditional count in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bucket:
    label: str
    low: float
    high: float | None  # None: no upper end


# Half-open ranges (low, high] and their captions.
SPEED_BUCKETS = (
    Bucket("0-5", 0, 5),
    Bucket("5-10", 5, 10),
    Bucket("10-15", 10, 15),
    Bucket("15-20", 15, 20),
    Bucket("20-25", 20, 25),
)
DURATION_BUCKETS = (
    Bucket("Short trip (<10min)", 0, 600),
    Bucket("Normal trip (10-30min)", 600, 1800),
    Bucket("Long trip (>30min)", 1800, None),
)
SAFETY_LABELS = (("Safe", 0), ("Dangerous", 1))

PANELS = ("safety", "speed", "speed_std", "duration")


def _in_bucket(column: str, bucket: Bucket) -> Column:
    value = F.col(column)
    inside = (value > bucket.low) & ~F.isnan(value)  # Spark sorts NaN above every number
    return inside if bucket.high is None else inside & (value <= bucket.high)


def _conditions(panel: str) -> list[tuple[str, Column]]:
    if panel == "safety":
        return [(caption, F.col("label") == value) for caption, value in SAFETY_LABELS]
    column, buckets = {
        "speed": ("avg_speed", SPEED_BUCKETS),
        "speed_std": ("std_speed", SPEED_BUCKETS),
        "duration": ("second", DURATION_BUCKETS),
    }[panel]
    return [(bucket.label, _in_bucket(column, bucket)) for bucket in buckets]


def panel_counts(trips: DataFrame, panels: Sequence[str] = PANELS) -> DataFrame:
    """``panel, position, bucket, trips`` for all panels from a single scan; empty buckets count 0."""
    cells = [
        (panel, position, caption, condition)
        for panel in panels
        for position, (caption, condition) in enumerate(_conditions(panel))
    ]
    counts = trips.agg(*[F.count_if(condition).alias(f"c{i}") for i, (_, _, _, condition) in enumerate(cells)])
    rows = [
        F.struct(
            F.lit(panel).alias("panel"),
            F.lit(position).alias("position"),
            F.lit(caption).alias("bucket"),
            F.col(f"c{i}").alias("trips"),
        )
        for i, (panel, position, caption, _) in enumerate(cells)
    ]
    return counts.select(F.inline(F.array(*rows)))


def trip_safety_counts(trips: DataFrame) -> DataFrame:
    return panel_counts(trips, ["safety"]).drop("panel")


def trip_speed_histogram(trips: DataFrame) -> DataFrame:
    return panel_counts(trips, ["speed"]).drop("panel")


def trip_speed_std_histogram(trips: DataFrame) -> DataFrame:
    return panel_counts(trips, ["speed_std"]).drop("panel")


def trip_duration_buckets(trips: DataFrame) -> DataFrame:
    return panel_counts(trips, ["duration"]).drop("panel")


def trip_dashboard(trips: DataFrame) -> DataFrame:
    return panel_counts(trips)
