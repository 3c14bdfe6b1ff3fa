"""Per-trip motion features: one definition for stored trips, count windows and streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output column, statistic, input channel, in table order.
FEATURES: tuple[tuple[str, str, str], ...] = (
    ("avg_speed", "mean", "speed"),
    ("std_speed", "stddev", "speed"),
    ("avg_accel_mag", "mean", "accel_mag"),
    ("max_accel_mag", "max", "accel_mag"),
    ("std_accel_mag", "stddev", "accel_mag"),
    ("avg_gyro_mag", "mean", "gyro_mag"),
    ("std_gyro_mag", "stddev", "gyro_mag"),
    ("avg_accel_x", "mean", "acceleration_x"),
    ("std_accel_x", "stddev", "acceleration_x"),
    ("max_accel_x", "max", "acceleration_x"),
    ("avg_accel_y", "mean", "acceleration_y"),
    ("std_accel_y", "stddev", "acceleration_y"),
    ("max_accel_y", "max", "acceleration_y"),
    ("avg_accel_z", "mean", "acceleration_z"),
    ("std_accel_z", "stddev", "acceleration_z"),
    ("max_accel_z", "max", "acceleration_z"),
    ("avg_gyro_x", "mean", "gyro_x"),
    ("std_gyro_x", "stddev", "gyro_x"),
    ("avg_gyro_y", "mean", "gyro_y"),
    ("std_gyro_y", "stddev", "gyro_y"),
    ("avg_gyro_z", "mean", "gyro_z"),
    ("std_gyro_z", "stddev", "gyro_z"),
    ("avg_accuracy", "mean", "accuracy"),
    ("std_accuracy", "stddev", "accuracy"),
    ("second", "max", "second"),
)

FEATURE_COLUMNS: tuple[str, ...] = tuple(name for name, _, _ in FEATURES)

_STATISTICS = {"mean": F.mean, "stddev": F.stddev_samp, "max": F.max}


def _magnitude(prefix: str) -> Column:
    axes = [F.col(f"{prefix}_{axis}") for axis in "xyz"]
    x, y, z = (axis * axis for axis in axes)
    return F.sqrt(x + y + z)


def with_magnitudes(samples: DataFrame) -> DataFrame:
    return samples.withColumns({"accel_mag": _magnitude("acceleration"), "gyro_mag": _magnitude("gyro")})


def feature_aggregates() -> list[Column]:
    return [_STATISTICS[statistic](channel).alias(name) for name, statistic, channel in FEATURES]


def trip_features(samples: DataFrame, keys: Sequence[str] = ("bookingid",)) -> DataFrame:
    """All features in a single hash aggregate.

    Partial aggregation runs before the exchange, so a trip holding most of the rows reaches its reducer
    as one buffer per map task.
    """
    return with_magnitudes(samples).groupBy(*keys).agg(*feature_aggregates())


def fill_missing(df: DataFrame, value: float = 0.0) -> DataFrame:
    """Null and NaN become ``value`` in every numeric column; types are unchanged."""
    return df.na.fill(value)
