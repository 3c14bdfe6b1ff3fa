"""From trip rows to vectors, and the train / test split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame

from tripsense.functions.scalars import SPLIT_BUCKETS, split_bucket

# The features the production model is trained on.
MODEL_FEATURES = (
    "std_gyro_z",
    "std_accel_y",
    "std_accel_z",
    "max_accel_x",
    "avg_speed",
    "std_accel_x",
    "max_accel_mag",
    "std_speed",
    "std_gyro_mag",
    "std_gyro_x",
    "max_accel_z",
    "avg_gyro_mag",
    "std_accel_mag",
    "second",
)
SEED = 42
TRAIN_FRACTION = 0.7
EXPERIMENT_TRAIN_FRACTION = 0.8


def check_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"columns not found in data: {missing}")


def assembler(columns: Sequence[str]) -> VectorAssembler:
    """A null raises instead of passing silently; fill missing values first."""
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def assemble_features(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    check_columns(df, columns)
    return assembler(columns).transform(df)


def scaler() -> StandardScaler:
    """Divide by the sample deviation, without centring."""
    return StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False)


def scale_features(df: DataFrame, columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Scaled vectors as ``features``, everything else kept."""
    assembled = assemble_features(df, columns)
    scaled = scaler().fit(assembled).transform(assembled)
    return scaled.drop("features").withColumnRenamed("scaled_features", "features")


def in_train(key: str = "bookingid", fraction: float = TRAIN_FRACTION, seed: int = SEED) -> Column:
    return split_bucket(key, seed) < round(fraction * SPLIT_BUCKETS)


def train_test_split(
    df: DataFrame, fraction: float = TRAIN_FRACTION, *, seed: int = SEED, key: str = "bookingid"
) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts that together are ``df``; the same trip always lands in the same part."""
    chosen = in_train(key, fraction, seed)
    return df.filter(chosen), df.filter(~chosen)
