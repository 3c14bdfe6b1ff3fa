"""Hand-made samples and the plain-Python rules the operators are checked against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripsense.sources.schemas import RAW_CHANNELS, RAW_SCHEMA, optional


def sample(bookingid, second, **channels):
    values = {name: 0.0 for name in RAW_CHANNELS} | {"second": second} | channels
    return (bookingid, *[None if values[name] is None else float(values[name]) for name in RAW_CHANNELS])


def samples(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, optional(RAW_SCHEMA))


def replay_windows(rows, size=10, step=5):
    """One trip through a plain buffer: full windows, then what is left."""
    windows, buffer = [], []
    for row in rows:
        buffer.append(row)
        if len(buffer) == size:
            windows.append(list(buffer))
            buffer = buffer[step:]
    if buffer:
        windows.append(buffer)
    return windows


def as_set(df: DataFrame):
    return sorted(tuple(row) for row in df.collect())
