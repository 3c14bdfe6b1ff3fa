"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Messages of the live trip view.
SAFE_MESSAGE = "✅ Continue driving safely!"
DANGER_MESSAGE = "⚠️ You are driving too fast!"

SPLIT_BUCKETS = 10_000


def normalise_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide afterwards are an error."""
    lowered = [name.lower() for name in df.columns]
    clashes = sorted({name for name in lowered if lowered.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide once lower-cased: {clashes}")
    return df.toDF(*lowered)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(field.name, digits).alias(field.name) if isinstance(field.dataType, T.DoubleType)
            else F.col(field.name)
            for field in df.schema.fields
        ]
    )


def trip_status(label: Column | str) -> Column:
    column = F.col(label) if isinstance(label, str) else label
    return F.when(column == 0, SAFE_MESSAGE).when(column.isNotNull(), DANGER_MESSAGE)


def split_bucket(key: Column | str, seed: int) -> Column:
    """A bucket in ``[0, SPLIT_BUCKETS)`` that depends on the key and the seed alone.

    Unlike a random draw it does not change with partitioning, retries or file order, and any engine
    with MD5 can recompute it.
    """
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat_ws(":", column.cast("string"), F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % SPLIT_BUCKETS
