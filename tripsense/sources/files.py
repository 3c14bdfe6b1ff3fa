"""CSV drops and parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripsense.functions.scalars import normalise_columns
from tripsense.sources.schemas import LABEL_SCHEMA, RAW_SCHEMA, conform


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV as text, then cast by name.

    Inference would read every byte twice and can pick other types for the next file. ``enforceSchema=False``
    makes a file whose header differs from the first one fail instead of binding by position.
    """
    text = spark.read.csv(path, header=True, inferSchema=False, enforceSchema=False)
    return conform(normalise_columns(text), schema)


def read_samples_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, RAW_SCHEMA)


def read_labels_csv(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, LABEL_SCHEMA)
