"""The sample table and the trip table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripsense.sources.keyed import KeyedTable
from tripsense.sources.quarantine import routed
from tripsense.sources.schemas import RAW_KEY, RAW_SCHEMA, TRIP_KEY, TRIP_SCHEMA


def raw_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, RAW_SCHEMA, RAW_KEY)


def trip_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, TRIP_SCHEMA, TRIP_KEY)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return raw_table(spark, path).read()


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return trip_table(spark, path).read()


def append_raw(samples: DataFrame, path: str) -> None:
    """Add samples whose keys are known to be new, laid out by trip."""
    raw_table(samples.sparkSession, path).append(samples)


def append_trips(trips: DataFrame, path: str) -> None:
    """Add trips whose ids are known to be new."""
    trip_table(trips.sparkSession, path).append(trips)


def insert_raw(batch: DataFrame, path: str, arrival: Sequence[str]) -> int:
    """Insert samples under the primary key: earlier rows of the table or of the batch win.

    Returns the number of distinct keys offered.
    """
    return raw_table(batch.sparkSession, path).insert(batch, arrival)


def insert_trips(trips: DataFrame, path: str) -> None:
    """Add trips whose id is not in the table yet."""
    trip_table(trips.sparkSession, path).insert(trips)


def insert_checked(batch: DataFrame, table: KeyedTable, rejects_path: str, arrival: Sequence[str] = ()) -> int:
    """Insert the rows that meet the table's contract and keep the others aside, each with its violations.

    Returns the number of distinct keys offered.
    """
    checked = routed(batch, table.schema, table.key, arrival).persist()
    try:
        aside = checked.filter("size(violations) > 0")
        aside.write.mode("append").parquet(rejects_path)
        return table.insert(checked.filter("size(violations) = 0").select("row.*"))
    finally:
        checked.unpersist()
