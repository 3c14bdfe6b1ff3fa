"""CSV drop to the sample table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tripsense.sources.files import read_samples_csv
from tripsense.sources.tables import insert_raw


def ingest_batch(spark: SparkSession, csv_path: str, raw_path: str) -> int:
    """Samples whose ``(bookingid, second)`` is not in the table yet; a drop read twice adds nothing the second time.

    Of copies inside a drop the one with the smallest values stays. Returns the number of distinct keys offered.
    """
    return insert_raw(read_samples_csv(spark, csv_path), raw_path, ())
