"""Samples to the trip table: features, labels and the insert-only rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsense.functions.features import FEATURE_COLUMNS, fill_missing, trip_features
from tripsense.operators.labels import unique_labels, with_label
from tripsense.sources.files import read_labels_csv
from tripsense.sources.tables import append_trips, read_raw, read_trips


def labelled_trips(samples: DataFrame, labels: DataFrame) -> DataFrame:
    """Features of every trip, with the label of unambiguously labelled ids."""
    return with_label(trip_features(samples), unique_labels(labels))


def consolidate(samples: DataFrame, done: DataFrame, labels: DataFrame, *, fill_label: bool = True) -> DataFrame:
    """Rows to append to the trip table.

    Trips in ``done`` are left alone even when more samples have arrived. They are excluded after the
    aggregation, by an anti-join on the grouping key. While their ids are small enough to broadcast, Catalyst
    moves that join below the aggregate and their samples are dropped during the scan. Beyond that it stays
    above: one row per trip meets the id list, on the partitioning the aggregate already has, and no sample is
    shuffled for it.

    With ``fill_label`` a trip without a usable label counts as safe (0); otherwise it stays null.
    """
    features = trip_features(samples.filter("bookingid IS NOT NULL"))
    features = features.join(done.select("bookingid"), "bookingid", "left_anti")
    trips = with_label(features, unique_labels(labels))
    if not fill_label:
        trips = trips.na.fill(0.0, subset=list(FEATURE_COLUMNS))
    else:
        trips = fill_missing(trips)
    return trips.select("bookingid", *FEATURE_COLUMNS, F.col("label").cast("int").alias("label"))


def consolidate_job(
    spark: SparkSession, raw_path: str, labels_path: str, trips_path: str, *, fill_label: bool = True
) -> int:
    """Append all pending trips and return how many.

    The plan runs once, for the write; the table is counted from its file footers. (An ``Observation`` would give
    the number during the write, but a session that has used one can no longer ship freshly fitted classifiers
    to executors: their training summaries hold the session, and with it the observation manager.)
    """
    before = read_trips(spark, trips_path).count()
    trips = consolidate(
        read_raw(spark, raw_path),
        read_trips(spark, trips_path),
        read_labels_csv(spark, labels_path),
        fill_label=fill_label,
    )
    append_trips(trips, trips_path)
    return read_trips(spark, trips_path).count() - before
