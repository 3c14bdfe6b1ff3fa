"""Safety labels: multiplicity, unambiguous ids, attachment to trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_multiplicity(labels: DataFrame) -> DataFrame:
    return labels.groupBy("bookingid").agg(F.count(F.lit(1)).alias("copies"))


def unique_labels(labels: DataFrame) -> DataFrame:
    """Labels of ids that occur exactly once; every copy of a repeated id is left out.

    One aggregate instead of a count joined back: the maximum of a single row is that row's label, and an id
    repeated a billion times is reduced before the exchange.
    """
    return (
        labels.groupBy("bookingid")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("label").alias("label"))
        .filter("copies = 1")
        .drop("copies")
    )


def label_classes(labels: DataFrame) -> DataFrame:
    """Number of distinct label values, null counted as one."""
    return labels.select("label").distinct().agg(F.count(F.lit(1)).alias("classes"))


def with_label(trips: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join; no broadcast hint, since labels grow with the trips and the planner knows both sizes."""
    return trips.join(labels, "bookingid", "left")
