"""Live view of a trip: what is left on screen after all messages so far.

A view is kept as a partial state: per field its newest value that counts, together with its place in the order. Partial
states of parts of the messages merge into that of all of them, in any order and however often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = ("speed", "time", "label")


def partial_state(messages: DataFrame, order: str, *, label_present: str | None = None) -> DataFrame:
    """``bookingid``, per field ``(at, value)`` of its newest message that counts, and the newest ``order``.

    For speed and time those count that are not zero, empty or null; for the label all, even null ones. A message without a
    label field at all keeps the previous label. Null and absent look alike once parsed, so ``label_present`` may name a
    boolean column that tells them apart.
    """

    def newest(name: str, counts: Column) -> Column:
        return F.max(F.when(counts, F.struct(F.col(order).alias("at"), F.col(name).alias("value")))).alias(name)

    truthy = lambda c: c.isNotNull() & ~F.isnan(c) & (c != 0)
    return messages.groupBy("bookingid").agg(
        newest("speed", truthy(F.col("speed"))),
        newest("time", truthy(F.col("time"))),
        newest("label", F.col(label_present) if label_present else F.lit(True)),
        F.max(order).alias(order),
    )


def merged_states(partials: DataFrame, order: str) -> DataFrame:
    return partials.groupBy("bookingid").agg(*[F.max(name).alias(name) for name in (*FIELDS, order)])


def shown(partials: DataFrame, order: str) -> DataFrame:
    return partials.select("bookingid", *[F.col(name)["value"].alias(name) for name in FIELDS], order)


def latest_trip_state(messages: DataFrame, order: str, *, label_present: str | None = None) -> DataFrame:
    """Newest speed and time that are not zero, empty or null; newest label, even a null one."""
    return shown(partial_state(messages, order, label_present=label_present), order)
