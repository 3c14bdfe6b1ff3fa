"""Trip-level selections over samples and consolidated trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.operators.ordering import GROUP_ROWS, with_prefix

# Columns shown on a trip card, two decimals.
CARD_COLUMNS = (
    "avg_speed",
    "std_speed",
    "avg_accel_mag",
    "max_accel_mag",
    "std_accel_mag",
    "avg_gyro_mag",
    "std_gyro_mag",
)


def pending_samples(samples: DataFrame, done: DataFrame) -> DataFrame:
    """Samples of trips not consolidated yet.

    Both keys are primary-key columns. A null sample key is left out, as ``NOT IN`` would; a null in ``done``
    is ignored. The planner broadcasts the ids while they are below its size threshold; beyond it the join is
    by sort, where adaptive execution splits the side of a long trip.
    """
    return samples.filter("bookingid IS NOT NULL").join(done.select("bookingid"), "bookingid", "left_anti")


def trip_lookup(trips: DataFrame, bookingid: int) -> DataFrame:
    return trips.filter(F.col("bookingid") == bookingid)


def trip_summary_card(trips: DataFrame) -> DataFrame:
    return trips.select("bookingid", *[F.round(name, 2).alias(name) for name in CARD_COLUMNS])


def ordered_samples(samples: DataFrame) -> DataFrame:
    """Global sort; range partitioning on both columns spreads a long trip over several tasks."""
    return samples.orderBy("bookingid", "second")


def first_trips(samples: DataFrame, n: int = 3) -> DataFrame:
    """All samples of the ``n`` smallest trip ids; ``n`` ids is what is broadcast."""
    ids = samples.select("bookingid").filter("bookingid IS NOT NULL").distinct().orderBy("bookingid").limit(n)
    return samples.join(F.broadcast(ids), "bookingid", "left_semi")


def trip_sequences(
    samples: DataFrame,
    fields: tuple[str, ...] = ("speed",),
    *,
    chunk_rows: int = 10_000,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Each trip's records in time order, as lists of at most ``chunk_rows`` records.

    Chunks of a trip concatenated by ``chunk`` are its whole record list; a list per trip would have no size
    bound.
    """
    ranked = with_prefix(samples, ["bookingid"], ["second", *fields], out="_rank", group_rows=group_rows)
    record = F.struct("second", *fields)
    return (
        ranked.withColumn("chunk", F.floor(F.col("_rank") / chunk_rows).cast("long"))
        .groupBy("bookingid", "chunk")
        .agg(F.sort_array(F.collect_list(record)).alias("records"))
    )
