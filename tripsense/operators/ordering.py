"""Exact ordered prefixes (ranks, running sums) inside groups of any size.

A window function sorts each of its groups in one task, which is right for the many small groups and wrong for one that
holds a large share of the table. Groups are counted first. Those above a limit are cut into pieces at quantiles of their
whole order tuple, with a hash of the row behind it so that ties are cut too; which piece a row is in follows from the row
and the cuts alone, by binary search. Positions are counted inside each piece, and what the earlier pieces of the group hold
is added back. Both steps compute the same pieces, so nothing has to be written between them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A group of so many rows is sorted in one task; larger ones are cut into pieces of about as many.
GROUP_ROWS = 1 << 20
# All pieces together are at most about so many: with more, pieces grow. It bounds what is broadcast.
MOST_CUTS = 100_000
SAMPLES_PER_PIECE = 16


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` in which null matches null; keeps the left spelling of the keys."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = reduce(lambda a, b: a & b, (left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys))
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_right_{key}" for key in keys])


def with_prefix(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, out: str, value: str | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Add ``out``: the number of rows (or the sum of ``value``) before each row of its group.

    ``order`` names the sorting columns, nulls first; rows equal in all of them are numbered in any order. Without ``keys``
    the whole table is one group. Rows must come out the same whenever ``df`` is computed again. Groups above ``group_rows``
    rows are cut; only rows that are equal in every column stay in one piece however many they are.
    """
    columns = df.columns
    keys = list(keys)
    if not keys:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    rows, most = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    limit = max(group_rows, -(-(rows or 0) // MOST_CUTS))
    if (most or 0) <= limit:
        return df.withColumn(out, _inside(Window.partitionBy(*keys).orderBy(*order), value)).select(*columns, out)

    cuts = F.broadcast(_cuts(df, keys, order, limit))
    place = _place(F.col("_cuts"), _tuple(df, order))
    placed = join_null_safe(df, cuts, keys, "left").withColumn("_piece", F.when(F.col("_cuts").isNull(), 0).otherwise(place))
    numbered = placed.drop("_cuts").withColumn(out, _inside(Window.partitionBy(*keys, "_piece").orderBy(*order), value))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.filter("_cuts IS NOT NULL")
        .groupBy(*keys, "_piece")
        .agg((F.count(F.lit(1)) if value is None else F.sum(value)).alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .drop("_total")
    )
    # One row a piece of a cut group.
    joined = join_null_safe(numbered, F.broadcast(before), [*keys, "_piece"], "left")
    return joined.withColumn(out, F.col(out) + F.coalesce("_before", F.lit(0))).select(*columns, out)


def _inside(window, value: str | None) -> Column:
    if value is None:
        return (F.row_number().over(window) - 1).cast("long")
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _tuple(df: DataFrame, order: Sequence[str]) -> Column:
    """What pieces are cut by: the sorting columns, then a hash of all columns."""
    return F.struct(*order, F.xxhash64(*df.columns).alias("_tie"))


def _cuts(df: DataFrame, keys: list[str], order: Sequence[str], limit: int) -> DataFrame:
    """``_cuts`` of the groups that have some: quantiles of a sample that the rows' hashes choose.

    A group of up to ``limit`` rows has too small a share of the sample for a cut, or for more than one.
    Equal rows are chosen together, so they are counted before a group's sample comes together: what is gathered are
    distinct tuples, and a tuple is a cut where the running count passes the next multiple of ``SAMPLES_PER_PIECE``.
    """
    every = F.greatest(F.floor(F.lit(limit) / SAMPLES_PER_PIECE), F.lit(1))
    sampled = df.filter(F.pmod(F.xxhash64(*df.columns), every) == 0)
    samples = sampled.groupBy(*keys, _tuple(df, order).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    reached = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    passed = F.floor(F.col("_reached") / SAMPLES_PER_PIECE) > F.floor((F.col("_reached") - F.col("_n")) / SAMPLES_PER_PIECE)
    cuts = samples.withColumn("_reached", reached).withColumn("_cut", F.when(passed, F.col("_at")))
    return cuts.filter("_cut IS NOT NULL").groupBy(*keys).agg(F.sort_array(F.collect_list("_cut")).alias("_cuts"))


def _place(cuts: Column, at: Column) -> Column:
    """How many of the sorted ``cuts`` are not above ``at``, by halving."""

    def halve(range_: Column, _: Column) -> Column:
        low, high, sought = range_["low"], range_["high"], range_["sought"]
        middle = F.floor((low + high) / 2).cast("int")
        return (
            F.when(low >= high, range_)
            .when(F.get(cuts, middle) <= sought, F.struct((middle + 1).alias("low"), high.alias("high"), sought.alias("sought")))
            .otherwise(F.struct(low.alias("low"), middle.alias("high"), sought.alias("sought")))
        )

    halvings = F.sequence(F.lit(1), F.length(F.bin(F.size(cuts))))
    # The tuple is carried along: as part of the step it would be put together anew for every halving.
    start = F.struct(F.lit(0).alias("low"), F.size(cuts).alias("high"), at.alias("sought"))
    return F.aggregate(halvings, start, halve)["low"]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
