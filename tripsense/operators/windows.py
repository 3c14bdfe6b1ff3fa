"""Count-based sliding windows over each trip's samples."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsense.operators.ordering import GROUP_ROWS, with_prefix

# Rows per window, rows dropped after each full window, idle seconds before the rest is flushed.
WINDOW_SIZE = 10
WINDOW_STEP = 5
IDLE_SECONDS = 30


def check_window(size: int, step: int) -> None:
    if not 1 <= step <= size:
        raise ValueError(f"need 1 <= step <= size, got size={size}, step={step}")


def count_windows(
    samples: DataFrame,
    aggregates: Sequence[Column],
    *,
    order: Sequence[str],
    size: int = WINDOW_SIZE,
    step: int = WINDOW_STEP,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per ``(bookingid, window_idx)`` with ``rows``, ``is_tail`` and the aggregates.

    ``prepare`` adds columns the aggregates use; it runs after the exchange, so they are not shuffled.

    A row with ``r`` rows before it lies in windows ``ceil((r - size + 1) / step) .. floor(r / step)``. Past the
    end of a trip this also opens windows that the sliding buffer never would: window ``k > 0`` exists only
    when window ``k - 1`` was full, which is the case exactly when ``k`` holds at least ``size - step`` rows. So
    the trip length is not needed, and the filter below does the rest.
    """
    check_window(size, step)
    rank = F.col("_rank")
    first = F.greatest(F.ceil((rank - size + 1) / step), F.lit(0)).cast("long")
    last = F.floor(rank / step).cast("long")
    ranked = with_prefix(samples, ["bookingid"], order, out="_rank", group_rows=group_rows)
    return (
        (prepare(ranked) if prepare else ranked)
        .withColumn("window_idx", F.explode(F.sequence(first, last)))
        .groupBy("bookingid", "window_idx")
        .agg(F.count(F.lit(1)).alias("rows"), *aggregates)
        .filter((F.col("window_idx") == 0) | (F.col("rows") >= size - step))
        .withColumn("is_tail", F.col("rows") < size)
    )
