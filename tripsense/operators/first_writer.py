"""Primary-key guard: the first row to arrive for a key stays, later ones are skipped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_writer_wins(rows: DataFrame, key: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One row per key, the least by ``arrival`` (remaining columns break ties, so the result is fixed).

    The minimum of a struct is combined before the exchange, so a key with a third of all rows costs one row
    per map task; ranking the rows of a key would sort them all in one task.
    """
    rest = [name for name in rows.columns if name not in set(key) | set(arrival)]
    row = F.min(F.struct(*arrival, *rest)).alias("_row")
    return rows.groupBy(*key).agg(row).select(*key, "_row.*").select(*rows.columns)
