"""Rows that break a table's contract, told from those that keep it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripsense.operators.ordering import with_prefix
from tripsense.sources.schemas import required_columns


def routed(batch: DataFrame, schema: T.StructType, key: Sequence[str], arrival: Sequence[str] = ()) -> DataFrame:
    """``row``, ``source`` and ``violations`` for every row of ``batch``, none left out.

    ``row`` has the schema's columns in its types, ``source`` the given values, ``violations`` the rules that the row breaks:
    ``missing:c`` for a column that the batch does not have, ``type:c`` for a value that is not of the column's type, ``null:c``
    for a required column without a value, and ``key`` where an earlier row by ``arrival`` (then by all values) that keeps
    the other rules has the same key. A row without violations can be stored as it is.

    One pass over the batch, and one exchange by key; a key with very many rows is cut as in ``with_prefix``.
    """
    found = set(batch.columns)
    values, rules = [], []
    for field in schema.fields:
        if field.name not in found:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            rules.append(F.lit(f"missing:{field.name}"))
            continue
        cast = F.col(field.name).try_cast(field.dataType)
        values.append(cast.alias(field.name))
        rules.append(F.when(F.col(field.name).isNotNull() & cast.isNull(), F.lit(f"type:{field.name}")))
    for name in required_columns(schema):
        if name in found:
            rules.append(F.when(F.col(name).isNull(), F.lit(f"null:{name}")))
    judged = batch.select(
        F.struct(*values).alias("row"), F.struct(*batch.columns).alias("source"), F.array_compact(F.array(*rules)).alias("violations")
    )
    keyed = judged.select(
        "*", *[F.col(f"row.{name}").alias(f"_key_{name}") for name in key], (F.size("violations") > 0).alias("_bad"),
        *[F.col(f"source.{name}").alias(f"_arrival_{n}") for n, name in enumerate(arrival)],
    )
    order = ["_bad", *[f"_arrival_{n}" for n in range(len(arrival))], "source"]
    ranked = with_prefix(keyed, [f"_key_{name}" for name in key], order, out="_earlier")
    repeated = (F.col("_earlier") > 0) & ~F.col("_bad")
    return ranked.select(
        "row", "source", F.when(repeated, F.array(F.lit("key"))).otherwise(F.col("violations")).alias("violations")
    )
