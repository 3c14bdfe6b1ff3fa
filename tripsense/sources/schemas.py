"""Fixed schemas of stored tables and messages, and the checks of the table contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripsense.functions.features import FEATURE_COLUMNS

# Columns of the sample table and of each message on the input topic.
RAW_CHANNELS = (
    "accuracy",
    "bearing",
    "acceleration_x",
    "acceleration_y",
    "acceleration_z",
    "gyro_x",
    "gyro_y",
    "gyro_z",
    "second",
    "speed",
)
RAW_KEY = ("bookingid", "second")
TRIP_KEY = ("bookingid",)

RAW_SCHEMA = T.StructType(
    [T.StructField("bookingid", T.LongType(), False)]
    + [T.StructField(name, T.DoubleType(), name not in RAW_KEY) for name in RAW_CHANNELS]
)
TRIP_SCHEMA = T.StructType(
    [T.StructField("bookingid", T.LongType(), False)]
    + [T.StructField(name, T.DoubleType(), name == "second") for name in FEATURE_COLUMNS]
    + [T.StructField("label", T.IntegerType(), True)]
)
LABEL_SCHEMA = T.StructType(
    [T.StructField("bookingid", T.LongType(), False), T.StructField("label", T.IntegerType(), True)]
)
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("bookingid", T.LongType(), False),
        T.StructField("time", T.DoubleType(), True),
        T.StructField("speed", T.DoubleType(), True),
        T.StructField("label", T.IntegerType(), True),
    ]
)
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("alias", T.StringType(), True),
    ]
)


def optional(schema: T.StructType) -> T.StructType:
    """The same fields, all nullable: what a parser of outside data can promise."""
    return T.StructType([T.StructField(field.name, field.dataType, True) for field in schema.fields])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema's columns by name, in its order, cast to its types."""
    missing = [field.name for field in schema.fields if field.name not in df.columns]
    if missing:
        raise ValueError(f"columns not found in data: {missing}")
    return df.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields])


def contract_report(df: DataFrame, not_null: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``rule, violations``: null values per required column, and keys held by more than one row.

    One scan and one exchange: rows are first counted per key together with their nulls, then summed.
    """
    nulls = [F.count_if(F.col(name).isNull()).alias(f"_null{i}") for i, name in enumerate(not_null)]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"), *nulls)
    totals = per_key.agg(
        F.count_if(F.col("_copies") > 1).alias("_repeated"),
        *[F.coalesce(F.sum(f"_null{i}"), F.lit(0)).alias(f"_null{i}") for i in range(len(not_null))],
    )
    rules = [(f"not_null:{name}", f"_null{i}") for i, name in enumerate(not_null)]
    rules.append((f"unique:{','.join(key)}", "_repeated"))
    return totals.select(
        F.inline(
            F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(column).alias("violations")) for rule, column in rules])
        )
    )


def type_report(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``rule, violations``: 1 for every column of the schema that is missing or of another type, else 0."""
    found = {field.name: field.dataType for field in df.schema.fields}
    rules = [
        F.struct(
            F.lit(f"type:{field.name}").alias("rule"),
            F.lit(int(found.get(field.name) != field.dataType)).cast("long").alias("violations"),
        )
        for field in schema.fields
    ]
    return df.sparkSession.range(1).select(F.inline(F.array(*rules)))


def table_report(df: DataFrame, schema: T.StructType, key: Sequence[str]) -> DataFrame:
    """All rules of a stored table: its columns' types, its required columns and its key."""
    return type_report(df, schema).unionByName(contract_report(df, required_columns(schema), key))


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]
