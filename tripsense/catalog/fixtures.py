"""Telemetry-shaped views over the given tables, once for Spark and once as SQL text for the oracle."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tripsense.operators.ordering import with_prefix

_CHANNELS = {
    "speed": "l_quantity * (l_partkey % 5) * PI() / 16",
    "accuracy": "l_tax * PI() * 50",
    "bearing": "l_suppkey * 3.6e0",
    "acceleration_x": "(l_discount - 0.05e0) * PI() * 20",
    "acceleration_y": "(l_tax - 0.04e0) * PI() * 20",
    "acceleration_z": "9.81e0 + (l_linenumber - 4) * PI() / 10",
    "gyro_x": "(l_quantity - 25) * PI() / 100",
    "gyro_y": "(l_discount - 0.05e0) * PI()",
    "gyro_z": "(l_linenumber - 4) * PI() / 30",
}
_RAW_ORDER = (
    "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_suppkey", "l_quantity", "l_discount", "l_tax",
)
_RAW_COLUMNS = ", ".join(f"{expression} AS {name}" for name, expression in _CHANNELS.items())

# Of four neighbouring keys two share an id and two stand alone; ids beyond the parts match no trip.
_LABELS = (
    "SELECT CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey - o_orderkey % 2 ELSE o_orderkey END AS bookingid,"
    " CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders"
)
# Every third trip has no speed, and of every third trip each sample is a trip of its own.
_GAPS = (
    "SELECT CASE WHEN bookingid % 3 = 1 THEN 1000000000 + bookingid * 10000 + CAST(second AS BIGINT) ELSE bookingid END"
    " AS bookingid, second, CASE WHEN bookingid % 3 = 2 THEN NULL ELSE speed END AS speed, accuracy, bearing,"
    " acceleration_x, acceleration_y, acceleration_z, gyro_x, gyro_y, gyro_z FROM fx_raw"
)
_DONE = "SELECT p_partkey AS bookingid FROM part WHERE p_partkey % 3 = 0"
_DUP = (
    "SELECT l_orderkey AS bookingid, CAST(l_linenumber AS DOUBLE) AS second, l_quantity * PI() / 8 AS speed,"
    " l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem"
)
# Messages in arrival order. "error" events stand still (speed 0), "signup" carries a null label and "view"
# no label at all.
_STREAM_COLUMNS = {
    "bookingid": "user_id",
    "seq": "event_id",
    "ts": "ts",
    "speed": "CASE WHEN event_type = 'error' THEN 0e0 ELSE value * PI() / 20 END",
    "time": "CASE WHEN event_type = 'click' THEN NULL ELSE value * PI() END",
    "has_label": "event_type <> 'view'",
    "label": "CASE WHEN event_type IN ('view', 'signup') THEN NULL WHEN value > 50 THEN 1 ELSE 0 END",
    "second": "CAST(event_id AS DOUBLE)",
    "accuracy": "value * PI() / 7",
    "bearing": "CAST(event_id % 360 AS DOUBLE)",
    "acceleration_x": "(value - 50) * PI() / 40",
    "acceleration_y": "(event_id % 17 - 8) * PI() / 9",
    "acceleration_z": "9.81e0 + (event_id % 11 - 5) * PI() / 12",
    "gyro_x": "(value - 40) * PI() / 300",
    "gyro_y": "(event_id % 13 - 6) * PI() / 60",
    "gyro_z": "(event_id % 7 - 3) * PI() / 50",
}
_STREAM = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _STREAM_COLUMNS.items()) + " FROM events"
_SCORES = (
    "SELECT l_orderkey AS id, l_returnflag AS model, l_quantity AS score, l_extendedprice AS fine_score,"
    " CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS prediction,"
    " CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END AS label FROM lineitem"
)
_REGISTRY = (
    "SELECT CONCAT('model_', CAST(o_custkey AS STRING)) AS name, CAST(o_orderkey AS STRING) AS version,"
    " CONCAT('run-', CAST(o_orderkey AS STRING)) AS run_id,"
    " CASE WHEN o_orderstatus = 'F' AND o_orderkey % 7 = 0 THEN 'champion'"
    " WHEN o_orderstatus = 'O' THEN 'challenger' END AS alias FROM orders"
)

ORACLE_VIEWS = {
    "fx_raw": (
        "SELECT l_partkey AS bookingid, CAST(20 * (1 + l_partkey % 4) * (ROW_NUMBER() OVER (PARTITION BY l_partkey"
        f" ORDER BY {', '.join(_RAW_ORDER)}) - 1) AS DOUBLE) AS second, {_RAW_COLUMNS} FROM lineitem"
    ),
    "fx_labels": _LABELS,
    "fx_gaps": _GAPS,
    "fx_done": _DONE,
    "fx_dup": _DUP,
    "fx_stream": _STREAM,
    "fx_scores": _SCORES,
    "fx_registry": _REGISTRY.replace("STRING", "VARCHAR"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _view(spark: SparkSession, sf_dir: str, text: str, name: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {name}", "FROM {source}"), source=table(spark, sf_dir, name))


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples, trips = parts; the position in the trip comes from the library's own split ranking."""
    lines = table(spark, sf_dir, "lineitem")
    ranked = with_prefix(lines, ["l_partkey"], _RAW_ORDER, out="_rank")
    return ranked.selectExpr(
        "l_partkey AS bookingid",
        "CAST(20 * (1 + l_partkey % 4) * _rank AS DOUBLE) AS second",
        *[f"{expression} AS {name}" for name, expression in _CHANNELS.items()],
    )


def fx_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_GAPS.replace("FROM fx_raw", "FROM {source}"), source=fx_raw(spark, sf_dir))


def fx_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _LABELS, "orders")


def fx_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _DONE, "part")


def fx_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _DUP, "lineitem")


def fx_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _STREAM, "events")


# A trip may hold a third of all rows; what one micro-batch takes in limits what its key sees at once.
BYTES_PER_TRIGGER = 256 * 1024 * 1024


def _file_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's file watched as a folder of an unbounded source."""
    options = {"pathGlobFilter": f"{name}.parquet", "maxBytesPerTrigger": BYTES_PER_TRIGGER}
    return spark.readStream.schema(table(spark, sf_dir, name).schema).options(**options).parquet(sf_dir)


def fx_stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file_source(spark, sf_dir, "events").selectExpr(*[f"{expression} AS {name}" for name, expression in _STREAM_COLUMNS.items()])


def fx_dup_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _DUP.removeprefix("SELECT ").removesuffix(" FROM lineitem").split(", ")
    return _file_source(spark, sf_dir, "lineitem").selectExpr(*columns)


def fx_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _SCORES, "lineitem")


def fx_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, _REGISTRY, "orders")
