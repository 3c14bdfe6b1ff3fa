from __future__ import annotations

import math
import statistics

import pytest
from pyspark.sql import functions as F

from helpers import sample, samples
from tripsense.functions import features, scalars
from tripsense.sources.schemas import TRIP_SCHEMA


def test_columns_are_those_of_the_trip_table():
    assert ["bookingid", *features.FEATURE_COLUMNS, "label"] == TRIP_SCHEMA.names
    assert len(features.FEATURES) == 25


def test_magnitudes(spark):
    row = features.with_magnitudes(
        samples(spark, [sample(1, 0, acceleration_x=3, acceleration_y=4, acceleration_z=12, gyro_y=-2)])
    ).first()
    assert row["accel_mag"] == 13.0
    assert row["gyro_mag"] == 2.0


def test_mean_deviation_and_maximum(spark):
    speeds = [1.0, 4.0, 9.5, 2.25]
    row = features.trip_features(
        samples(spark, [sample(1, i, speed=s, acceleration_x=-s) for i, s in enumerate(speeds)])
    ).first()
    assert row["avg_speed"] == pytest.approx(statistics.mean(speeds))
    assert row["std_speed"] == pytest.approx(statistics.stdev(speeds))
    assert row["max_accel_x"] == -1.0
    assert row["second"] == 3.0


def test_single_row_trip_has_no_deviation_until_filled(spark):
    trip = features.trip_features(samples(spark, [sample(1, 0, speed=5)]))
    assert trip.first()["std_speed"] is None
    assert features.fill_missing(trip).first()["std_speed"] == 0.0


def test_nan_spreads_then_becomes_zero_and_null_is_skipped(spark):
    rows = [
        sample(1, 0, speed=float("nan"), gyro_x=2),
        sample(1, 1, speed=3, gyro_x=None),
        sample(1, 2, speed=4, gyro_x=4, acceleration_z=float("nan")),
    ]
    trip = features.trip_features(samples(spark, rows))
    raw, filled = trip.first(), features.fill_missing(trip).first()
    assert math.isnan(raw["avg_speed"]) and math.isnan(raw["max_accel_z"])
    assert filled["avg_speed"] == filled["max_accel_z"] == filled["std_speed"] == 0.0
    assert raw["avg_gyro_x"] == 3.0


def test_fill_covers_label_and_id_and_keeps_types(spark):
    df = spark.createDataFrame([(None, None, None, "x")], "bookingid long, speed double, label int, note string")
    filled = features.fill_missing(df)
    assert tuple(filled.first()) == (0, 0.0, 0, "x")
    assert filled.dtypes == df.dtypes


def test_features_by_window_use_the_same_definition(spark):
    rows = samples(spark, [sample(1, i, speed=i) for i in range(4)]).withColumn("window_idx", F.col("second") % 2)
    by_window = features.trip_features(rows, ["bookingid", "window_idx"])
    assert sorted((r["window_idx"], r["avg_speed"]) for r in by_window.collect()) == [(0.0, 1.0), (1.0, 2.0)]


def test_partial_aggregation_precedes_the_exchange(spark):
    plan = features.trip_features(samples(spark, [sample(1, 0)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_avg")  # printed top down
    assert plan.count("Exchange") == 1


def test_normalise_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "bookingID long, Speed double")
    assert scalars.normalise_columns(df).columns == ["bookingid", "speed"]
    with pytest.raises(ValueError, match="collide"):
        scalars.normalise_columns(spark.createDataFrame([(1, 2)], "a long, b long").toDF("X", "x"))


def test_trip_status(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "label int")
    got = [r[0] for r in df.select(scalars.trip_status("label")).collect()]
    assert got == [scalars.SAFE_MESSAGE, scalars.DANGER_MESSAGE, scalars.DANGER_MESSAGE, None]
