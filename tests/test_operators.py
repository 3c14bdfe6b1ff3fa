from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import as_set, replay_windows, sample, samples
from tripsense.operators import dashboard, labels, trips
from tripsense.operators.first_writer import first_writer_wins
from tripsense.operators.latest import latest_trip_state
from tripsense.operators.windows import count_windows
from tripsense.plans.consolidate import consolidate

LENGTHS = [1, 4, 5, 6, 9, 10, 11, 14, 15, 16, 20, 21, 57]


@pytest.mark.parametrize("size, step", [(10, 5), (10, 10), (7, 3), (4, 1), (1, 1), (10, 9)])
@pytest.mark.parametrize("group_rows", [1000, 3])
def test_count_windows_equal_a_replayed_buffer(spark, size, step, group_rows):
    rows = [(trip, second) for trip, length in enumerate(LENGTHS) for second in range(length)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "bookingid long, second long").repartition(3)
    got = count_windows(
        df, [F.min("second").alias("first"), F.max("second").alias("last")],
        order=["second"], size=size, step=step, group_rows=group_rows,
    )
    expected = [
        (trip, k, len(w), w[0], w[-1], len(w) < size)
        for trip, length in enumerate(LENGTHS)
        for k, w in enumerate(replay_windows(range(length), size, step))
    ]
    assert as_set(got) == sorted(expected)


def test_window_parameters_are_checked(spark):
    df = spark.createDataFrame([], "bookingid long, second long")
    for size, step in [(5, 6), (5, 0)]:
        with pytest.raises(ValueError):
            count_windows(df, [F.count("second")], order=["second"], size=size, step=step)


def test_unique_labels_drop_every_copy(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (3, None), (4, 0), (4, 1)], "bookingid long, label int")
    assert set(map(tuple, labels.unique_labels(df).collect())) == {(1, 0), (3, None)}
    assert as_set(labels.label_multiplicity(df)) == [(1, 1), (2, 2), (3, 1), (4, 2)]
    assert labels.label_classes(df).first()[0] == 3


def test_pending_samples_null_rules(spark):
    rows = samples(spark, [sample(1, 0), sample(2, 0), sample(None, 0)])
    done = spark.createDataFrame([(1,), (None,)], "bookingid long")
    assert [r[0] for r in trips.pending_samples(rows, done).collect()] == [2]
    assert {r[0] for r in trips.pending_samples(rows, done.limit(0)).collect()} == {1, 2}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_consolidate(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        check_consolidation(spark)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("threshold, below", [("10m", True), ("-1", False)])
def test_done_trips_are_dropped_in_the_scan_only_while_their_ids_are_small(spark, folder, threshold, below):
    samples(spark, [sample(1, 0)]).write.parquet(folder("raw"))
    spark.createDataFrame([(1,)], "bookingid long").write.parquet(folder("done"))
    marks = spark.createDataFrame([], "bookingid long, label int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = consolidate(spark.read.parquet(folder("raw")), spark.read.parquet(folder("done")), marks)
        text = plan._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (text.index("LeftAnti") > text.index("avg(speed")) == below  # printed top down


def check_consolidation(spark):
    rows = [sample(trip, second, speed=trip) for trip in (1, 2, 3, 4) for second in range(3)] + [sample(5, 0, speed=5)]
    rows.append(sample(None, 0))
    done = spark.createDataFrame([(4,)], "bookingid long")
    marks = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (9, 1)], "bookingid long, label int")
    filled = consolidate(samples(spark, rows), done, marks)
    got = {r["bookingid"]: (r["avg_speed"], r["std_speed"], r["second"], r["label"]) for r in filled.collect()}
    assert got == {1: (1, 0, 2, 1), 2: (2, 0, 2, 0), 3: (3, 0, 2, 0), 5: (5, 0, 0, 0)}
    open_labels = consolidate(samples(spark, rows), done, marks, fill_label=False)
    assert {r["bookingid"]: (r["std_speed"], r["label"]) for r in open_labels.collect()} == {
        1: (0, 1), 2: (0, None), 3: (0, None), 5: (0, None)
    }


def test_lookup_card_and_first_trips(spark):
    df = spark.createDataFrame([(7, *[1.23456] * 7)], ["bookingid", *trips.CARD_COLUMNS])
    assert trips.trip_lookup(df, 7).count() == 1 and trips.trip_lookup(df, 8).count() == 0
    assert set(trips.trip_summary_card(df).first()[1:]) == {1.23}
    rows = samples(spark, [sample(i, s) for i in (9, 3, 5, 1, 4) for s in range(2)] + [sample(None, 0)])
    assert {r[0] for r in trips.first_trips(rows).collect()} == {1, 3, 4}


def test_ordered_samples(spark):
    rows = samples(spark, [sample(i, s) for i in (2, 1) for s in (3, 1, 2)]).repartition(3)
    got = [(r["bookingid"], r["second"]) for r in trips.ordered_samples(rows).collect()]
    assert got == [(i, float(s)) for i in (1, 2) for s in (1, 2, 3)]


@pytest.mark.parametrize("group_rows", [1000, 5])
def test_sequences_are_chunks_of_the_ordered_trip(spark, group_rows):
    rows = samples(spark, [sample(1, s, speed=s * 2) for s in range(53)] + [sample(2, 0, speed=9)]).repartition(4)
    chunks = trips.trip_sequences(rows, chunk_rows=20, group_rows=group_rows).orderBy("bookingid", "chunk").collect()
    assert [(c["bookingid"], c["chunk"], len(c["records"])) for c in chunks] == [(1, 0, 20), (1, 1, 20), (1, 2, 13), (2, 0, 1)]
    whole = [r for c in chunks[:3] for r in c["records"]]
    assert [(r["second"], r["speed"]) for r in whole] == [(float(s), s * 2.0) for s in range(53)]


def test_first_writer_wins_even_when_one_key_dominates(spark):
    rows = [(1, 0.0, 100 - i, float(i)) for i in range(90)] + [(1, 1.0, 5, 7.0), (2, 0.0, 1, None), (2, 0.0, 2, 3.0)]
    df = spark.createDataFrame(rows, "bookingid long, second double, arrival long, speed double").repartition(4)
    kept = first_writer_wins(df, ["bookingid", "second"], ["arrival"])
    assert set(map(tuple, kept.collect())) == {(1, 0.0, 11, 89.0), (1, 1.0, 5, 7.0), (2, 0.0, 1, None)}
    assert "partial_min" in kept._jdf.queryExecution().executedPlan().toString()


def test_latest_state_keeps_previous_value_for_falsy_fields(spark):
    rows = [
        (1, 1, 5.0, 10.0, 1, True),
        (1, 2, 0.0, None, None, False),  # nothing usable: all stays
        (2, 3, 4.0, 1.0, 0, True),
        (2, 4, None, 2.0, None, True),  # a null label is a label
        (3, 5, 0.0, 0.0, None, False),
    ]
    df = spark.createDataFrame(rows, "bookingid long, seq long, speed double, time double, label int, has_label boolean")
    got = {r["bookingid"]: (r["speed"], r["time"], r["label"]) for r in
           latest_trip_state(df, "seq", label_present="has_label").collect()}
    assert got == {1: (5.0, 10.0, 1), 2: (4.0, 2.0, None), 3: (None, None, None)}
    always = {r["bookingid"]: r["label"] for r in latest_trip_state(df, "seq").collect()}
    assert always == {1: None, 2: None, 3: None}


def test_dashboard_bucket_edges(spark):
    speeds = [0.0, -1.0, 0.001, 5.0, 5.001, 10.0, 15.0, 20.0, 25.0, 25.01, None, float("nan")]
    durations = [0.0, 600.0, 600.5, 1800.0, 1801.0, float("nan"), None, 1.0, 1.0, 1.0, 1.0, 1.0]
    marks = [0, 1, 2, None, 0, 0, 0, 0, 0, 0, 0, 0]
    df = spark.createDataFrame(
        list(zip(speeds, speeds, durations, marks)), "avg_speed double, std_speed double, second double, label int"
    )

    def counts(panel):
        return [r["trips"] for r in panel.orderBy("position").collect()]

    assert counts(dashboard.trip_speed_histogram(df)) == [2, 2, 1, 1, 1]
    assert counts(dashboard.trip_speed_std_histogram(df)) == [2, 2, 1, 1, 1]
    assert counts(dashboard.trip_duration_buckets(df)) == [6, 2, 1]
    assert counts(dashboard.trip_safety_counts(df)) == [9, 1]
    empty = dashboard.trip_dashboard(df.limit(0)).collect()
    assert len(empty) == 15 and all(r["trips"] == 0 for r in empty)


def test_dashboard_is_one_scan(spark, folder):
    path = folder("trips")
    spark.createDataFrame([(1.0, 1.0, 1.0, 0, "x")], "avg_speed double, std_speed double, second double, label int, note string").write.parquet(path)
    plan = dashboard.trip_dashboard(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "note" not in plan
