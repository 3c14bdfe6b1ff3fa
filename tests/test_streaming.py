from __future__ import annotations

import json
import os
import random
import time

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import as_set, replay_windows, sample, samples
from tripsense.catalog.queries import speed_rule
from tripsense.functions.features import feature_aggregates, fill_missing, with_magnitudes
from tripsense.operators.windows import count_windows
from tripsense.sources import messages, schemas, tables
from tripsense.streaming.count_windows import TripBuffer, leftover_windows, stream_count_windows
from tripsense.streaming.ingest import start_message_ingest, start_rejects
from tripsense.operators.latest import latest_trip_state
from tripsense.streaming.latest import _layers, each_once, prediction_feed, read_latest_state, start_latest_state
from tripsense.streaming.predict import prediction_messages, start_predictions, topic_messages
from tripsense.streaming.sinks import parquet_batches, read_batches, start_batches

LENGTHS = {1: 1, 2: 9, 3: 10, 4: 14, 5: 16, 6: 37}


def write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    hidden = os.path.join(os.path.dirname(path), f"_{os.path.basename(path)}")
    with open(hidden, "w") as out:
        out.writelines((row if isinstance(row, str) else json.dumps(row)) + "\n" for row in rows)
    os.rename(hidden, path)


def message(bookingid, second, **channels):
    return dict(zip(schemas.RAW_SCHEMA.names, sample(bookingid, second, **channels)))


def trip_messages():
    """Trips in time order, interleaved."""
    rows = [message(trip, s, speed=trip + s % 3, gyro_x=None if s == 2 else 1.5) for trip, n in LENGTHS.items() for s in range(n)]
    return sorted(rows, key=lambda r: (r["second"], r["bookingid"]))


def sample_stream(spark, path, per_trigger=1):
    parsed = messages.parse_messages(messages.read_json_lines(spark, path, max_files_per_trigger=per_trigger))
    return parsed.filter("NOT rejected").select(*schemas.RAW_SCHEMA.names)


def run_windows(spark, folder, name="w"):
    windows = stream_count_windows(sample_stream(spark, folder("in")), idle_seconds=None)
    start_batches(windows, parquet_batches(folder(name)), folder(f"{name}-checkpoint")).awaitTermination()
    return read_batches(spark, folder(name), windows.schema)


def window_seconds(rows):
    got = {}
    for r in rows.collect():
        got.setdefault((r["bookingid"], r["window_idx"]), []).append(r["second"])
    return {key: sorted(seconds) for key, seconds in got.items()}


def full_windows():
    return {
        (trip, k): [float(s) for s in w]
        for trip, n in LENGTHS.items()
        for k, w in enumerate(replay_windows(range(n)))
        if len(w) == 10
    }


def test_windows_over_several_batches_equal_a_replayed_buffer(spark, folder):
    rows = trip_messages()
    for i in range(0, len(rows), 23):
        batch = rows[i:i + 23]
        random.Random(i).shuffle(batch)
        write_lines(folder("in") + f"/{i:04d}.json", batch)
        os.utime(folder("in") + f"/{i:04d}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    got = run_windows(spark, folder)
    assert window_seconds(got) == full_windows()
    assert got.filter("is_tail").count() == 0
    # null survives the trip through the state, and does not turn into NaN or 0
    assert got.filter("second = 2").filter("gyro_x IS NOT NULL").count() == 0
    assert got.filter("second <> 2").filter("gyro_x <> 1.5 OR gyro_x IS NULL").count() == 0


def test_restart_continues_from_the_checkpoint(spark, folder):
    rows = trip_messages()
    write_lines(folder("in") + "/a.json", rows[:50])
    first = run_windows(spark, folder).count()
    write_lines(folder("in") + "/b.json", rows[50:])
    got = run_windows(spark, folder)
    assert 0 < first < got.count()
    assert window_seconds(got) == full_windows()


def test_idle_trips_are_flushed_without_new_messages(spark, folder):
    write_lines(folder("in") + "/a.json", trip_messages())
    windows = stream_count_windows(sample_stream(spark, folder("in")), idle_seconds=2)
    query = start_batches(windows, parquet_batches(folder("w")), folder("c"), trigger={"processingTime": "1 second"})
    expected = {
        (trip, k): [float(s) for s in w] for trip, n in LENGTHS.items() for k, w in enumerate(replay_windows(range(n)))
    }
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            time.sleep(2)
            assert query.exception() is None
            got = window_seconds(read_batches(spark, folder("w"), windows.schema)) if os.path.exists(folder("w")) else {}
            if len(got) == len(expected):
                break
    finally:
        query.stop()
    assert got == expected
    tails = read_batches(spark, folder("w"), windows.schema).filter("is_tail")
    assert tails.select("bookingid").distinct().count() == len(LENGTHS)


def test_stream_and_batch_predictions_agree(spark, folder):
    rows = trip_messages()
    write_lines(folder("in") + "/a.json", rows)
    start_predictions(
        sample_stream(spark, folder("in")), speed_rule, parquet_batches(folder("p")), folder("c"), idle_seconds=None
    ).awaitTermination()
    schema = "bookingid long, window_idx long, is_tail boolean, time double, speed double, label int"
    got = read_batches(spark, folder("p"), spark.createDataFrame([], schema).schema).drop("batch_id")
    batch = count_windows(
        with_magnitudes(samples(spark, [tuple(r.values()) for r in rows])), feature_aggregates(), order=["second"]
    )
    expected = prediction_messages(speed_rule(fill_missing(batch)), "window_idx", "is_tail").filter("NOT is_tail")
    assert as_set(got) == as_set(expected)


def test_message_ingest_rejects_and_survives_redelivery(spark, folder):
    good = [message(1, s, speed=s) for s in range(4)]
    bad = ["not json", {"second": 1}, {"bookingid": 1, "speed": 2}]
    write_lines(folder("in") + "/a.json", [*good, *bad, message(1, 0, speed=0)])
    for checkpoint in ("c1", "c2"):  # the second run delivers everything again
        start_message_ingest(
            messages.read_json_lines(spark, folder("in")), folder("raw"), folder(f"rejects-{checkpoint}"),
            folder(checkpoint), arrival=["speed"],
        ).awaitTermination()
    got = tables.read_raw(spark, folder("raw")).select("bookingid", "second", "speed")
    assert as_set(got) == [(1, float(s), float(s)) for s in range(4)]
    assert spark.read.parquet(folder("rejects-c1")).count() == 3


def test_rejects_have_a_stream_of_their_own(spark, folder):
    write_lines(folder("in") + "/a.json", [message(1, 0), "not json", {"second": 1}, {"bookingid": 1, "second": 1, "speed": "fast"}])
    start_rejects(messages.read_json_lines(spark, folder("in")), parquet_batches(folder("out")), folder("c")).awaitTermination()
    assert spark.read.parquet(folder("out")).count() == 3


def test_leftovers_complete_an_ended_stream(spark, folder):
    rows = trip_messages()
    write_lines(folder("in") + "/a.json", rows)
    parsed = messages.parse_messages(messages.read_json_lines(spark, folder("in"))).select(*schemas.RAW_SCHEMA.names)
    stream = stream_count_windows(parsed, idle_seconds=None)
    start_batches(stream, parquet_batches(folder("rows")), folder("c")).awaitTermination()
    full = read_batches(spark, folder("rows"), stream.schema).drop("batch_id")
    got = full.unionByName(leftover_windows(spark, folder("c"), stream.schema))
    expected = count_windows(samples(spark, [tuple(r.values()) for r in rows]), [F.max("second").alias("last")], order=["second"])
    summary = got.groupBy("bookingid", "window_idx", "is_tail").agg(F.count("*").alias("rows"), F.max("second").alias("last"))
    columns = ["bookingid", "window_idx", "is_tail", "rows", "last"]
    assert as_set(summary.select(*columns)) == as_set(expected.select(*columns))


def test_latest_state_over_batches(spark, folder):
    schema = "bookingid long, seq long, speed double, time double, label int, has_label boolean"

    def run(rows, name):
        write_lines(folder("in") + f"/{name}.json", [dict(zip(("bookingid", "seq", "speed", "time", "label", "has_label"), r)) for r in rows])
        stream = spark.readStream.schema(schema).json(folder("in"))
        start_latest_state(stream, "seq", folder("s"), folder("c"), label_present="has_label").awaitTermination()
        return {r["bookingid"]: (r["speed"], r["time"], r["label"]) for r in read_latest_state(spark, folder("s"), "seq").collect()}

    assert run([(1, 1, 5.0, 1.0, 1, True), (2, 2, 6.0, 1.0, 0, True)], "a") == {1: (5, 1, 1), 2: (6, 1, 0)}
    assert run([(1, 3, 0.0, 2.0, None, False)], "b") == {1: (5, 2, 1), 2: (6, 1, 0)}
    assert run([(2, 4, 7.0, None, None, True)], "c") == {1: (5, 2, 1), 2: (7, 1, None)}


@pytest.mark.parametrize("snapshot_every, keep", [(1, None), (3, None), (4, 40)])
def test_layered_view_equals_all_messages(spark, folder, snapshot_every, keep):
    """After every few batches: the view is that of all messages, and old layers are gone."""
    rng = random.Random(snapshot_every)
    schema = "bookingid long, seq long, speed double, time double, label int, has_label boolean"
    names, rows, seq = schema.replace(",", "").split()[::2], [], 0
    for part in range(7):
        fresh = []
        for _ in range(15):
            seq += 1
            fresh.append((rng.randint(1, 12) + 5 * part, seq, rng.choice([None, 0.0, 2.5, 7.0]), rng.choice([None, 1.0, 3.0]), rng.choice([None, 0, 1]), rng.random() < 0.7))
        rows += fresh
        write_lines(folder("in") + f"/{part}.json", [dict(zip(names, r)) for r in fresh])
        stream = spark.readStream.schema(schema).json(folder("in"))
        start_latest_state(
            stream, "seq", folder("s"), folder("c"), label_present="has_label", snapshot_every=snapshot_every, keep=keep
        ).awaitTermination()
    wanted = {r["bookingid"]: tuple(r) for r in latest_trip_state(spark.createDataFrame(rows, schema), "seq", label_present="has_label").collect()}
    got = {r["bookingid"]: tuple(r) for r in read_latest_state(spark, folder("s"), "seq").collect()}
    if keep is None:
        assert got == wanted
    else:  # the last snapshot was made at batch 3, of 60 messages
        assert got.items() <= wanted.items() and {k for k, r in wanted.items() if r[-1] >= 60 - keep} <= set(got)
        assert set(wanted) - set(got)
    done, folders = _layers(spark, folder("s"))
    assert len([f for f in folders if "/changes/" in f]) < snapshot_every and len(os.listdir(folder("s") + "/snapshots")) <= 2 + (done < 0)


def test_repeated_predictions_are_dropped(spark, folder):
    """A batch published again, with later timestamps, and another window of the same trip."""
    def published(batch_id, windows, at):
        rows = spark.createDataFrame([(7, w, False, 1.0 * w, 2.0, 1) for w in windows], "bookingid long, window_idx long, is_tail boolean, time double, speed double, label int")
        return topic_messages(rows, batch_id).withColumn("timestamp", F.timestamp_seconds(F.lit(at)))

    for name, part in (("a", published(0, [0, 1], 1000)), ("b", published(0, [0, 1], 1060)), ("c", published(1, [1, 2], 1100))):
        part.write.parquet(f"{folder('in')}/{name}")
        stream = spark.readStream.schema(part.schema).parquet(f"{folder('in')}/*")
        feed = each_once(prediction_feed(stream))
        start_batches(feed, parquet_batches(folder("out")), folder("check")).awaitTermination()
    got = read_batches(spark, folder("out"), T.StructType([T.StructField("window_idx", T.LongType()), T.StructField("time", T.DoubleType())]))
    assert sorted((r["window_idx"], r["time"]) for r in got.collect()) == [(0, 0.0), (1, 1.0), (1, 1.0), (2, 2.0)]


class FakeHandle:
    """State, timer and clock of one trip."""

    def __init__(self):
        self.value, self.due, self.now = None, None, 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, due):
        assert self.due is None and due > self.now
        self.due = due

    def getCurrentProcessingTimeInMs(self):
        return self.now


@pytest.mark.parametrize("size, step", [(10, 5), (4, 4), (6, 1), (1, 1), (5, 3)])
def test_processor_equals_a_replayed_buffer_with_idle_times(size, step):
    """Random batches of a trip against one plain buffer; its timer fires as soon as it is due."""
    rng = random.Random(size * 31 + step)
    idle_ms = 3000
    sample_type = T.StructType([T.StructField("second", T.DoubleType()), T.StructField("x", T.StringType())])
    processor, handle = TripBuffer(sample_type, ["second"], size, step, idle_ms), FakeHandle()
    processor.init(handle)
    arrived_row = Row("bookingid", "second", "x")
    buffer, number, last, expected, got = [], 0, None, [], []

    def run(rows):
        for row in rows:
            assert list(row.__fields__) == ["bookingid", "window_idx", "is_tail", "second", "x"] and row["bookingid"] == 7
            got.append((row["window_idx"], row["is_tail"], row["second"], row["x"]))

    for now in range(1000, 90_000, 1000):
        handle.now = now
        arrived = [(now + rng.random(), rng.choice([None, f"{now}-{i}"])) for i in range(rng.choice([0, 0, 0, 1, 7, 25]))]
        if rng.random() < 0.3:
            arrived = []
        if arrived:
            for row in sorted(arrived, key=lambda r: r[0]):
                buffer.append(row)
                if len(buffer) == size:
                    expected += [(number, False, *r) for r in buffer]
                    buffer, number = buffer[step:], number + 1
            last = now
            run(processor.handleInputRows((7,), iter([arrived_row(7, *row) for row in arrived]), handle))
        if handle.due is not None and handle.due <= now:
            handle.due = None
            run(processor.handleExpiredTimer((7,), handle, None))
        if last is not None and now - last > idle_ms:
            expected += [(number, True, *r) for r in buffer]
            buffer, number, last = [], 0, None
            assert handle.value is None and handle.due is None
    assert got == expected
    assert any(tail for _, tail, _, _ in got) == (size > 1)


def test_prediction_feed_tells_null_from_absent(spark):
    texts = [
        (0, '{"bookingid": 1, "time": 3.0, "speed": 2.5, "label": 1}'),
        (1, '{"bookingid": 1, "time": 4.0, "speed": 0}'),
        (2, '{"bookingid": 2, "time": 4.0, "speed": 1, "label": 1}'),
        (3, '{"bookingid": 2, "label": null}'),
        (4, "broken"),
    ]
    feed = prediction_feed(spark.createDataFrame(texts, "offset long, value string"))
    got = {r["bookingid"]: (r["speed"], r["time"], r["label"]) for r in
           latest_trip_state(feed, "offset", label_present="has_label").collect()}
    assert got == {1: (2.5, 4.0, 1), 2: (1.0, 4.0, None)}


def test_served_model_is_swapped_between_batches(spark, folder):
    """The scorer is asked at every batch, so a promotion shows from the next batch on."""
    versions = iter([0.0, 1.0])

    def scorer(features):
        return features.withColumn("prediction", F.lit(next(versions)))

    rows = [message(trip, s) for s in range(20) for trip in (1, 2)]
    for name, part in (("a", rows[:20]), ("b", rows[20:])):
        write_lines(folder("in") + f"/{name}.json", part)
        start_predictions(
            sample_stream(spark, folder("in")), scorer, parquet_batches(folder("p")), folder("c"), idle_seconds=None
        ).awaitTermination()
    schema = "bookingid long, window_idx long, is_tail boolean, time double, speed double, label int"
    got = read_batches(spark, folder("p"), spark.createDataFrame([], schema).schema)
    assert {(r["window_idx"], r["label"]) for r in got.collect()} == {(0, 0), (1, 1), (2, 1)}


def test_window_parameters_are_checked(spark):
    with pytest.raises(ValueError):
        stream_count_windows(spark.createDataFrame([], "bookingid long, second double"), size=3, step=4)


def test_replayed_batch_replaces_its_output(spark, folder):
    writer = parquet_batches(folder("b"))
    for rows in ([(1,), (2,)], [(1,)]):
        writer(spark.createDataFrame(rows, "x long"), 4)
    got = read_batches(spark, folder("b"), spark.createDataFrame([], "x long").schema)
    assert as_set(got.select("x", F.col("batch_id"))) == [(1, 4)]
