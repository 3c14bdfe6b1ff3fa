from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from helpers import as_set, sample, samples
from tripsense import session
from tripsense.plans.consolidate import consolidate_job
from tripsense.plans.ingest import ingest_batch
from tripsense.sources import files, jdbc, messages, schemas, tables
from tripsense.streaming.predict import topic_messages


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


HEADER = "bookingID,Accuracy,Bearing,acceleration_x,acceleration_y,acceleration_z,gyro_x,gyro_y,gyro_z,second,Speed\n"


def test_csv_binds_by_name_in_any_case(spark, folder):
    names = HEADER.strip().split(",")[::-1]
    values = ["3.5", "12", "1e-3", "", "0", "9.81", "-1", "2", "90", "8", "1202590843006"]
    write(folder("in") + "/a.csv", ",".join(names) + "\n" + ",".join(values) + "\n")
    row = files.read_samples_csv(spark, folder("in")).first()
    assert row.__fields__ == schemas.RAW_SCHEMA.names
    assert (row["bookingid"], row["speed"], row["gyro_z"], row["gyro_y"], row["accuracy"]) == (1202590843006, 3.5, 0.001, None, 8.0)


def test_csv_with_missing_column_or_other_header(spark, folder):
    write(folder("short") + "/a.csv", "bookingID,second\n1,2\n")
    with pytest.raises(ValueError, match="accuracy"):
        files.read_samples_csv(spark, folder("short"))
    write(folder("mixed") + "/a.csv", "bookingID,label\n1,0\n")
    write(folder("mixed") + "/b.csv", "label,bookingID\n1,7\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_labels_csv(spark, folder("mixed")).collect()


def test_conform_and_contract(spark):
    with pytest.raises(ValueError, match="speed"):
        schemas.conform(spark.createDataFrame([(1, 2.0)], "bookingid long, second double"), schemas.RAW_SCHEMA)
    assert schemas.required_columns(schemas.RAW_SCHEMA) == ["bookingid", "second"]
    assert len(schemas.TRIP_SCHEMA) == 27
    df = spark.createDataFrame([(1, 1.0, None), (1, 1.0, 2.0), (None, 3.0, 1.0)], "bookingid long, second double, speed double")
    report = dict(map(tuple, schemas.contract_report(df, ["bookingid", "speed"], ["bookingid", "second"]).collect()))
    assert report == {"not_null:bookingid": 1, "not_null:speed": 1, "unique:bookingid,second": 1}
    empty = dict(map(tuple, schemas.contract_report(df.limit(0), ["speed"], ["bookingid"]).collect()))
    assert empty == {"not_null:speed": 0, "unique:bookingid": 0}


def test_raw_table_round_trip_and_guarded_insert(spark, folder):
    path = folder("raw")
    assert tables.read_raw(spark, path).count() == 0
    tables.append_raw(samples(spark, [sample(i, s, speed=i) for i in range(20) for s in range(3)]), path)
    assert tables.read_raw(spark, path).columns == schemas.RAW_SCHEMA.names
    assert tables.read_raw(spark, path).count() == 60

    offered = [sample(0, 1, speed=99), sample(0, 3, speed=5)] + [sample(30, 0, speed=i) for i in range(40)]
    batch = samples(spark, offered).withColumn("seq", F.lit(100) - F.col("speed"))
    assert tables.insert_raw(batch, path, ["seq"]) == 3
    assert tables.insert_raw(batch, path, ["seq"]) == 3
    assert tables.insert_raw(batch.limit(0), path, ["seq"]) == 0
    got = tables.read_raw(spark, path).select("bookingid", "second", "speed")
    assert got.count() == 62
    assert as_set(got.filter("bookingid = 30 OR (bookingid = 0 AND second > 0)")) == [
        (0, 1.0, 0.0), (0, 2.0, 0.0), (0, 3.0, 5.0), (30, 0.0, 39.0)
    ]


def big_table(spark, path, commits=12, ids=400):
    """Commits of samples of ever newer trips."""
    table = tables.raw_table(spark, path)
    for k in range(commits):
        rows = spark.range(k * ids, (k + 1) * ids).selectExpr(
            "id * 7919 % 1000003 AS bookingid", "0D AS second", *[f"1D AS {c}" for c in schemas.RAW_CHANNELS if c != "second"]
        )
        table.append(rows)
    return table


def test_small_batch_opens_few_files(spark, folder):
    table = big_table(spark, folder("raw"))
    index = table.index()
    rows, files = index.agg(F.sum("rows"), F.count("*")).first()
    assert rows == table.read().count() == 4800 and files == 12 * 16
    ids = spark.createDataFrame([(i * 7919 % 1000003,) for i in (5, 1700)], "bookingid long")
    opened = table.candidates(ids).agg(F.sum("rows"), F.count("*")).first()
    assert opened[0] < 0.1 * rows and opened[1] >= 2
    assert sorted(r["bookingid"] for r in table.read_ids(ids).collect()) == sorted(r[0] for r in ids.collect())
    unknown = spark.range(2_000_000, 2_000_400).select(F.col("id").alias("bookingid"))
    assert table.candidates(unknown).count() == 0
    inside = spark.range(200).select((F.col("id") * 5003 + 1).alias("bookingid")).join(table.read(), "bookingid", "left_anti")
    assert table.candidates(inside.limit(1)).count() <= 2


def test_no_id_is_missed_by_the_index(spark, folder):
    table = big_table(spark, folder("raw"), commits=2, ids=3000)
    batch = table.read().withColumn("speed", F.lit(9.0))
    assert table.insert(batch) == 6000
    assert table.read().count() == 6000 and table.read().filter("speed = 9").count() == 0


def test_index_says_what_its_files_hold(spark, folder):
    path = folder("raw")
    tables.append_raw(samples(spark, [sample(i % 40, float(i)) for i in range(400)]), path)
    table = tables.raw_table(spark, path)
    index = {row["file"]: row for row in table.index().collect()}
    for name, row in index.items():
        ids = [r["bookingid"] for r in spark.read.parquet(f"{path}/{name}").select("bookingid").collect()]
        assert (row["low"], row["high"], row["rows"], row["ids"]) == (min(ids), max(ids), len(ids), len(set(ids)))
        assert len(row["bloom"]) == -(-len(set(ids)) * 16 // 64)
    assert sum(row["rows"] for row in index.values()) == 400


def test_index_filter_is_laid_out_without_a_lookup_per_word(spark, folder):
    from tripsense.sources import keyed

    path = folder("raw")
    tables.append_raw(samples(spark, [sample(i * 7, float(i)) for i in range(300)]), path)
    table = tables.raw_table(spark, path)
    part = table.state().parts[0]
    plan = table._index_of(part)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "map_from_entries" not in plan
    for row in table.index().collect():
        ids = spark.read.parquet(f"{path}/{row['file']}").select(F.col("bookingid").alias("id")).distinct()
        words = F.lit(len(row["bloom"]))
        expected = [0] * len(row["bloom"])
        for hit in ids.select(keyed._word("id", words).alias("w"), keyed._mask("id").alias("m")).collect():
            expected[hit["w"]] |= hit["m"]
        assert list(row["bloom"]) == expected


def test_a_table_is_read_by_folders_and_a_staged_part_stays_unseen(spark, folder):
    path = folder("raw")
    for n in range(3):
        tables.append_raw(samples(spark, [sample(i, float(n)) for i in range(50)]), path)
    table = tables.raw_table(spark, path)
    before = as_set(table.read())
    folders = table.index().select(F.regexp_extract("file", "^(.*)/", 1)).distinct().count()
    table._stage(samples(spark, [sample(i, 9.0) for i in range(50)]))
    assert as_set(table.read()) == before and len(before) == 150
    assert len({os.path.dirname(f) for f in table.read().inputFiles()}) == folders


def test_cut_off_insert_leaves_no_trace(spark, folder, monkeypatch):
    from tripsense.sources.keyed import KeyedTable

    path = folder("raw")
    batch = samples(spark, [sample(i, 0, speed=i) for i in range(9)])
    tables.append_raw(batch.filter("bookingid < 3"), path)
    with monkeypatch.context() as broken:
        broken.setattr(KeyedTable, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.insert_raw(batch, path, [])
    assert tables.read_raw(spark, path).count() == 3
    for _ in range(2):
        assert tables.insert_raw(batch, path, []) == 9
        assert tables.read_raw(spark, path).count() == 9


def test_overtaken_writer_checks_its_keys_again(spark, folder, monkeypatch):
    from tripsense.sources.keyed import KeyedTable

    path, stage, raced = folder("raw"), KeyedTable._stage, []

    def stage_late(self, rows):
        """Another writer commits between the check of the keys and the commit."""
        part = stage(self, rows)
        if not raced:
            raced.append(True)
            other = samples(spark, [sample(2, 0, speed=99), sample(3, 0, speed=99)])
            assert tables.insert_raw(other, path, []) == 2
        return part

    monkeypatch.setattr(KeyedTable, "_stage", stage_late)
    assert tables.insert_raw(samples(spark, [sample(i, 0, speed=i) for i in range(3)]), path, []) == 3
    assert as_set(tables.read_raw(spark, path).select("bookingid", "speed")) == [(0, 0.0), (1, 1.0), (2, 99.0), (3, 99.0)]
    table = tables.raw_table(spark, path)
    assert table.state().version == 1 and not table._commit(table.state().__class__(0, ()), [])


def shuffle_bytes(spark):
    """What shuffles hold on the disk of a local session."""
    names = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    )
    return sum(os.path.getsize(f.getPath()) for f in names if f.getName().startswith("shuffle_") and os.path.exists(f.getPath()))


def test_insert_leaves_no_exchange_and_no_copy_of_the_batch_on_disk(spark, folder):
    columns = [f"rand({n}) AS {c}" for n, c in enumerate(schemas.RAW_CHANNELS) if c != "second"]
    spark.range(60_000).selectExpr("id % 3000 AS bookingid", "CAST(id AS DOUBLE) AS second", *columns).write.parquet(folder("batch"))
    batch, path = spark.read.parquet(folder("batch")), folder("raw")
    before, setting = shuffle_bytes(spark), spark.conf.get(session.FREE_SHUFFLES, None)
    for _ in range(2):
        assert tables.insert_raw(batch, path, []) == 60_000
    for _ in range(50):  # files go in the background
        if shuffle_bytes(spark) < before + 200_000:
            break
        time.sleep(0.1)
    assert shuffle_bytes(spark) < before + 200_000  # a row takes nearly 80 bytes
    assert os.listdir(f"{path}/batches") == [] and spark.conf.get(session.FREE_SHUFFLES, None) == setting
    assert tables.read_raw(spark, path).count() == 60_000


def test_known_keys_are_found_without_whole_rows(spark, folder):
    path = folder("raw")
    batch = samples(spark, [sample(i, 0, speed=i) for i in range(300)])
    tables.append_raw(batch, path)
    table, asked = tables.raw_table(spark, path), []
    rows = table._kept(batch, "place", "given")
    keep = type(table)._kept

    def noted(self, frame, place, name):
        asked.append(frame.columns)
        return keep(self, frame, place, name)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(table), "_kept", noted)
        assert table._unknown(rows, 300, table.state(), "place").count() == 0
    assert asked == [list(schemas.RAW_KEY)]


@pytest.mark.parametrize("most_broadcast", [1, 1 << 17])
def test_insert_of_odd_keys_in_rounds(spark, folder, monkeypatch, most_broadcast):
    from tripsense.sources import keyed

    monkeypatch.setattr(keyed, "ROUND_ROWS", 8)
    monkeypatch.setattr(keyed, "MOST_BROADCAST", most_broadcast)
    path = folder("raw")
    tables.append_raw(samples(spark, [sample(i, 0, speed=-1) for i in range(20)] * 2), path)  # an appended key may repeat
    offered = [sample(i, 0, speed=i) for i in range(40)]
    offered += [sample(50, -0.0, speed=2), sample(50, 0.0, speed=1), sample(51, -0.0), sample(52, float("nan")), sample(52, float("nan"))]
    offered += [sample(None, 1), sample(None, 1), sample(53, None), sample(53, 1, speed=None)]
    batch = samples(spark, offered).withColumn("note", F.lit(None))
    stored = lambda: tables.read_raw(spark, path).select("bookingid", F.col("second").cast("string"), "speed")
    assert tables.insert_raw(batch, path, []) == 46
    old = [(str(i), "0.0", "-1.0") for i in range(20)] * 2
    new = [(str(i), "0.0", f"{float(i)}") for i in range(20, 40)]
    new += [("50", "0.0", "1.0"), ("51", "0.0", "0.0"), ("52", "NaN", "0.0"), ("53", "1.0", "None")]
    nulls = [("53", "None", "0.0"), ("None", "1.0", "0.0")]
    texts = lambda: sorted(tuple(map(str, row)) for row in stored().collect())
    assert texts() == sorted(old + new + nulls)
    # A key with a null equals none, so it comes in again; of the others none does.
    assert tables.insert_raw(batch, path, []) == 46
    assert texts() == sorted(old + new + nulls * 2)
    # Without copies the rows are not reduced, and zeros are still one.
    plain = samples(spark, [sample(51, -0.0, speed=9), sample(60, -0.0, speed=9)])
    assert tables.insert_raw(plain, path, []) == 2
    assert texts() == sorted(old + new + nulls * 2 + [("60", "0.0", "9.0")])
    index = tables.raw_table(spark, path).index()
    assert index.agg(F.sum("rows")).first()[0] == len(texts())


def test_shuffles_freed_restores_the_setting(spark):
    before = spark.conf.get(session.FREE_SHUFFLES, None)
    with pytest.raises(ZeroDivisionError), session.shuffles_freed(spark), session.shuffles_freed(spark):
        assert spark.conf.get(session.FREE_SHUFFLES) == "true"
        1 / 0
    assert spark.conf.get(session.FREE_SHUFFLES, None) == before
    spark.conf.set(session.FREE_SHUFFLES, "false")
    try:
        with session.shuffles_freed(spark):
            pass
        assert spark.conf.get(session.FREE_SHUFFLES) == "false"
    finally:
        spark.conf.unset(session.FREE_SHUFFLES)


def test_rerun_reads_a_compressed_drop(spark, folder, monkeypatch):
    from tripsense.catalog import queries

    rows = spark.range(400).selectExpr(
        "id AS l_orderkey", "id % 9 AS l_partkey", "id % 7 AS l_suppkey", "CAST(id % 4 + 1 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "id * 1.5D AS l_extendedprice", "0.04D AS l_discount", "0.02D AS l_tax",
        "TIMESTAMP'1995-01-01' + make_dt_interval(CAST(id AS INT)) AS l_shipdate",
    )
    rows.write.parquet(folder("in") + "/lineitem.parquet")
    monkeypatch.setattr(queries, "scratch_dir", lambda _, label: folder(label))
    monkeypatch.setattr(queries, "DROP_ROWS", 100)
    got = queries.ingest_batch_rerun(spark, folder("in"))
    drop = [name for name in os.listdir(folder("ingest") + "/csv") if name.startswith("part-")]
    assert len(drop) >= 4 and all(name.endswith(".csv.gz") for name in drop)
    assert as_set(got) == as_set(queries.append_raw_table(spark, folder("in")))


def test_compaction_keeps_rows_and_joins_files(spark, folder, monkeypatch):
    from tripsense.sources import keyed

    monkeypatch.setattr(keyed, "MOST_PARTS", 3)
    table = big_table(spark, folder("raw"), commits=6, ids=100)
    assert len(table.state().parts) <= 4
    before, rows = as_set(table.read()), table.index().count()
    assert table.compact(most_files=4) == rows
    assert as_set(table.read()) == before and table.index().count() <= 32
    assert table.compact(most_files=4) == 0
    assert table.insert(table.read()) == 600 and table.read().count() == 600


def test_checked_insert_keeps_rejects(spark, folder):
    columns = ", ".join(f"{c} string" for c in ["bookingid", *schemas.RAW_CHANNELS])
    good = {c: "1.5" for c in schemas.RAW_CHANNELS}

    def row(bookingid, **other):
        return (bookingid, *[(good | other)[c] for c in schemas.RAW_CHANNELS])

    rows = [row("1"), row("1", speed="9"), row("2", gyro_x=None), row("x"), row(None), row("3", second=None, speed="fast")]
    batch = spark.createDataFrame(rows, columns)
    table = tables.raw_table(spark, folder("raw"))
    assert tables.insert_checked(batch, table, folder("rejects")) == 2
    assert as_set(table.read().select("bookingid", "speed")) == [(1, 1.5), (2, 1.5)]
    rejects = spark.read.parquet(folder("rejects"))
    assert sorted(tuple(sorted(r["violations"])) for r in rejects.collect()) == [
        ("key",), ("null:bookingid",), ("null:second", "type:speed"), ("type:bookingid",)
    ]
    assert sorted(r["source"]["speed"] for r in rejects.collect()) == ["1.5", "1.5", "9", "fast"]
    narrow = batch.select("bookingid", "second")
    from tripsense.sources.quarantine import routed

    codes = routed(narrow, schemas.RAW_SCHEMA, schemas.RAW_KEY).select("violations").collect()
    assert len(codes) == 6 and all("missing:speed" in r["violations"] for r in codes)


def test_consolidation_job_is_insert_only(spark, folder):
    rows = HEADER + "".join(f"{trip},1,2,3,4,5,6,7,8,{s},{trip}\n" for trip in (1, 2) for s in range(3))
    write(folder("csv") + "/a.csv", rows)
    write(folder("labels") + "/labels.csv", "bookingID,label\n1,1\n2,1\n2,0\n")
    ingest_batch(spark, folder("csv"), folder("raw"))
    job = lambda: consolidate_job(spark, folder("raw"), folder("labels"), folder("trips"))
    assert job() == 2
    tables.append_raw(samples(spark, [sample(1, 50, speed=1000), sample(3, 0)]), folder("raw"))
    assert job() == 1
    assert job() == 0
    trips = tables.read_trips(spark, folder("trips"))
    assert as_set(trips.select("bookingid", "avg_speed", "label")) == [(1, 1.0, 1), (2, 2.0, 0), (3, 0.0, 0)]
    assert trips.columns == schemas.TRIP_SCHEMA.names


def test_insert_trips_skips_known_ids(spark, folder):
    from tripsense.functions.features import FEATURE_COLUMNS

    def trips(ids, label):
        return spark.createDataFrame([(i, *[1.0] * 25, label) for i in ids], "bookingid long, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS) + ", label int")

    tables.insert_trips(trips([1, 2], 0), folder("trips"))
    tables.insert_trips(trips([2, 3], 1), folder("trips"))
    assert as_set(tables.read_trips(spark, folder("trips")).select("bookingid", "label")) == [(1, 0), (2, 0), (3, 1)]


def test_messages_parse_reject_and_encode(spark):
    texts = [
        '{"bookingid": 5, "second": 3, "speed": 2.5}',
        '{"second": 1}',
        "not json",
        '{"bookingid": 6, "second": 1.0, "speed": 7, "extra": 1}',
    ]
    parsed = messages.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r["rejected"] for r in parsed.collect()] == [False, True, True, False]
    assert as_set(parsed.filter("NOT rejected").select("bookingid", "second", "speed")) == [(5, 3.0, 2.5), (6, 1.0, 7.0)]
    out = spark.createDataFrame([(5, 3.0, 2.5, 1)], schemas.PREDICTION_SCHEMA)
    encoded = messages.encode_messages(out, key="bookingid").first()
    assert (encoded["key"], encoded["value"]) == ("5", '{"bookingid":5,"time":3.0,"speed":2.5,"label":1}')
    assert messages.encode_messages(out).columns == ["value"]


def test_values_of_the_wrong_type_are_rejected(spark):
    texts = [
        '{"bookingid": 1, "second": 2, "speed": "abc", "gyro_x": 3.5}', '{"bookingid": 1, "second": 3, "speed": 2, "gyro_x": null}',
        '{"bookingid": 1, "second": 4, "other": "abc"}', '{"bookingid": "x", "second": 4}',
    ]
    parsed = messages.parse_messages(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r["rejected"] for r in parsed.collect()] == [True, False, False, True]
    assert "_unreadable" not in parsed.columns


def test_a_topic_source_stops_on_loss_unless_told_otherwise():
    assert messages.topic_source_options("b:9092", "t")["failOnDataLoss"] == "true"
    assert messages.topic_source_options("b:9092", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_topic_options():
    live = messages.topic_source_options("b:9092", "streaming")
    assert (live["startingOffsets"], live["subscribe"], live["maxOffsetsPerTrigger"]) == ("latest", "streaming", "1000000")
    replay = messages.topic_source_options("b:9092", "prediction", starting="earliest", max_offsets_per_trigger=None)
    assert replay["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in replay
    assert messages.topic_sink_options("b:9092", "prediction")["topic"] == "prediction"


def test_predictions_for_a_topic(spark):
    rows = spark.createDataFrame(
        [(5, 2, False, 3.0, 2.5, 1)], "bookingid long, window_idx long, is_tail boolean, time double, speed double, label int"
    )
    (row,) = topic_messages(rows, 7).collect()
    assert (row["key"], row["value"]) == ("5", '{"bookingid":5,"time":3.0,"speed":2.5,"label":1}')
    assert {h["key"]: bytes(h["value"]).decode() for h in row["headers"]} == {"batch_id": "7", "window_idx": "2"}


def test_shuffle_options():
    few = session.shuffle_options(10 * 1024**3)
    assert few["spark.sql.shuffle.partitions"] == "200"
    many = session.shuffle_options(100 * 1024**4)
    assert int(many["spark.sql.shuffle.partitions"]) == 100 * 1024**4 // session.SHUFFLE_PARTITION_BYTES


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:postgresql://h:5432/postgres", jdbc.pending_query("raw", "trips"), "u", "p")
    options |= jdbc.partition_options("bookingid", 0, 1000, 8)
    assert options["dbtable"].startswith("(SELECT") and options["numPartitions"] == "8"
    for bad in [(0, 0, 4), (0, 10, 0)]:
        with pytest.raises(ValueError):
            jdbc.partition_options("bookingid", *bad)


def _conditions_met(df, conditions):
    flags = [F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in conditions]
    return df.select("id", "at", *[flag.alias(f"r{n}") for n, flag in enumerate(flags)]).collect()


def test_balanced_scan_cuts_a_hot_id(spark):
    rows = [(7, n) for n in range(400)] + [(7, None)] * 3 + [(None, 5)] * 9 + [(n % 60 + 100, n % 7) for n in range(800)]
    df = spark.createDataFrame(rows, "id long, at long")
    conditions = jdbc.balanced_predicates(df, "id", "at", 10)
    met = _conditions_met(df, conditions)
    assert len(conditions) == 10
    assert all(sum(row[2:]) == 1 for row in met)
    sizes = [sum(row[f"r{n}"] for row in met) for n in range(10)]
    assert sum(sizes) == len(rows) and max(sizes) <= len(rows) / 10 + 15  # at most one id more
    assert sum(any(row["id"] == 7 and row[f"r{n}"] for row in met) for n in range(10)) >= 4


@pytest.mark.parametrize("rows", [[], [(None, None)] * 4, [(1, 1)] * 5, [(None, 1), (None, 2), (3, None)]])
def test_balanced_scan_of_odd_tables(spark, rows):
    df = spark.createDataFrame(rows, "id long, at long")
    conditions = jdbc.balanced_predicates(df, "id", "at", 4)
    assert 1 <= len(conditions) <= 4
    assert all(sum(row[2:]) == 1 for row in _conditions_met(df, conditions))


def test_balanced_scan_checks_its_number(spark):
    with pytest.raises(ValueError):
        jdbc.balanced_predicates(spark.createDataFrame([], "id long, at long"), "id", "at", 0)


def test_session_options_and_scratch(spark):
    options = session.object_store_options("store:9000", "user", "secret")
    assert options["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert options["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert session.object_store_options("https://s", "u", "s", tls=True)["spark.hadoop.fs.s3a.endpoint"] == "https://s"
    assert session.scratch_dir(spark, "x") != session.scratch_dir(spark, "x")


@pytest.mark.parametrize("settings, prefix", [
    ({"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"}, "hdfs:///shared/x-"),
    ({"spark.checkpoint.dir": "/shared", "spark.master": "local[2]"}, "/shared/x-"),
    ({"spark.master": "spark://host:7077"}, None),
])
def test_scratch_is_shared_on_a_cluster(settings, prefix):
    class Conf:
        def get(self, key, default=None):
            return settings.get(key, default)

    class Session:
        conf = Conf()

    if prefix is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_dir(Session(), "x")
    else:
        assert session.scratch_dir(Session(), "x").startswith(prefix)
