"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripsense.catalog import fixtures as fx
from tripsense.functions.features import FEATURE_COLUMNS, feature_aggregates, fill_missing, trip_features, with_magnitudes
from tripsense.functions.scalars import normalise_columns, round_doubles, trip_status
from tripsense.modelling import classifiers, evaluate, prepare, selection
from tripsense.modelling.registry import ModelFollower, ModelRegistry, resolve_version
from tripsense.operators import dashboard, labels, trips
from tripsense.operators.first_writer import first_writer_wins
from tripsense.operators.latest import latest_trip_state
from tripsense.operators.ordering import union_all
from tripsense.operators.windows import count_windows
from tripsense.plans import training
from tripsense.plans.consolidate import consolidate, labelled_trips
from tripsense.plans.ingest import ingest_batch
from tripsense.session import scratch_dir, shuffles_freed
from tripsense.sources import schemas
from tripsense.sources.jdbc import balanced_predicates
from tripsense.sources.files import read_labels_csv, read_samples_csv
from tripsense.sources.messages import encode_messages, parse_messages
from tripsense.sources.quarantine import routed
from tripsense.sources.tables import append_raw, append_trips, insert_checked, insert_raw, insert_trips, raw_table, read_raw, read_trips
from tripsense.streaming.count_windows import leftover_windows, stream_count_windows
from tripsense.streaming.ingest import start_raw_ingest
from tripsense.streaming.latest import each_once, prediction_feed, read_latest_state, start_latest_state
from tripsense.streaming.predict import prediction_messages, scored_messages, start_predictions, topic_messages
from tripsense.streaming.sinks import drain, parquet_batches, read_batches, start_batches

Query = Callable[[SparkSession, str], DataFrame]

LOOKUP_ID = 7
CUT_ROWS = 16
CHUNK_ROWS = 20
# Rows of a compressed file of a drop, which is read by one task.
DROP_ROWS = 1 << 20
STD_SPEED_LIMIT = 8.0
SWAP_LIMITS = (4.0, 5.0)
# Longer than the next micro-batch of an input of several takes to come.
IDLE_SECONDS = 5
# A fitted coefficient may be so far from the exact minimum.
LEAST_GAP = 1e-3
# Added to the features of trips on one side of a limit, far more than any of them varies.
RULE_GAP = 1e6
SCAN_RANGES = 16

DUP_ARRIVAL = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_trips(fx.fx_raw(spark, sf), fx.fx_labels(spark, sf))


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    """The whole trip table: every trip consolidated, labels filled."""
    return fill_missing(_labelled(spark, sf)).select(
        "bookingid", *FEATURE_COLUMNS, F.col("label").cast("int").alias("label")
    )


# sources and sinks


def ingest_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    mixed_case = fx.fx_raw(spark, sf).withColumnsRenamed({"bookingid": "bookingID", "accuracy": "Accuracy"})
    mixed_case.write.csv(path, header=True, mode="overwrite")
    return round_doubles(read_samples_csv(spark, path))


def labels_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "labels")
    fx.fx_labels(spark, sf).withColumnRenamed("bookingid", "bookingID").write.csv(path, header=True, mode="overwrite")
    return labels.unique_labels(read_labels_csv(spark, path))


def append_raw_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "raw")
    append_raw(fx.fx_raw(spark, sf), path)
    return round_doubles(read_raw(spark, path))


def append_trips_table(spark: SparkSession, sf: str) -> DataFrame:
    """The trips of the even ids, then all trips: the second run adds the odd ones only."""
    path = scratch_dir(spark, "trips")
    all_trips = _trips(spark, sf)
    insert_trips(all_trips.filter("bookingid % 2 = 0"), path)
    insert_trips(all_trips.withColumn("label", F.lit(-1)), path)
    return round_doubles(read_trips(spark, path))


def ingest_batch_query(spark: SparkSession, sf: str) -> DataFrame:
    """CSV drop to sample table, end to end."""
    path = scratch_dir(spark, "ingest")
    fx.fx_raw(spark, sf).withColumnRenamed("bookingid", "bookingID").write.csv(f"{path}/csv", header=True)
    ingest_batch(spark, f"{path}/csv", f"{path}/raw")
    return round_doubles(read_raw(spark, f"{path}/raw"))


def ingest_batch_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The same drop twice, which is the same as once. It is compressed: as plain text it would be most of what lies on disk."""
    path = scratch_dir(spark, "ingest")
    with shuffles_freed(spark):
        drop = fx.fx_raw(spark, sf).withColumnRenamed("bookingid", "bookingID").write
        drop.option("maxRecordsPerFile", DROP_ROWS).csv(f"{path}/csv", header=True, compression="gzip")
    for _ in range(2):
        ingest_batch(spark, f"{path}/csv", f"{path}/raw")
    return round_doubles(read_raw(spark, f"{path}/raw"))


def raw_first_writer_wins(spark: SparkSession, sf: str) -> DataFrame:
    kept = first_writer_wins(fx.fx_dup(spark, sf), schemas.RAW_KEY, DUP_ARRIVAL)
    return round_doubles(kept.select("bookingid", "second", "speed"))


def insert_raw_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries through the guarded insert: the later one may only add new keys."""
    path = scratch_dir(spark, "insert")
    rows = fx.fx_dup(spark, sf)
    rows = rows.withColumns({name: F.lit(None).cast("double") for name in schemas.RAW_CHANNELS if name not in rows.columns})
    insert_raw(rows.filter("l_suppkey % 2 = 0"), path, DUP_ARRIVAL)
    insert_raw(rows, path, DUP_ARRIVAL)
    return round_doubles(read_raw(spark, path).select("bookingid", "second", "speed"))


def compact_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Samples in several commits, their crowded buckets written anew."""
    table = raw_table(spark, scratch_dir(spark, "compact"))
    samples = fx.fx_raw(spark, sf)
    for part in range(3):
        table.append(samples.filter(F.col("bookingid") % 3 == part))
    table.compact(most_files=2)
    return round_doubles(table.read())


def read_stored_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The samples of some trips, from the files that the index names for them."""
    table = raw_table(spark, scratch_dir(spark, "lookup"))
    table.append(fx.fx_raw(spark, sf))
    return round_doubles(table.read_ids(fx.fx_done(spark, sf)).select("bookingid", "second", "speed"))


def _dirty_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples as text, with ids that are missing or no numbers, missing times, speeds that are words, and repeated keys."""
    rows = fx.fx_dup(spark, sf).selectExpr(
        "CASE WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 11 = 0 THEN concat('t', bookingid) ELSE CAST(bookingid AS STRING) END AS bookingid",
        "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE second END AS second",
        "CASE WHEN l_partkey % 17 = 0 THEN 'fast' ELSE CAST(l_partkey AS STRING) END AS speed", *DUP_ARRIVAL,
    )
    return rows.withColumns({name: F.lit(None).cast("double") for name in schemas.RAW_CHANNELS if name not in rows.columns})


def _violations() -> Column:
    return F.array_join(F.array_sort("violations"), ",").alias("violations")


def route_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every row with the rules it breaks."""
    checked = routed(_dirty_samples(spark, sf), schemas.RAW_SCHEMA, schemas.RAW_KEY, DUP_ARRIVAL)
    return checked.select("row.bookingid", "row.second", "row.speed", _violations())


def insert_checked_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What the table took and what was kept aside, read back: together the whole input."""
    path = scratch_dir(spark, "checked")
    table = raw_table(spark, f"{path}/raw")
    insert_checked(_dirty_samples(spark, sf), table, f"{path}/rejects", DUP_ARRIVAL)
    stored = table.read().select("bookingid", "second", "speed", F.lit("").alias("violations"))
    aside = spark.read.parquet(f"{path}/rejects")
    return stored.unionByName(aside.select("row.bookingid", "row.second", "row.speed", _violations()))


def validate_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.fx_dup(spark, sf).withColumn("speed", F.expr("NULLIF(speed, 7 * PI() / 8)"))
    return schemas.contract_report(rows, ["bookingid", "second", "speed"], schemas.RAW_KEY)


def validate_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule of the trip table, over all trips of samples with gaps and with labels of the wrong type."""
    table = labelled_trips(fx.fx_gaps(spark, sf), fx.fx_labels(spark, sf)).select("bookingid", *FEATURE_COLUMNS, F.col("label").cast("long").alias("label"))
    return schemas.table_report(table, schemas.TRIP_SCHEMA, schemas.TRIP_KEY)


def trips_all(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(_trips(spark, sf))


def trip_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(trips.trip_lookup(_trips(spark, sf), LOOKUP_ID))


# projections and scalar expressions


def sample_magnitudes(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(
        with_magnitudes(fx.fx_raw(spark, sf)).select("bookingid", "second", "accel_mag", "gyro_mag")
    )


def normalised_columns(spark: SparkSession, sf: str) -> DataFrame:
    upper = fx.fx_labels(spark, sf).withColumnsRenamed({"bookingid": "bookingID", "label": "Label"})
    return normalise_columns(upper)


def fill_missing_query(spark: SparkSession, sf: str) -> DataFrame:
    """Over trips without any speed and trips of one sample, whose statistics are null."""
    return round_doubles(fill_missing(labelled_trips(fx.fx_gaps(spark, sf), fx.fx_labels(spark, sf))))


def drop_identifier(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(_trips(spark, sf).drop("bookingid"))


def label_as_int(spark: SparkSession, sf: str) -> DataFrame:
    text = fx.fx_labels(spark, sf).withColumn("label", F.col("label").cast("double"))
    return text.select("bookingid", F.col("label").cast("int").alias("label"))


def trip_summary_card(spark: SparkSession, sf: str) -> DataFrame:
    return trips.trip_summary_card(_trips(spark, sf))


def trip_status_query(spark: SparkSession, sf: str) -> DataFrame:
    labelled = _labelled(spark, sf).select("bookingid", "label")
    return labelled.withColumn("status", trip_status("label"))


def decode_messages(spark: SparkSession, sf: str) -> DataFrame:
    """JSON texts made of all events, some broken or mistyped, parsed and written again."""
    texts = fx.fx_stream(spark, sf).select(
        "seq",
        F.expr(
            "CASE seq % 10 WHEN 3 THEN '{\"bookingid\": 1, ' WHEN 6 THEN concat('{\"bookingid\": ', bookingid, ', \"second\": \"late\"}')"
            " WHEN 9 THEN '{\"second\": 1.5}' ELSE concat('{\"bookingid\": ', bookingid, ', \"second\": ', seq, '.5, \"more\": 1}') END"
        ).alias("value"),
    )
    parsed = parse_messages(texts)
    encoded = encode_messages(parsed.filter("NOT rejected").select("seq", "bookingid", "second"))
    again = encoded.select(F.from_json("value", "seq long, bookingid long, second double").alias("m")).select("m.*")
    return again.withColumn("rejected", F.lit(False)).unionByName(
        parsed.filter("rejected").select("seq", F.lit(None).cast("long").alias("bookingid"), F.lit(None).cast("double").alias("second"), "rejected")
    )


def prediction_message(spark: SparkSession, sf: str) -> DataFrame:
    windows = fill_missing(_feature_windows(spark, sf))
    return round_doubles(prediction_messages(speed_rule(windows), "window_idx", "is_tail"))


def speed_rule(features: DataFrame) -> DataFrame:
    """Stands in for a model where results must be reproducible elsewhere."""
    return features.withColumn("prediction", (F.col("std_speed") > STD_SPEED_LIMIT).cast("double"))


# joins


def pending_samples(spark: SparkSession, sf: str) -> DataFrame:
    pending = trips.pending_samples(fx.fx_raw(spark, sf), fx.fx_done(spark, sf))
    return round_doubles(pending.select("bookingid", "second", "speed"))


def trips_with_label(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(_labelled(spark, sf).select("bookingid", "avg_speed", "second", "label"))


def unique_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.unique_labels(fx.fx_labels(spark, sf))


# aggregations


def trip_features_query(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(trip_features(fx.fx_raw(spark, sf)))


def label_multiplicity(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_multiplicity(fx.fx_labels(spark, sf))


def label_classes(spark: SparkSession, sf: str) -> DataFrame:
    return labels.label_classes(fx.fx_labels(spark, sf))


def _panel(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(_trips(spark, sf))


def trip_safety_counts(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.trip_safety_counts(_labelled(spark, sf))


def _sequences(samples: DataFrame, **options) -> DataFrame:
    chunks = trips.trip_sequences(samples, ("speed",), chunk_rows=CHUNK_ROWS, **options)
    first, last = F.element_at("records", 1), F.element_at("records", -1)
    return round_doubles(
        chunks.select(
            "bookingid",
            "chunk",
            F.size("records").alias("records"),
            first["second"].alias("first_second"),
            last["second"].alias("last_second"),
            first["speed"].alias("first_speed"),
            last["speed"].alias("last_speed"),
        )
    )


def trip_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return _sequences(fx.fx_raw(spark, sf))


def trip_sequences_long_trips(spark: SparkSession, sf: str) -> DataFrame:
    """With trips cut into pieces of a few rows."""
    return _sequences(fx.fx_raw(spark, sf), group_rows=CUT_ROWS)


# windows, sorts, top-k


def _windows(spark: SparkSession, sf: str, aggregates, **options) -> DataFrame:
    samples = fx.fx_stream(spark, sf)
    return count_windows(samples, aggregates, order=["seq"], **options)


def _feature_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _windows(spark, sf, feature_aggregates(), prepare=with_magnitudes)


def _speed_aggregates() -> list:
    return [
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.avg("speed").alias("avg_speed"),
        F.stddev_samp("speed").alias("std_speed"),
    ]


def count_windows_query(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(_windows(spark, sf, _speed_aggregates()))


def count_windows_long_trips(spark: SparkSession, sf: str) -> DataFrame:
    """With trips cut into pieces of a few rows."""
    return round_doubles(_windows(spark, sf, _speed_aggregates(), group_rows=CUT_ROWS))


def window_features(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(fill_missing(_feature_windows(spark, sf)))


def latest_state(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(latest_trip_state(fx.fx_stream(spark, sf), "seq", label_present="has_label"))


def ordered_samples(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(trips.ordered_samples(fx.fx_raw(spark, sf).select("bookingid", "second", "speed")))


def first_trips(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(trips.first_trips(fx.fx_raw(spark, sf)))


# end to end


def consolidate_trips(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(consolidate(fx.fx_raw(spark, sf), fx.fx_done(spark, sf), fx.fx_labels(spark, sf)))


def consolidate_trips_open_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Trips without a usable label stay unlabelled."""
    pending = consolidate(fx.fx_raw(spark, sf), fx.fx_done(spark, sf), fx.fx_labels(spark, sf), fill_label=False)
    return round_doubles(pending)


# streams: the given files as an unbounded source, run until all of them are read


def _stream_samples(spark: SparkSession, sf: str) -> DataFrame:
    return fx.fx_stream_source(spark, sf).select("bookingid", "seq", *schemas.RAW_CHANNELS)


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The same files delivered twice: the second delivery adds nothing."""
    path = scratch_dir(spark, "stream-ingest")
    for delivery in ("first", "second"):
        rows = fx.fx_dup_source(spark, sf)
        missing = [name for name in schemas.RAW_CHANNELS if name not in rows.columns]
        rows = rows.withColumns({name: F.lit(None).cast("double") for name in missing})
        start_raw_ingest(rows, f"{path}/raw", f"{path}/{delivery}", arrival=DUP_ARRIVAL).awaitTermination()
    return round_doubles(read_raw(spark, f"{path}/raw").select("bookingid", "second", "speed"))


def stream_count_windows_query(spark: SparkSession, sf: str) -> DataFrame:
    """Full windows as the stream emits them, and the tails that its state holds when the input has ended."""
    path = scratch_dir(spark, "stream-windows")
    windows = stream_count_windows(_stream_samples(spark, sf), order=["seq"], idle_seconds=None)
    start_batches(windows, parquet_batches(f"{path}/rows"), f"{path}/checkpoint").awaitTermination()
    rows = read_batches(spark, f"{path}/rows", windows.schema).drop("batch_id")
    rows = rows.unionByName(leftover_windows(spark, f"{path}/checkpoint", windows.schema))
    summary = rows.groupBy("bookingid", "window_idx", "is_tail").agg(F.count(F.lit(1)).alias("rows"), *_speed_aggregates())
    return round_doubles(summary)


def stream_idle_flush(spark: SparkSession, sf: str) -> DataFrame:
    """Full windows and tails, all of them from a stream whose timers run until no trip is left."""
    path = scratch_dir(spark, "stream-idle")
    windows = stream_count_windows(_stream_samples(spark, sf), order=["seq"], idle_seconds=IDLE_SECONDS)
    trigger = {"processingTime": "1 second"}
    drain(start_batches(windows, parquet_batches(f"{path}/rows"), f"{path}/checkpoint", trigger=trigger))
    rows = read_batches(spark, f"{path}/rows", windows.schema)
    summary = rows.groupBy("bookingid", "window_idx", "is_tail").agg(F.count(F.lit(1)).alias("rows"), *_speed_aggregates())
    return round_doubles(summary)


def stream_predictions_once(spark: SparkSession, sf: str) -> DataFrame:
    """Every prediction published twice, in three batches: a reader sees it once."""
    path = scratch_dir(spark, "stream-once")
    scored = prediction_messages(speed_rule(fill_missing(_feature_windows(spark, sf))), "window_idx", "is_tail")
    for delivery in range(2):
        for batch_id in range(3):
            published = topic_messages(scored.filter(F.col("window_idx") % 3 == batch_id), batch_id)
            stamped = published.withColumn("timestamp", F.timestamp_seconds(F.lit(1_700_000_000 + 60 * delivery)))
            stamped.write.parquet(f"{path}/topic/{delivery}-{batch_id}")
    topic = spark.readStream.schema(stamped.schema).parquet(f"{path}/topic/*")
    feed = each_once(prediction_feed(topic)).select("bookingid", "window_idx", "time", "speed", "label")
    start_batches(feed, parquet_batches(f"{path}/seen"), f"{path}/checkpoint").awaitTermination()
    return round_doubles(read_batches(spark, f"{path}/seen", feed.schema).drop("batch_id"))


def stream_model_swap(spark: SparkSession, sf: str) -> DataFrame:
    """One running stream; when the first half of the messages is scored, another version is given the alias."""
    path = scratch_dir(spark, "stream-swap")
    registry = ModelRegistry(spark, f"{path}/registry")
    for limit in SWAP_LIMITS:
        rule = SQLTransformer(statement=f"SELECT *, CAST(std_speed > {limit} AS DOUBLE) AS prediction FROM __THIS__")
        registry.register("rule", PipelineModel([rule]), {"limit": limit})
    registry.set_alias("rule", "1")
    messages = fx.fx_stream(spark, sf).select("bookingid", "seq", *schemas.RAW_CHANNELS)
    half = messages.agg(F.expr("(min(seq) + max(seq)) div 2")).first()[0]
    messages.filter(F.col("seq") <= half).write.parquet(f"{path}/in/first")
    stream = spark.readStream.schema(messages.schema).parquet(f"{path}/in/*")
    query = start_predictions(
        stream, ModelFollower(registry, "rule", check_seconds=0), parquet_batches(f"{path}/messages"), f"{path}/checkpoint",
        order=["seq"], idle_seconds=None, trigger={"processingTime": "0 seconds"},
    )
    try:
        query.processAllAvailable()
        registry.set_alias("rule", "2")
        messages.filter(F.col("seq") > half).write.parquet(f"{path}/in/second")
        query.processAllAvailable()
    finally:
        query.stop()
    schema = "bookingid long, window_idx long, time double, speed double, label int, model_version string"
    return round_doubles(read_batches(spark, f"{path}/messages", spark.createDataFrame([], schema).schema).drop("batch_id"))


def _predictions(spark: SparkSession, sf: str, scorer) -> DataFrame:
    path = scratch_dir(spark, "stream-predict")
    samples = _stream_samples(spark, sf)
    start_predictions(
        samples, scorer, parquet_batches(f"{path}/messages"), f"{path}/checkpoint",
        order=["seq"], idle_seconds=None,
    ).awaitTermination()
    schema = "bookingid long, window_idx long, is_tail boolean, time double, speed double, label int"
    messages = read_batches(spark, f"{path}/messages", spark.createDataFrame([], schema).schema)
    tails = leftover_windows(spark, f"{path}/checkpoint", stream_count_windows(samples, order=["seq"]).schema)
    return round_doubles(messages.drop("batch_id").unionByName(scored_messages(tails, scorer)))


def stream_predict_rule(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(spark, sf, speed_rule)


def stream_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Windows scored by a forest trained on the trip table and served from the registry."""
    registry = ModelRegistry(spark, scratch_dir(spark, "registry"))
    training.train_job(_stored_trips(spark, sf), registry, "trips", num_trees=20, alias="champion")
    messages = _predictions(spark, sf, registry.load("trips"))
    return messages.withColumn("valid", F.col("label").isin(0, 1)).drop("label")


def stream_latest_state(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "stream-latest")
    messages = fx.fx_stream_source(spark, sf)
    start_latest_state(
        messages, "seq", f"{path}/states", f"{path}/checkpoint", label_present="has_label"
    ).awaitTermination()
    return round_doubles(read_latest_state(spark, f"{path}/states", "seq"))


# feature selection and modelling


def _stored_trips(spark: SparkSession, sf: str) -> DataFrame:
    """The trip table as training reads it: written once, scanned per iteration."""
    path = scratch_dir(spark, "trips")
    append_trips(_trips(spark, sf), path)
    return read_trips(spark, path)


def _vector_columns(df: DataFrame) -> DataFrame:
    values = vector_to_array("features")
    return df.select("bookingid", *[values[i].alias(name) for i, name in enumerate(prepare.MODEL_FEATURES)])


def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(_vector_columns(prepare.assemble_features(_trips(spark, sf))))


def scale_features(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(_vector_columns(prepare.scale_features(_trips(spark, sf))))


def train_test_split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = prepare.train_test_split(_trips(spark, sf).select("bookingid", "label"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def dataset_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of every stage from one aggregation: samples, trips, labelled trips, train, test, consolidated."""
    per_trip = fx.fx_raw(spark, sf).groupBy("bookingid").agg(F.count(F.lit(1)).alias("samples"))
    rows = (
        per_trip.join(labels.unique_labels(fx.fx_labels(spark, sf)), "bookingid", "left")
        .join(fx.fx_done(spark, sf).withColumn("done", F.lit(True)), "bookingid", "left")
        .agg(
            F.sum("samples").alias("raw"),
            F.count(F.lit(1)).alias("trips"),
            F.count_if(F.col("label").isNotNull()).alias("labelled"),
            F.count_if(prepare.in_train()).alias("train"),
            F.count_if(~prepare.in_train()).alias("test"),
            F.count_if(F.col("done").isNotNull()).alias("consolidated"),
        )
    )
    return rows.select(F.inline(F.array(*[F.struct(F.lit(n).alias("dataset"), F.col(n).alias("rows")) for n in rows.columns])))


# What a fitted model says differs from engine to engine. The queries over models give the rows they score, and whether what
# they say of each has the form and the relations it must have; ``train_on_rule`` asks whether models learn.


def _scored_by(estimator: Callable[[int, int], Estimator]) -> Query:
    """Fit on the training part of the stored trips, score the held-out part."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        data = prepare.scale_features(_stored_trips(spark, sf)).select("bookingid", "features", "label")
        train, test = prepare.train_test_split(data, prepare.EXPERIMENT_TRAIN_FRACTION)
        model = estimator(len(prepare.MODEL_FEATURES), 2).fit(train)
        return model.transform(test).select("bookingid", "label", F.col("prediction").isin(0.0, 1.0).alias("valid"))

    return query


def train_on_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Models of a label that one feature decides, held against it on the held-out trips."""
    ruled = _stored_trips(spark, sf).withColumn("label", (F.col("std_speed") > STD_SPEED_LIMIT).cast("int"))
    data = prepare.scale_features(ruled).select("bookingid", "features", "label")
    train, test = prepare.train_test_split(data, prepare.EXPERIMENT_TRAIN_FRACTION)
    models = {
        "forest": classifiers.random_forest(20, 5), "logistic": classifiers.logistic(), "svm": classifiers.linear_svm(),
        "mlp": classifiers.perceptron(len(prepare.MODEL_FEATURES), 2),
    }
    scored = [
        estimator.fit(train).transform(test).select(F.lit(name).alias("model"), "label", "prediction")
        for name, estimator in models.items()
    ]
    confusion = evaluate.confusion_matrix(union_all(scored), ["model"])
    sizes = confusion.groupBy("model").agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("positives"))
    return evaluate.accuracy(confusion, ["model"]).join(sizes, "model").select(
        "model", "rows", "positives", (F.col("accuracy") > 0.85).alias("learnt")
    )


def score_trips(spark: SparkSession, sf: str) -> DataFrame:
    """Train, register, load back and score all trips."""
    registry = ModelRegistry(spark, scratch_dir(spark, "registry"))
    stored = _stored_trips(spark, sf)
    training.train_job(stored, registry, "trips", num_trees=20)
    scored = training.probability_of_danger(registry.load("trips")(stored))
    agree = (F.col("prediction") == 1) == (F.col("probability") > 0.5)
    valid = F.col("prediction").isin(0.0, 1.0) & F.col("probability").between(0, 1) & agree
    return scored.select("bookingid", "label", valid.alias("valid"))


def train_job(spark: SparkSession, sf: str) -> DataFrame:
    """What the registry holds after two trainings; the score itself only has to be a valid area."""
    registry = ModelRegistry(spark, scratch_dir(spark, "registry"))
    stored = _stored_trips(spark, sf)
    training.train_job(stored, registry, "trips", num_trees=5, alias="champion")
    report = training.train_job(stored, registry, "trips", num_trees=20)
    known = {key: report[key] for key in ("num_trees", "max_depth", "training_data_count", "testing_data_count")}
    return registry.entries().select(
        "name",
        "version",
        "alias",
        *[F.lit(value).cast("long").alias(key) for key, value in known.items()],
        F.lit(report["auc"]).between(0, 1).alias("valid_auc"),
    )


def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    table = training.compare_models(_stored_trips(spark, sf))
    in_range = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1) & F.coalesce(F.col("auc").between(0, 1), F.lit(True))
    # A share of so many rows is a whole number of them.
    whole = F.abs(F.col("accuracy") * F.col("rows") - F.round(F.col("accuracy") * F.col("rows"))) < 1e-6
    # What accuracy and F1 must be by the confusion counts.
    right = F.abs(F.col("accuracy") * F.col("rows") - F.col("tp") - F.col("tn")) < 1e-6
    positives, negatives = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    mean = sum(size * F.coalesce(F.try_divide(2 * hits, 2 * hits + F.col("fp") + F.col("fn")), F.lit(0.0))
               for size, hits in ((positives, F.col("tp")), (negatives, F.col("tn"))))
    weighted = F.abs(F.col("f1") * F.col("rows") - mean) < 1e-6
    return table.select(
        "model", "rows", positives.alias("positives"), negatives.alias("negatives"), F.col("auc").isNotNull().alias("has_auc"),
        (in_range & whole & right & weighted).alias("valid"),
    )


def predict_gap_rule(spark: SparkSession, sf: str) -> DataFrame:
    """What five fitted models say of every trip they were not fitted on, where a gap parts the labels in every feature.

    ``served`` is the production pipeline as the registry gives it back.
    """
    dangerous = F.col("std_speed") > STD_SPEED_LIMIT
    gap = F.when(dangerous, RULE_GAP).otherwise(0.0)
    stored = _stored_trips(spark, sf).withColumns(
        {"label": dangerous.cast("int"), **{name: F.col(name) + gap for name in prepare.MODEL_FEATURES}}
    )
    train, test = prepare.train_test_split(prepare.scale_features(stored), prepare.EXPERIMENT_TRAIN_FRACTION)
    models = {
        "forest": classifiers.random_forest(), "logistic": classifiers.logistic(), "svm": classifiers.linear_svm(),
        "mlp": classifiers.perceptron(len(prepare.MODEL_FEATURES), 2),
    }
    scored = {name: estimator.fit(train).transform(test) for name, estimator in models.items()}
    registry = ModelRegistry(spark, scratch_dir(spark, "registry"))
    training.train_job(stored, registry, "trips", alias="champion")
    scored["served"] = registry.load("trips")(prepare.train_test_split(stored, prepare.TRAIN_FRACTION)[1])
    return union_all([
        rows.select(F.lit(name).alias("model"), "bookingid", F.col("prediction").cast("int").alias("prediction"))
        for name, rows in scored.items()
    ])


def split_gains(spark: SparkSession, sf: str) -> DataFrame:
    """The best single split of every feature."""
    return round_doubles(selection.split_gains(round_doubles(_trips(spark, sf)), FEATURE_COLUMNS))


def forest_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature, and whether its importance is what the forest's splits gain on the trips."""
    audited = training.audited_forest(_stored_trips(spark, sf), FEATURE_COLUMNS)
    return audited.select("feature", (F.abs(F.col("score") - F.col("recomputed")) < 1e-6).alias("agrees"))


def balanced_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that each condition of a divided table scan reads; ``met`` is how many conditions a row meets."""
    samples = fx.fx_raw(spark, sf).select("bookingid", F.col("second").cast("long").alias("second"))
    conditions = [F.coalesce(F.expr(p), F.lit(False)) for p in balanced_predicates(samples, "bookingid", "second", SCAN_RANGES)]
    at = F.array_position(F.array(*conditions), True).cast("int")
    met = sum((c.cast("int") for c in conditions), F.lit(0))
    return samples.groupBy(at.alias("range"), met.alias("met")).agg(F.count(F.lit(1)).alias("rows"))


def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    ranked = selection.rank_features(training.forest_selection(_stored_trips(spark, sf), FEATURE_COLUMNS))
    everything = Window.partitionBy()
    ordered = F.col("score") <= F.coalesce(F.lag("score").over(Window.orderBy("rank")), F.lit(1.0))
    whole = F.abs(F.sum("score").over(everything) - 1) < 1e-6
    return ranked.select("feature", (F.col("score").between(0, 1) & ordered & whole).alias("valid"))


def lasso_selection(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature, and whether its coefficient is where the penalised loss is least."""
    scores = training.certified_lasso(_stored_trips(spark, sf), FEATURE_COLUMNS)
    return scores.select("feature", (F.coalesce("gap", F.lit(0.0)) < LEAST_GAP).alias("optimal"))


def pearson_selection(spark: SparkSession, sf: str) -> DataFrame:
    scores = selection.pearson_scores(_trips(spark, sf), FEATURE_COLUMNS)
    return round_doubles(selection.select_features(scores, selection.CORRELATION_THRESHOLD))


def rank_features(spark: SparkSession, sf: str) -> DataFrame:
    scores = selection.pearson_scores(_trips(spark, sf), FEATURE_COLUMNS).filter("score IS NOT NULL")
    return selection.rank_features(round_doubles(scores))


def feature_consensus(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature, and whether it is kept exactly if two of the three selections or the forced list say so."""
    stored = _stored_trips(spark, sf)
    kept = training.select_by_consensus(stored, FEATURE_COLUMNS, force_keep=["second"]).filter("keep").select("feature")
    votes = union_all([
        selection.select_features(scores, threshold).select("feature")
        for scores, threshold in (
            (training.forest_selection(stored, FEATURE_COLUMNS), selection.IMPORTANCE_THRESHOLD),
            (training.lasso_selection(stored, FEATURE_COLUMNS), selection.COEFFICIENT_THRESHOLD),
            (selection.pearson_scores(stored, FEATURE_COLUMNS), selection.CORRELATION_THRESHOLD),
        )
    ]).groupBy("feature").agg(F.count(F.lit(1)).alias("votes"))
    names = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in FEATURE_COLUMNS])).alias("feature"))
    said = names.join(votes, "feature", "left").join(kept.withColumn("kept", F.lit(True)), "feature", "left")
    wanted = (F.coalesce("votes", F.lit(0)) >= 2) | ((F.col("feature") == "second") & F.col("votes").isNotNull())
    return said.select("feature", (F.coalesce("kept", F.lit(False)) == wanted).alias("as_voted"))


def feature_consensus_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Votes of three selections that differ in their threshold only."""
    scores = selection.pearson_scores(_trips(spark, sf), FEATURE_COLUMNS)
    chosen = [selection.select_features(scores, threshold) for threshold in (0.01, 0.02, 0.03)]
    return selection.feature_consensus(*chosen, force_keep=["second"])


def eval_auc(spark: SparkSession, sf: str) -> DataFrame:
    return round_doubles(evaluate.area_under_roc(fx.fx_scores(spark, sf), "score", ["model"]))


def eval_auc_fine_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Nearly as many scores as rows, so that the running counts are put together from blocks."""
    areas = evaluate.area_under_roc(fx.fx_scores(spark, sf), "fine_score", ["model"])
    return round_doubles(areas)


def eval_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    matrix = evaluate.confusion_matrix(fx.fx_scores(spark, sf), ["model"])
    return round_doubles(evaluate.accuracy(matrix, ["model"]))


def eval_f1(spark: SparkSession, sf: str) -> DataFrame:
    matrix = evaluate.confusion_matrix(fx.fx_scores(spark, sf), ["model"])
    return round_doubles(evaluate.weighted_f1(matrix, ["model"]))


def resolve_model_version(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_version(fx.fx_registry(spark, sf))


def all_queries() -> dict[str, Query]:
    return {
        "ingest_csv": ingest_csv,
        "ingest_batch": ingest_batch_query,
        "ingest_batch_rerun": ingest_batch_rerun,
        "labels_csv": labels_csv,
        "append_raw": append_raw_table,
        "append_trips": append_trips_table,
        "raw_first_writer_wins": raw_first_writer_wins,
        "insert_raw": insert_raw_table,
        "compact_raw": compact_raw,
        "read_stored_ids": read_stored_ids,
        "route_rows": route_rows,
        "insert_checked": insert_checked_rows,
        "validate_schema": validate_schema,
        "validate_trips": validate_trips,
        "trips_all": trips_all,
        "trip_lookup": trip_lookup,
        "sample_magnitudes": sample_magnitudes,
        "normalise_columns": normalised_columns,
        "fill_missing": fill_missing_query,
        "drop_identifier": drop_identifier,
        "label_as_int": label_as_int,
        "trip_summary_card": trip_summary_card,
        "trip_status": trip_status_query,
        "pending_samples": pending_samples,
        "trips_with_label": trips_with_label,
        "unique_labels": unique_labels,
        "trip_features": trip_features_query,
        "label_multiplicity": label_multiplicity,
        "label_classes": label_classes,
        "trip_safety_counts": trip_safety_counts,
        "trip_speed_histogram": _panel(dashboard.trip_speed_histogram),
        "trip_speed_std_histogram": _panel(dashboard.trip_speed_std_histogram),
        "trip_duration_buckets": _panel(dashboard.trip_duration_buckets),
        "trip_dashboard": _panel(dashboard.trip_dashboard),
        "trip_sequences": trip_sequences,
        "trip_sequences_long_trips": trip_sequences_long_trips,
        "count_windows": count_windows_query,
        "count_windows_long_trips": count_windows_long_trips,
        "window_features": window_features,
        "latest_trip_state": latest_state,
        "ordered_samples": ordered_samples,
        "first_trips": first_trips,
        "consolidate_trips": consolidate_trips,
        "consolidate_trips_open_labels": consolidate_trips_open_labels,
        "decode_messages": decode_messages,
        "prediction_message": prediction_message,
        "stream_ingest": stream_ingest,
        "stream_count_windows": stream_count_windows_query,
        "stream_idle_flush": stream_idle_flush,
        "stream_predictions_once": stream_predictions_once,
        "stream_model_swap": stream_model_swap,
        "stream_latest_state": stream_latest_state,
        "stream_predict_rule": stream_predict_rule,
        "stream_predict": stream_predict,
        "assemble_features": assemble_features,
        "scale_features": scale_features,
        "train_test_split": train_test_split,
        "dataset_counts": dataset_counts,
        "pearson_selection": pearson_selection,
        "rank_features": rank_features,
        "eval_auc": eval_auc,
        "eval_auc_fine_scores": eval_auc_fine_scores,
        "eval_accuracy": eval_accuracy,
        "eval_f1": eval_f1,
        "resolve_model_version": resolve_model_version,
        "train_random_forest": _scored_by(lambda features, classes: classifiers.random_forest()),
        "train_logistic": _scored_by(lambda features, classes: classifiers.logistic()),
        "train_svm": _scored_by(lambda features, classes: classifiers.linear_svm()),
        "train_mlp": _scored_by(classifiers.perceptron),
        "train_job": train_job,
        "score_trips": score_trips,
        "compare_models": compare_models,
        "predict_gap_rule": predict_gap_rule,
        "split_gains": split_gains,
        "forest_audit": forest_audit,
        "balanced_scan": balanced_scan,
        "feature_importance": feature_importance,
        "lasso_selection": lasso_selection,
        "feature_consensus": feature_consensus,
        "feature_consensus_fixed": feature_consensus_fixed,
        "train_on_rule": train_on_rule,
    }
