from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from helpers import as_set
from tripsense.functions.features import FEATURE_COLUMNS
from tripsense.modelling import classifiers, evaluate, prepare, selection
from tripsense.modelling.registry import ModelFollower, ModelRegistry, resolve_version
from tripsense.plans import training
from tripsense.sources.schemas import REGISTRY_SCHEMA


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        label = int(rng.random() < 0.4)
        features = [rng.gauss(label * (0.2 * (j % 7)), 1) for j in range(len(FEATURE_COLUMNS))]
        rows.append((i, *features, label))
    path = str(tmp_path_factory.mktemp("trips") / "t")
    columns = ", ".join(f"{name} double" for name in FEATURE_COLUMNS)
    spark.createDataFrame(rows, f"bookingid long, {columns}, label int").write.parquet(path)
    return spark.read.parquet(path)


def test_production_features():
    assert len(prepare.MODEL_FEATURES) == 14 and set(prepare.MODEL_FEATURES) <= set(FEATURE_COLUMNS)


def test_split_is_disjoint_complete_and_stable(spark):
    ids = spark.range(5000).withColumnRenamed("id", "bookingid")
    train, test = prepare.train_test_split(ids)
    assert train.intersect(test).count() == 0
    assert train.union(test).distinct().count() == 5000
    assert 0.66 < train.count() / 5000 < 0.74
    again, _ = prepare.train_test_split(ids.repartition(7))
    assert as_set(again) == as_set(train)
    other, _ = prepare.train_test_split(ids, seed=7)
    assert as_set(other) != as_set(train)


def test_assemble_checks_columns_and_nulls(spark, trips):
    with pytest.raises(ValueError, match="nope"):
        prepare.assemble_features(trips, ["avg_speed", "nope"])
    vectors = prepare.assemble_features(trips, ["avg_speed", "second"]).select("avg_speed", "second", vector_to_array("features").alias("v"))
    assert all([r[0], r[1]] == r["v"] for r in vectors.collect())
    with pytest.raises(Exception):
        prepare.assemble_features(trips.withColumn("second", F.lit(None).cast("double"))).collect()


def test_scaling_divides_by_the_sample_deviation(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (8.0, 7.0)], "a double, b double")
    scaled = prepare.scale_features(df, ["a", "b"]).select("a", vector_to_array("features").alias("v")).collect()
    deviation = df.agg(F.stddev_samp("a")).first()[0]
    for row in scaled:
        assert row["v"][0] == pytest.approx(row["a"] / deviation)
        assert row["v"][1] == 0.0


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(11)
    rows = []
    for model in ("a", "b"):
        for _ in range(700):
            label = rng.randint(0, 1)
            score = round(rng.gauss(label, 1.5), 1)
            rows.append((model, label, score, float(score > 0.4)))
    df = spark.createDataFrame(rows, "model string, label int, score double, prediction double")
    return df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("score"), F.col("score"))))


def test_metrics_equal_the_library_evaluators(scored):
    confusion = evaluate.confusion_matrix(scored, ["model"])
    ours = {
        "accuracy": dict(map(tuple, evaluate.accuracy(confusion, ["model"]).collect())),
        "f1": dict(map(tuple, evaluate.weighted_f1(confusion, ["model"]).collect())),
        "auc": dict(map(tuple, evaluate.area_under_roc(scored, evaluate.positive_score(), ["model"]).collect())),
        "split auc": dict(map(tuple, evaluate.area_under_roc(scored, "score", ["model"]).collect())),
    }
    for model in ("a", "b"):
        part = scored.filter(F.col("model") == model).cache()
        auc = BinaryClassificationEvaluator(numBins=0).evaluate(part)
        assert ours["auc"][model] == pytest.approx(auc)
        assert ours["split auc"][model] == pytest.approx(auc)
        for metric in ("accuracy", "f1"):
            assert ours[metric][model] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(part))


def test_auc_of_the_whole_table(scored):
    expected = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    assert evaluate.area_under_roc(scored, "score").first()["auc"] == pytest.approx(expected)
    assert evaluate.area_under_roc(scored.filter("label = 1"), "score").first()["auc"] is None


def test_pearson_with_constant_feature(spark):
    df = spark.createDataFrame([(1.0, 5.0, 0), (2.0, 5.0, 0), (4.0, 5.0, 1), (3.0, 5.0, 1)], "x double, c double, label int")
    scores = dict(map(tuple, selection.pearson_scores(df, ["x", "c"]).collect()))
    assert scores["x"] == pytest.approx(df.stat.corr("x", "label")) and scores["c"] is None


def test_rank_select_and_consensus(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "feature string, score double")

    scores = frame([("a", 0.02), ("b", 0.5), ("c", -0.3), ("d", 0.01)])
    assert {r["feature"] for r in selection.select_features(scores, 0.01).collect()} == {"a", "b", "c"}
    ranked = selection.rank_features(scores).orderBy("rank").collect()
    assert [r["feature"] for r in ranked] == ["b", "a", "d", "c"]
    votes = selection.feature_consensus(
        frame([("a", 1.0), ("b", 1.0), ("second", 1.0)]), frame([("a", 1.0)]), frame([("a", 1.0), ("b", 1.0), ("z", 1.0)]),
        force_keep=["second"],
    )
    got = {r["feature"]: (r["forest"], r["lasso"], r["pearson"], r["votes"], r["keep"]) for r in votes.collect()}
    assert got == {
        "a": (True, True, True, 3, True),
        "b": (True, False, True, 2, True),
        "second": (True, False, False, 1, True),
        "z": (False, False, True, 1, False),
    }


def test_resolve_version_prefers_the_alias_then_the_number(spark):
    rows = [
        ("m", "9", "r9", None), ("m", "10", "r10", None), ("m", "2", "r2", "other"),
        ("n", "1", "s1", "champion"), ("n", "2", "s2", None),
    ]
    df = spark.createDataFrame(rows, REGISTRY_SCHEMA)
    assert as_set(resolve_version(df)) == [("m", "10", "r10"), ("n", "1", "s1")]
    assert resolve_version(df.limit(0)).count() == 0


def test_training_registers_and_serving_follows(spark, trips, folder):
    registry = ModelRegistry(spark, folder("registry"))
    with pytest.raises(LookupError):
        registry.resolve("trips")
    with pytest.raises(ValueError, match="nope"):
        training.train_job(trips, registry, "trips", ["nope"])

    first = training.train_job(trips, registry, "trips", num_trees=3, max_depth=3, alias="champion")
    assert (first["version"], first["model_type"]) == ("1", "RandomForestClassifier")
    assert first["training_data_count"] + first["testing_data_count"] == 240
    assert 0 <= first["auc"] <= 1

    follower, patient = ModelFollower(registry, "trips", check_seconds=0), ModelFollower(registry, "trips", check_seconds=3600)
    patient(trips)
    before = follower(trips).select("bookingid", "prediction")
    loaded = registry.load("trips")
    assert loaded.metadata["feature_columns"] == list(prepare.MODEL_FEATURES)
    assert as_set(loaded(trips).select("bookingid", "prediction")) == as_set(before)

    training.train_job(trips, registry, "trips", num_trees=2, max_depth=2)
    kept = follower.current
    follower(trips)
    assert follower.current is kept  # the alias still points at version 1
    registry.set_alias("trips", "2")
    follower(trips)
    assert follower.current.version == "2"
    patient(trips)
    assert patient.current.version == "1"
    patient.serve("trips")
    patient(trips)
    assert patient.current.version == "2"
    assert as_set(registry.entries().select("version", F.coalesce("alias", F.lit("")))) == [("1", ""), ("2", "champion")]
    with pytest.raises(LookupError):
        registry.load("trips", "7")


def test_four_models_are_compared(trips):
    rows = {r["model"]: r for r in training.compare_models(trips).collect()}
    assert set(rows) == {"Random Forest", "Logistic Regression", "SVM", "Neural Network"}
    for name, row in rows.items():
        assert 0 <= row["accuracy"] <= 1 and 0 <= row["f1"] <= 1
        assert (row["auc"] is None) == (name == "SVM")


def test_selection_methods_vote(trips):
    votes = training.select_by_consensus(trips, FEATURE_COLUMNS, force_keep=["second"]).collect()
    assert {v["feature"] for v in votes} <= set(FEATURE_COLUMNS)
    assert all(v["keep"] == (v["votes"] >= 2 or v["feature"] == "second") for v in votes)
    importance = training.forest_selection(trips, FEATURE_COLUMNS).agg(F.sum("score")).first()[0]
    assert importance == pytest.approx(1.0)


def test_two_writers_lose_no_version(spark, folder, monkeypatch):
    """The other writer claims the number between the look at the table and the claim."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    model = PipelineModel([SQLTransformer(statement="SELECT *, 1D AS prediction FROM __THIS__")])
    one, two = ModelRegistry(spark, folder("registry")), ModelRegistry(spark, folder("registry"))
    claim = ModelRegistry._claim

    def late(self, what, least):
        if self is one and what.startswith("versions"):
            two.register("m", model, {"by": "two"})
        return claim(self, what, least)

    monkeypatch.setattr(ModelRegistry, "_claim", late)
    assert one.register("m", model, {"by": "one"}) == "2"
    assert sorted(r["version"] for r in one.entries().collect()) == ["1", "2"]
    assert [one.load("m", v).metadata["by"] for v in ("1", "2")] == ["two", "one"]
    one.set_alias("m", "1")
    two.set_alias("m", "2")
    assert one.resolve("m") == "2"


def test_optimality_is_a_zero_gap_at_the_minimum_only(spark):
    """Of a fitted L1 regression every gap is small; moved coefficients have larger ones."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    rng = random.Random(2)
    rows = []
    for _ in range(400):
        x = [rng.gauss(0, 1), rng.gauss(5, 3), rng.gauss(0, 0.1), 4.0]
        rows.append((Vectors.dense(x), int(x[0] + 0.3 * (x[1] - 5) + rng.gauss(0, 1) > 0)))
    data = spark.createDataFrame(rows, ["features", "label"])
    names = ["a", "b", "c", "constant"]

    class Moved:
        def __init__(self, coefficients, intercept):
            self.coefficients, self.intercept = coefficients, intercept

    for penalty in (0.0, 0.05):
        model = LogisticRegression(elasticNetParam=1.0, regParam=penalty, tol=1e-9, maxIter=500).fit(data)
        gaps = {r["feature"]: r["gap"] for r in selection.optimality(data, model, names, l1=penalty).collect()}
        assert gaps["constant"] is None and max(gaps[n] for n in "abc") < 1e-4
        moved = Moved([c + (0.5 if n == 0 else 0) for n, c in enumerate(model.coefficients)], model.intercept)
        assert {r["feature"]: r["gap"] for r in selection.optimality(data, moved, names, l1=penalty).collect()}["a"] > 0.01


def _gini(labels):
    share = sum(labels) / len(labels)
    return 2 * share * (1 - share)


def test_split_gains_equal_every_split_tried(spark):
    rng = random.Random(5)
    rows = [(rng.gauss(0, 3), float(rng.randrange(4)), 1.0, int(rng.random() < 0.4)) for _ in range(300)]
    rows = [(a, b, c, int(a + b > 2) if n % 3 else y) for n, (a, b, c, y) in enumerate(rows)]
    rows += [(None, 2.0, 1.0, 1), (0.5, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label int")
    got = {row["feature"]: row for row in selection.split_gains(df, ["a", "b", "c"], bins=8).collect()}
    assert set(got) == {"a", "b"}  # c does not vary
    for at, name in enumerate("ab"):
        known = [(row[at], row[3]) for row in rows if row[at] is not None and row[3] is not None]
        low, high = min(x for x, _ in known), max(x for x, _ in known)
        best = None
        for edge in range(1, 8):
            limit = low + edge * ((high - low) / 8)
            below, above = [y for x, y in known if x < limit], [y for x, y in known if x >= limit]
            if below and above:
                parts = len(below) * _gini(below) + len(above) * _gini(above)
                gain = _gini([y for _, y in known]) - parts / len(known)
                if best is None or gain > best[0] + 1e-9:
                    best = gain, len(below), sum(below)
        assert got[name]["gain"] == pytest.approx(best[0], abs=1e-8)
        assert (got[name]["rows_below"], got[name]["positives_below"]) == best[1:]


def test_split_gains_without_rows(spark):
    empty = spark.createDataFrame([], "a double, label int")
    assert selection.split_gains(empty, ["a"]).collect() == []


def test_importance_is_what_the_splits_gain(spark):
    rng = random.Random(6)
    rows = [(rng.random(), rng.random(), rng.random()) for _ in range(400)]
    rows = [(a, b, c, int(a + 0.5 * b > 0.8) ^ int(rng.random() < 0.1)) for a, b, c in rows]
    df = prepare.assemble_features(spark.createDataFrame(rows, "a double, b double, c double, label int"), ["a", "b", "c"])
    forest = classifiers.random_forest(8, 4).setBootstrap(False).fit(df)
    said = forest.featureImportances.toArray()
    got = {r["feature"]: r["score"] for r in selection.recomputed_importance(df, forest, ["a", "b", "c"]).collect()}
    assert [got[name] for name in "abc"] == pytest.approx(list(said), abs=1e-9)
    other = df.withColumn("label", 1 - (F.col("a") > F.col("c")).cast("int"))
    changed = {r["feature"]: r["score"] for r in selection.recomputed_importance(other, forest, ["a", "b", "c"]).collect()}
    assert max(abs(changed[name] - got[name]) for name in "abc") > 0.01


def test_counts_of_a_confusion_matrix(scored):
    rows = scored.select("label", "prediction").collect()
    got = evaluate.binary_counts(evaluate.confusion_matrix(scored)).first().asDict()
    pairs = [(row["label"] == 1, row["prediction"] == 1) for row in rows]
    assert got == {"tp": pairs.count((True, True)), "fp": pairs.count((False, True)),
                   "fn": pairs.count((True, False)), "tn": pairs.count((False, False))}
