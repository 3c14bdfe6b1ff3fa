"""Training jobs over the trip table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsense.modelling import classifiers, evaluate, selection
from tripsense.modelling.prepare import (
    EXPERIMENT_TRAIN_FRACTION,
    MODEL_FEATURES,
    SEED,
    TRAIN_FRACTION,
    assemble_features,
    check_columns,
    in_train,
    scale_features,
    train_test_split,
)
from tripsense.modelling.registry import ModelRegistry
from tripsense.operators.labels import label_classes
from tripsense.operators.ordering import union_all
from tripsense.session import cut_lineage


def train_job(
    trips: DataFrame,
    registry: ModelRegistry,
    name: str,
    feature_columns: Sequence[str] = MODEL_FEATURES,
    *,
    num_trees: int = classifiers.NUM_TREES,
    max_depth: int = classifiers.MAX_DEPTH,
    alias: str | None = None,
) -> dict:
    """Fit, measure on the held-out part, register as a new version.

    ``trips`` should be the stored table: the fit reads it several times, which is cheap for a column-pruned
    scan and not for an aggregation over samples. Trips without a label take no part.
    """
    check_columns(trips, [*feature_columns, "label"])
    trips = trips.filter("label IS NOT NULL")
    train, test = train_test_split(trips, TRAIN_FRACTION)
    counts = {row["train"]: row["n"] for row in
              trips.groupBy(in_train().alias("train")).agg(F.count(F.lit(1)).alias("n")).collect()}
    model = classifiers.production_pipeline(feature_columns, num_trees=num_trees, max_depth=max_depth).fit(train)
    scored = model.transform(test).select("label", evaluate.positive_score().alias("score")).persist()
    auc = evaluate.area_under_roc(scored, "score").first()["auc"]
    scored.unpersist()
    metadata = {
        "feature_columns": list(feature_columns),
        "model_type": "RandomForestClassifier",
        "num_trees": num_trees,
        "max_depth": max_depth,
        "seed": SEED,
        "training_data_count": counts.get(True, 0),
        "testing_data_count": counts.get(False, 0),
        "model_name": name,
    }
    version = registry.register(name, model, metadata, alias=alias)
    return {**metadata, "auc": auc, "version": version}


def compare_models(trips: DataFrame, feature_columns: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """``model, accuracy, f1, auc, rows, tp, fp, fn, tn`` of four classifiers on the same held-out trips.

    The scored rows of all models form one table, cut off from the models once, so each metric is one aggregation by
    model and no model scores a trip twice. The SVM gives no AUC: its raw margin is not reported as one.
    """
    data = scale_features(trips, feature_columns).select("bookingid", "features", F.col("label").cast("int").alias("label"))
    train, test = train_test_split(data, EXPERIMENT_TRAIN_FRACTION)
    classes = label_classes(data).first()["classes"]
    scored = cut_lineage(
        union_all(
            [
                estimator.fit(train)
                .transform(test)
                .select(F.lit(name).alias("model"), "label", "prediction", evaluate.positive_score().alias("score"))
                for name, estimator in classifiers.experiment_models(len(feature_columns), classes).items()
            ]
        )
    )
    confusion = evaluate.confusion_matrix(scored, ["model"])
    sizes = confusion.groupBy("model").agg(F.sum("n").alias("rows"))
    auc = evaluate.area_under_roc(scored.filter("model <> 'SVM'"), "score", ["model"])
    return (
        evaluate.accuracy(confusion, ["model"])
        .join(evaluate.weighted_f1(confusion, ["model"]), "model")
        .join(auc, "model", "left")
        .join(sizes, "model")
        .join(evaluate.binary_counts(confusion, ["model"]), "model")
    )


def forest_selection(trips: DataFrame, features: Sequence[str]) -> DataFrame:
    forest = classifiers.random_forest(classifiers.EXPERIMENT_TREES, 5).fit(assemble_features(trips, features))
    return selection.feature_importance(trips.sparkSession, forest, features)


def lasso_selection(trips: DataFrame, features: Sequence[str]) -> DataFrame:
    model = classifiers.lasso().fit(assemble_features(trips, features))
    return selection.lasso_coefficients(trips.sparkSession, model, features)


def audited_forest(trips: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, score, recomputed``: importances of a forest whose trees see every trip, and the same from the trips."""
    assembled = assemble_features(trips, features).filter("label IS NOT NULL")
    model = classifiers.random_forest(classifiers.EXPERIMENT_TREES, 5).setBootstrap(False).fit(assembled)
    said = selection.feature_importance(trips.sparkSession, model, features)
    counted = selection.recomputed_importance(assembled, model, features).withColumnRenamed("score", "recomputed")
    return said.join(counted, "feature")


def certified_lasso(trips: DataFrame, features: Sequence[str]) -> DataFrame:
    """The selection's coefficients, each with how far it is from the minimum of the penalised loss."""
    assembled = assemble_features(trips, features)
    model = classifiers.lasso().fit(assembled)
    return selection.optimality(assembled, model, features, l1=classifiers.LASSO_REGULARISATION)


def select_by_consensus(trips: DataFrame, features: Sequence[str], *, force_keep: Sequence[str] = ()) -> DataFrame:
    return selection.feature_consensus(
        selection.select_features(forest_selection(trips, features), selection.IMPORTANCE_THRESHOLD),
        selection.select_features(lasso_selection(trips, features), selection.COEFFICIENT_THRESHOLD),
        selection.select_features(selection.pearson_scores(trips, features), selection.CORRELATION_THRESHOLD),
        force_keep=force_keep,
    )


def probability_of_danger(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probability", vector_to_array("probability")[1])
