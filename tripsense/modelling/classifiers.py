"""The classifiers compared in the experiments and the one trained for production."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)

from tripsense.modelling.prepare import MODEL_FEATURES, SEED, assembler

# Training parameters.
NUM_TREES = 100
MAX_DEPTH = 10
EXPERIMENT_TREES = 50
EXPERIMENT_DEPTH = 8
SVM_ITERATIONS = 10
MLP_HIDDEN = (16, 8)
MLP_BLOCK = 128
MLP_ITERATIONS = 100
LASSO_REGULARISATION = 0.01

_COLUMNS = {"featuresCol": "features", "labelCol": "label"}


def random_forest(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=seed, **_COLUMNS)


def logistic() -> LogisticRegression:
    return LogisticRegression(**_COLUMNS)


def lasso() -> LogisticRegression:
    return LogisticRegression(elasticNetParam=1.0, regParam=LASSO_REGULARISATION, **_COLUMNS)


def linear_svm() -> LinearSVC:
    return LinearSVC(maxIter=SVM_ITERATIONS, **_COLUMNS)


def perceptron(features: int, classes: int, seed: int = SEED) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(
        layers=[features, *MLP_HIDDEN, classes], blockSize=MLP_BLOCK, maxIter=MLP_ITERATIONS, seed=seed, **_COLUMNS
    )


def experiment_models(features: int, classes: int) -> dict[str, Estimator]:
    # The names the four models are reported under.
    return {
        "Random Forest": RandomForestClassifier(numTrees=EXPERIMENT_TREES, seed=SEED, **_COLUMNS),
        "Logistic Regression": logistic(),
        "SVM": linear_svm(),
        "Neural Network": perceptron(features, classes),
    }


def production_pipeline(columns: Sequence[str] = MODEL_FEATURES, **parameters: int) -> Pipeline:
    """Assembler and forest together, so that serving applies exactly what training did."""
    return Pipeline(stages=[assembler(columns), random_forest(**parameters)])
