"""Quality of scored rows, for one model or many at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsense.operators.ordering import with_prefix


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``label, prediction, n``: classes squared rows per model, whatever the size of the input."""
    return scored.groupBy(
        *by, F.col("label").cast("double").alias("label"), F.col("prediction").cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def accuracy(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    right = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return confusion.groupBy(*by).agg((right / F.sum("n")).alias("accuracy"))


def binary_counts(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``tp, fp, fn, tn`` of class 1 against every other."""
    real, said = F.col("label") == 1, F.col("prediction") == 1
    cells = {"tp": real & said, "fp": ~real & said, "fn": real & ~said, "tn": ~real & ~said}
    return confusion.groupBy(*by).agg(*[F.sum(F.when(cell, F.col("n")).otherwise(0)).alias(name) for name, cell in cells.items()])


def weighted_f1(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """F1 per class, weighted by how often the class occurs.

    Each cell counts once for its label and once for its prediction, so ``2 tp / (labelled + predicted)`` comes
    out of one aggregation.
    """
    roles = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("labelled"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("labelled"), F.col("n").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    cells = confusion.select(*by, hit.alias("hit"), F.inline(roles))
    classes = cells.groupBy(*by, "class").agg(
        (F.sum("hit") / 2).alias("hits"), F.sum("labelled").alias("labelled"), F.sum("predicted").alias("predicted")
    )
    f1 = F.col("labelled") * 2 * F.col("hits") / (F.col("labelled") + F.col("predicted"))
    return classes.groupBy(*by).agg((F.sum(f1) / F.sum("labelled")).alias("f1"))


def area_under_roc(scored: DataFrame, score: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Exact AUC as a rank sum over distinct scores; ties count one half.

    Rows are reduced to one per score before anything is ordered, and the running count of negatives is taken over
    ranges of scores.
    """
    score = F.col(score) if isinstance(score, str) else score
    per_score = scored.groupBy(*by, score.cast("double").alias("score")).agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") != 1).alias("negatives")
    )
    ranked = with_prefix(per_score, list(by), ["score"], value="negatives", out="below")
    below = F.col("positives") * (F.col("below") + F.col("negatives") / 2)
    pairs = F.sum("positives").cast("double") * F.sum("negatives")
    return ranked.groupBy(*by).agg(F.try_divide(F.sum(below), pairs).alias("auc"))


def positive_score() -> Column:
    """The score ROC curves are drawn over: the raw margin or vote of class 1."""
    return vector_to_array("rawPrediction")[1]
