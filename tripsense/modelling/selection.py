"""Which features matter: tree importance, L1 coefficients, correlation, and their vote."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripsense.operators.ordering import union_all
from tripsense.session import scratch_dir

# Least score to keep a feature.
IMPORTANCE_THRESHOLD = 0.01
CORRELATION_THRESHOLD = 0.01
COEFFICIENT_THRESHOLD = 1e-4
MIN_VOTES = 2

SPLIT_BINS = 32

_SCORES = "feature string, score double"


def _frame(spark: SparkSession, features: Sequence[str], scores: Sequence[float]) -> DataFrame:
    """One row per feature: as many as the model has inputs."""
    return spark.createDataFrame([(name, float(score)) for name, score in zip(features, scores, strict=True)], _SCORES)


def feature_importance(spark: SparkSession, forest: Model, features: Sequence[str]) -> DataFrame:
    return _frame(spark, features, forest.featureImportances.toArray())


def _unevenness(rows: Column, positives: Column) -> Column:
    """Gini impurity times the number of rows."""
    return 2 * positives * F.try_divide(rows - positives, rows)


def split_gains(df: DataFrame, features: Sequence[str], label: str = "label", *, bins: int = SPLIT_BINS) -> DataFrame:
    """``feature, threshold, rows_below, positives_below, gain``: the best single split of each feature by Gini impurity.

    Candidates are the inner edges of ``bins`` equal ranges between the least and the greatest value; a value on an edge is
    above it. All features are counted together in one aggregate of at most features x bins rows a task; of equal gains the
    lowest edge counts. A feature that does not vary has no split and no row, null values and labels take no part.
    """
    limits = df.filter(F.col(label).isNotNull()).agg(
        *[f(name).cast("double").alias(f"{f.__name__}_{name}") for name in features for f in (F.min, F.max)]
    ).first()
    varying = [(name, limits[f"min_{name}"], limits[f"max_{name}"]) for name in features]
    varying = [(name, low, high) for name, low, high in varying if low is not None and low < high]
    if not varying:
        return df.sparkSession.createDataFrame(
            [], "feature string, threshold double, rows_below long, positives_below long, gain double"
        )
    cells = [
        F.struct(
            F.lit(name).alias("feature"), F.lit(low).alias("low"), F.lit((high - low) / bins).alias("width"),
            # ``least`` would pass over a null.
            F.when(F.col(name).isNotNull(), F.least(F.floor((F.col(name) - low) / ((high - low) / bins)), F.lit(bins - 1)))
            .cast("int").alias("bin"),
        )
        for name, low, high in varying
    ]
    counted = (
        df.filter(F.col(label).isNotNull())
        .select(F.col(label).cast("int").alias("_label"), F.inline(F.array(*cells)))
        .filter("bin >= 0")
        .groupBy("feature", "low", "width", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_label") == 1).alias("p"))
    )
    whole = Window.partitionBy("feature")
    below = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    summed = counted.select(
        "feature", (F.col("low") + F.col("bin") * F.col("width")).alias("threshold"),
        F.sum("n").over(below).alias("rows_below"), F.sum("p").over(below).alias("positives_below"),
        F.sum("n").over(whole).alias("n"), F.sum("p").over(whole).alias("p"),
    ).filter("rows_below > 0")
    left = _unevenness(F.col("rows_below"), F.col("positives_below"))
    right = _unevenness(F.col("n") - F.col("rows_below"), F.col("p") - F.col("positives_below"))
    gain = F.round((_unevenness(F.col("n"), F.col("p")) - left - right) / F.col("n"), 9)
    best = summed.withColumn("gain", gain).groupBy("feature").agg(
        F.max_by(F.struct("threshold", "rows_below", "positives_below", "gain"), F.struct("gain", -F.col("threshold"))).alias("best")
    )
    return best.select("feature", "best.*")


def recomputed_importance(assembled: DataFrame, forest: Model, features: Sequence[str], label: str = "label") -> DataFrame:
    """``feature, score``: what the splits of a fitted forest gain on ``assembled``, counted anew from its rows.

    Equals the forest's own importances on the rows it was fitted on if every tree saw all of them once (``bootstrap=False``);
    on others it says what the splits are worth there. Each row is counted at its leaf of every tree, in one aggregate of as many
    rows as the forest has leaves and classes; counts of inner nodes are sums of those, level by level.
    """
    spark = assembled.sparkSession
    path = scratch_dir(spark, "forest")
    forest.write().overwrite().save(path)
    stored = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    nodes = stored.select(
        "treeID", F.col("id").cast("int").alias("id"), F.col("leftChild").cast("int").alias("left"),
        F.col("rightChild").cast("int").alias("right"), F.col("split.featureIndex").alias("of"),
    )
    # Nodes are numbered from left to right, and so are leaves.
    order = Window.partitionBy("treeID").orderBy("id")
    leaves = nodes.filter("left < 0").select("treeID", "id", (F.row_number().over(order) - 1).alias("leaf"))
    inner = nodes.filter("left >= 0")
    parents = union_all([inner.select("treeID", F.col(side).alias("id"), F.col("id").alias("parent")) for side in ("left", "right")])
    reached = (
        forest.copy().setLeafCol("_leaves").transform(assembled.select("features", F.col(label).cast("int").alias("_class")))
        .select("_class", F.posexplode(vector_to_array("_leaves")).alias("treeID", "leaf"))
        .groupBy("treeID", F.col("leaf").cast("int").alias("leaf"), "_class")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    level = reached.join(leaves, ["treeID", "leaf"]).select("treeID", "id", "_class", "n")
    counted = [level]
    for _ in range(max((tree.depth for tree in forest.trees), default=0)):
        level = level.join(parents, ["treeID", "id"]).groupBy("treeID", F.col("parent").alias("id"), "_class").agg(F.sum("n").alias("n"))
        counted.append(level)
    by_class = union_all(counted).groupBy("treeID", "id", "_class").agg(F.sum("n").alias("n"))
    uneven = by_class.groupBy("treeID", "id").agg(
        (F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("uneven")
    )
    gains = union_all([
        inner.select("treeID", "of", F.col(at).alias("id"), F.lit(sign).alias("sign"))
        for at, sign in (("id", 1), ("left", -1), ("right", -1))
    ]).join(uneven, ["treeID", "id"]).groupBy("treeID", "of").agg(F.sum(F.col("sign") * F.col("uneven")).alias("gain"))
    share = F.try_divide(F.col("gain"), F.sum("gain").over(Window.partitionBy("treeID")))
    sums = gains.select("of", share.alias("share")).groupBy("of").agg(F.sum("share").alias("share"))
    total = F.sum("share").over(Window.partitionBy())  # a row per feature
    named = spark.createDataFrame(list(enumerate(features)), "of int, feature string")
    scored = sums.select("of", F.try_divide("share", total).alias("score"))
    return named.join(scored, "of", "left").select("feature", F.coalesce("score", F.lit(0.0)).alias("score"))


def lasso_coefficients(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    return _frame(spark, features, model.coefficients.toArray())


def optimality(assembled: DataFrame, model: Model, features: Sequence[str], *, l1: float = 0.0, label: str = "label") -> DataFrame:
    """``feature, score, gradient, gap`` of a fitted logistic regression without or with L1 penalty.

    The loss has its minimum where, feature by feature, the gradient of the mean loss over the standardised feature is minus
    the penalty times the sign of the coefficient, or for a coefficient of zero at most the penalty. ``gap`` is how far a
    feature is from that. One aggregate over all rows; a feature that does not vary takes no part and has no gap.
    """
    values = vector_to_array("features")
    names = [f"_x{n}" for n in range(len(features))]
    margin = sum((F.lit(float(c)) * F.col(x) for c, x in zip(model.coefficients, names)), F.lit(float(model.intercept)))
    rows = assembled.select(F.col(label).cast("double").alias("_y"), *[values[n].alias(x) for n, x in enumerate(names)])
    wrong = 1 / (1 + F.exp(-margin)) - F.col("_y")
    sums = rows.withColumn("_wrong", wrong).agg(
        *[F.try_divide(F.avg(F.col("_wrong") * F.col(x)), F.nullif(F.stddev_samp(x), F.lit(0.0))).alias(x) for x in names]
    )
    scores = [F.struct(F.lit(name).alias("feature"), F.lit(float(c)).alias("score"), F.col(x).alias("gradient")) for name, c, x in zip(features, model.coefficients, names)]
    listed = sums.select(F.inline(F.array(*scores)))
    free = F.greatest(F.abs("gradient") - l1, F.lit(0.0))
    gap = F.when(F.col("score") == 0, free).otherwise(F.abs(F.col("gradient") + l1 * F.signum("score")))
    return listed.withColumn("gap", F.when(F.col("gradient").isNotNull(), gap))


def pearson_scores(trips: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """Absolute correlation of each feature with the label, all in one aggregate.

    A constant feature has no correlation (null); Spark's own ``corr`` would stop there on a division by zero.
    """
    y = F.col(label).cast("double")

    def pearson(name: str):
        return F.try_divide(F.covar_pop(F.col(name), y), F.stddev_pop(name) * F.stddev_pop(y))

    correlations = trips.agg(*[F.abs(pearson(name)).alias(name) for name in features])
    rows = [F.struct(F.lit(name).alias("feature"), F.col(name).alias("score")) for name in features]
    return correlations.select(F.inline(F.array(*rows)))


def select_features(scores: DataFrame, threshold: float) -> DataFrame:
    """Features whose absolute score exceeds the threshold."""
    return scores.filter(F.abs("score") > threshold)


def rank_features(scores: DataFrame) -> DataFrame:
    """``rank`` 1 is the highest score; the input has one row per feature, so one task can order it."""
    return scores.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "feature")))


def feature_consensus(
    forest: DataFrame,
    lasso: DataFrame,
    pearson: DataFrame,
    *,
    min_votes: int = MIN_VOTES,
    force_keep: Sequence[str] = (),
) -> DataFrame:
    """Votes per feature of three selections, and whether it is kept."""
    methods = {"forest": forest, "lasso": lasso, "pearson": pearson}
    votes = None
    for method, selected in methods.items():
        vote = selected.select("feature", F.lit(True).alias(method))
        votes = vote if votes is None else votes.join(vote, "feature", "full_outer")
    votes = votes.select("feature", *[F.coalesce(method, F.lit(False)).alias(method) for method in methods])
    total = sum((F.col(method).cast("int") for method in methods), F.lit(0))
    return votes.withColumn("votes", total).withColumn(
        "keep", (F.col("votes") >= min_votes) | F.col("feature").isin(list(force_keep))
    )
