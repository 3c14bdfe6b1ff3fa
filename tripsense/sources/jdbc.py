"""Options for database tables read and written in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tripsense.operators.ordering import with_prefix

# A list of predicates is planned and sent on by the driver.
MOST_RANGES = 100_000


def pending_query(raw_table: str, trips_table: str) -> str:
    """A ``dbtable`` value that leaves the exclusion of consolidated trips to the database."""
    return (
        f"(SELECT r.* FROM {raw_table} r WHERE NOT EXISTS"
        f" (SELECT 1 FROM {trips_table} t WHERE t.bookingid = r.bookingid)) AS pending"
    )


def jdbc_options(
    url: str, table: str, user: str, password: str, *, driver: str = "org.postgresql.Driver", batch: int = 10_000
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": str(batch),
        "batchsize": str(batch),
    }


def partition_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Split a scan into ranges of ``column``; bounds set the stride only, rows outside them are still read."""
    if partitions < 1 or upper <= lower:
        raise ValueError(f"need partitions >= 1 and lower < upper, got {partitions}, {lower}, {upper}")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def range_starts(rows: DataFrame, column: str, within: str, partitions: int) -> DataFrame:
    """``range, key, inner``: where each of at most ``partitions`` ranges of about as many rows begins.

    Rows are counted by ``column``, which a database does itself when ``rows`` reads from one. A key with more rows than a range
    should hold is cut at values of ``within`` too; ``inner`` is null where a range begins with the key itself. Nulls come first.
    Rows equal in both columns, and rows without a key, stay in one range.
    """
    if not 1 <= partitions <= MOST_RANGES:
        raise ValueError(f"need 1 to {MOST_RANGES} partitions, got {partitions}")
    counts = rows.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") * partitions > total
    inner_type = rows.schema[within].dataType
    # Less than ``partitions`` keys are hot.
    hot_keys = F.broadcast(counts.filter(hot).select(F.col("key").alias("_hot")))
    cut = (
        rows.join(hot_keys, F.col(column) == F.col("_hot"))
        .groupBy(F.col(column).alias("key"), F.col(within).alias("inner"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    whole = counts.filter(~hot | F.col("key").isNull()).select("key", F.lit(None).cast(inner_type).alias("inner"), "n")
    before = with_prefix(whole.unionByName(cut), [], ["key", "inner"], value="n", out="before")
    placed = before.select(F.expr(f"cast(before * {partitions} div {max(total, 1)} as int)").alias("range"), "key", "inner")
    first = F.min(F.struct("key", "inner")).alias("first")
    return placed.groupBy("range").agg(first).select("range", "first.key", "first.inner")


def balanced_predicates(rows: DataFrame, column: str, within: str, partitions: int) -> list[str]:
    """Conditions for ``spark.read.jdbc(predicates=...)``: every row meets exactly one, and each is met by about as many.

    Both columns are integers. One condition, true of every row, comes back where nothing can be divided.
    """
    starts = range_starts(rows, column, within, partitions).orderBy("range").collect()  # at most ``partitions`` rows
    cuts = [(row["key"], row["inner"]) for row in starts[1:]]

    def before(key: int, inner: int | None) -> str:
        if inner is None:
            return f"({column} < {key} OR {column} IS NULL)"
        return f"({column} < {key} OR {column} IS NULL OR ({column} = {key} AND ({within} < {inner} OR {within} IS NULL)))"

    def since(key: int, inner: int | None) -> str:
        if inner is None:
            return f"{column} >= {key}"
        return f"({column} > {key} OR ({column} = {key} AND {within} >= {inner}))"

    lower = ["1 = 1" if not number else since(*cuts[number - 1]) for number in range(len(cuts) + 1)]
    upper = [before(*cut) for cut in cuts] + ["1 = 1"]
    return [f"{low} AND {high}" for low, high in zip(lower, upper)]


def read_balanced(spark: SparkSession, options: dict[str, str], predicates: Sequence[str]) -> DataFrame:
    """A table read in one task per predicate."""
    known = {"url", "dbtable"}
    properties = {key: value for key, value in options.items() if key not in known}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(predicates), properties=properties)


def jdbc_reader(spark: SparkSession, options: dict[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(**options)


def append_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()
