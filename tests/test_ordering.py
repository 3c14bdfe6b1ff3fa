from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tripsense.operators import ordering
from tripsense.operators.ordering import with_prefix


def spark_order(value):
    """Null first, NaN last."""
    if value is None:
        return (0, 0.0)
    return (2, 0.0) if math.isnan(value) else (1, value)


def expected_ranks(rows):
    ranks = {}
    for key, group in itertools.groupby(sorted(rows, key=lambda r: (str(r[0]), spark_order(r[1]), r[2])), key=lambda r: r[0]):
        for rank, row in enumerate(group):
            ranks[row[2]] = rank
    return ranks


@pytest.mark.parametrize("group_rows", [1000, 100, 7, 1])
def test_ranks_do_not_depend_on_how_groups_are_split(spark, group_rows):
    random.seed(3)
    odd = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0]
    rows = [("hot", random.choice([random.gauss(0, 1), random.random() * 1e6, 5.0]), 0) for _ in range(400)]
    rows += [("hot", value, 0) for value in odd] + [("odd", value, 0) for value in odd * 3]
    rows += [("same", 1.0, 0) for _ in range(60)] + [(None, float(i), 0) for i in range(50)]
    rows += [(f"t{i}", random.random(), 0) for i in range(30)]
    random.shuffle(rows)
    rows = [(key, None if value is None else value + 0.0, i) for i, (key, value, _) in enumerate(rows)]
    df = spark.createDataFrame(rows, "key string, x double, id long").repartition(5)
    got = with_prefix(df, ["key"], ["x", "id"], out="rank", group_rows=group_rows)
    assert {row["id"]: row["rank"] for row in got.collect()} == expected_ranks(rows)
    assert set(got.columns) == {"key", "x", "id", "rank"}


def test_running_sums_over_the_whole_table(spark):
    rows = [(i * 0.5, i) for i in range(500)]
    df = spark.createDataFrame(rows, "x double, weight long").repartition(4)
    plain = with_prefix(df, [], ["x"], value="weight", out="before")
    split = with_prefix(df, [], ["x"], value="weight", out="before", group_rows=20)
    expected = {x: sum(range(w)) for x, w in rows}
    assert {r["x"]: r["before"] for r in plain.collect()} == expected
    assert {r["x"]: r["before"] for r in split.collect()} == expected


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "long"])
def test_leading_column_types(spark, kind):
    df = spark.range(200).select(
        F.lit(1).alias("key"),
        "id",
        (F.col("id").cast("long") if kind == "long" else
         F.timestamp_seconds(F.col("id") * 90_000).cast(kind)).alias("at"),
    )
    got = with_prefix(df.repartition(3), ["key"], ["at"], out="rank", group_rows=10)
    assert all(row["id"] == row["rank"] for row in got.collect())


def test_local_times_keep_their_order_over_a_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.range(200).selectExpr(
            "1 AS key", "id", "CAST('2024-03-10 00:00:00' AS TIMESTAMP_NTZ) + make_dt_interval(0, 0, id * 2) AS at"
        )
        got = with_prefix(df.repartition(3), ["key"], ["at"], out="rank", group_rows=10).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(row["id"] == row["rank"] for row in got)


def test_a_hot_key_with_tied_leading_values_spreads_over_tasks(spark):
    df = spark.range(20_000).select(F.lit(1).alias("key"), (F.col("id") % 3).alias("x"), "id")
    ranked = with_prefix(df, ["key"], ["x", "id"], out="rank", group_rows=500)
    assert ranked.filter("rank <> (id div 3) + CASE x WHEN 0 THEN 0 WHEN 1 THEN 6667 ELSE 13334 END").count() == 0
    cuts = ordering._cuts(df, ["key"], ["x", "id"], 500)
    place = ordering._place(F.col("_cuts"), ordering._tuple(df, ["x", "id"]))
    sizes = df.join(cuts, "key").groupBy(place.alias("piece")).count().collect()
    assert 30 <= len(sizes) <= 50 and max(r["count"] for r in sizes) < 1500


def test_rows_tied_in_their_whole_order_are_cut(spark):
    df = spark.range(5000).select(F.lit(1).alias("key"), F.lit(2.0).alias("x"), "id")
    ranked = with_prefix(df, ["key"], ["x"], out="rank", group_rows=100)
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(5000))
    assert "_piece" in ranked._jdf.queryExecution().optimizedPlan().toString()


def test_a_hot_row_is_counted_before_the_sample_comes_together(spark):
    """Equal rows are in the sample all or not at all; their list of cuts has each tuple once."""
    rows = spark.range(40_000).select(
        F.lit(1).alias("key"), F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).cast("long").alias("x"),
    )
    cuts = ordering._cuts(rows, ["key"], ["x"], 16).first()["_cuts"]
    assert len(cuts) == len(set(cuts)) <= 500 and any(cut["x"] == 7 for cut in cuts)
    assert cuts == sorted(cuts)
    ranks = with_prefix(rows, ["key"], ["x"], out="rank", group_rows=1000).groupBy("x").agg(F.min("rank"), F.max("rank"), F.count("*"))
    expected, before = {}, 0
    for x in sorted({7, *range(1, 500, 2)}):
        size = 80 + 20_000 * (x == 7)
        expected[x] = (before, before + size - 1, size)
        before += size
    assert {row[0]: tuple(row[1:]) for row in ranks.collect()} == expected


def test_groups_below_the_limit_are_left_whole_beside_a_large_one(spark):
    df = spark.range(6000).select(F.when(F.col("id") < 5000, 0).otherwise(F.col("id") % 100).alias("key"), F.col("id").alias("x"))
    cut = {row["key"] for row in ordering._cuts(df, ["key"], ["x"], 800).collect()}
    assert cut == {0}


def test_places_equal_a_linear_count(spark):
    rows = [(list(range(0, 2 * n, 2)), x) for n in range(12) for x in range(-1, 2 * n + 2)]
    df = spark.createDataFrame(rows, "cuts array<int>, x int").withColumn("place", ordering._place(F.col("cuts"), F.col("x")))
    assert all(r["place"] == sum(c <= r["x"] for c in r["cuts"]) for r in df.collect())


def test_nothing_is_written_and_small_groups_take_one_exchange(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("key"), F.col("id").alias("x"))
    ranked = with_prefix(df, ["key"], ["x"], out="rank")
    plan = ranked.groupBy("key").agg(F.max("rank"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ExistingRDD" not in plan
    cut = with_prefix(df, ["key"], ["x"], out="rank", group_rows=3)._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in cut


def test_pieces_grow_when_there_would_be_too_many(spark, monkeypatch):
    monkeypatch.setattr(ordering, "MOST_CUTS", 4)
    df = spark.range(1000).select(F.lit(1).alias("key"), F.col("id").alias("x"))
    ranked = with_prefix(df, ["key"], ["x"], out="rank", group_rows=1)
    assert ranked.filter("rank <> x").count() == 0


def test_empty_table_and_no_keys(spark):
    df = spark.createDataFrame([], "key long, x long")
    assert with_prefix(df, ["key"], ["x"], out="rank").collect() == []
    assert with_prefix(df, [], ["x"], out="rank").columns == ["key", "x", "rank"]
