"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

A row sits on the ring at the hash of its id and a tie. Every shard has ``VIRTUAL_NODES`` points there, and a row belongs to the
first shard clockwise from it; what a full shard cannot hold goes on clockwise to the next distinct shard. The walk runs
over ``CELLS`` equal arcs of the ring, of which one aggregate gives the sizes, so it is as long for any amount of data;
the rows only look up their arc's shard. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripsense.llm.common import cut
from tripsense.operators.ordering import join_null_safe, with_prefix

SHARDS = 16
VIRTUAL_NODES = 64
CELL_BITS = 16
CELLS = 1 << CELL_BITS
SLACK = 1 / 512
ROUNDS_AT_ONCE = 4
# So many rows that are alike in id and tie may move as one.
COPIES = 16


def _preferences(spark: SparkSession, shards: int, virtual_nodes: int) -> DataFrame:
    """``(cell, choices)``: the shards of every arc in the order in which they are met clockwise."""
    shard, node = F.floor(F.col("id") / virtual_nodes), F.col("id") % virtual_nodes
    nodes = spark.range(shards * virtual_nodes).select(
        F.shiftrightunsigned(F.xxhash64(F.lit("shard"), shard, node), 64 - CELL_BITS).cast("int").alias("at"),
        shard.cast("int").alias("shard"),
    )
    met = nodes.groupBy("at").agg(
        *[F.max(F.col("shard") == s).alias(f"on_{s}") for s in range(shards)]
    )
    around = spark.range(2 * CELLS).select(F.col("id").cast("int").alias("place"), (F.col("id") % CELLS).cast("int").alias("at"))
    # Backwards, so that the frame only ever grows by the current row.
    ahead = Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nearest = around.join(met, "at", "left").select(
        "place",
        *[F.last(F.when(F.col(f"on_{s}"), F.col("place")), ignorenulls=True).over(ahead).alias(f"next_{s}") for s in range(shards)],
    ).filter(F.col("place") < CELLS)
    order = F.array_sort(F.array(*[F.struct(F.col(f"next_{s}").alias("d"), F.lit(s).alias("s")) for s in range(shards)]))
    return nearest.select(F.col("place").alias("cell"), F.transform(order, lambda x: x["s"]).alias("choices"))


def _offer(cells: DataFrame, capacity: float) -> DataFrame:
    """One step: shards keep what they hold and take what fits, the larger arcs first; the rest asks the next shard."""
    asked = F.col("choices")[F.col("turn")]
    shard = Window.partitionBy(asked).orderBy(F.col("held").desc(), F.col("load").desc(), "cell")
    fits = F.sum("load").over(shard.rowsBetween(Window.unboundedPreceding, Window.currentRow)) <= F.lit(capacity)
    open_ = F.col("turn") < F.size("choices")
    return cells.withColumn("fits", F.when(open_, fits).otherwise(F.lit(False))).select(
        "cell", "load", "rows", "choices", F.col("fits").alias("held"),
        F.when(F.col("fits") | ~open_, F.col("turn")).otherwise(F.col("turn") + 1).alias("turn"),
    )


def _settle(cells: DataFrame, shards: int, slack: float) -> DataFrame:
    """``(cell, shard, rows)`` with no shard above its bound.

    The bound is the mean load times ``1 + slack``. Arcs that no shard could take whole, which happens where single rows
    are large against a shard, start anew with the bound raised by the largest of them.
    """
    total = cells.agg(F.sum("load")).first()[0] or 0
    capacity = total / shards * (1 + slack)
    cells = cells.withColumn("turn", F.lit(0)).withColumn("held", F.lit(False))
    while True:
        for _ in range(ROUNDS_AT_ONCE):
            cells = _offer(cells, capacity)
        cells = cut(cells)
        state = cells.agg(
            F.max((~F.col("held")) & (F.col("turn") < shards)).alias("open"),
            F.max(F.when(~F.col("held") & (F.col("turn") >= shards), F.col("load"))).alias("left"),
        ).first()
        if state["open"]:
            continue
        if state["left"] is None:
            return cells.select("cell", F.col("choices")[F.col("turn")].alias("shard"), "rows")
        capacity += state["left"]
        cells = cells.withColumn("turn", F.when(F.col("held"), F.col("turn")).otherwise(F.lit(0)))


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text column, null as none."""
    return F.octet_length(F.coalesce(F.col(text).cast("string"), F.lit(""))).cast("long")


def _numbered(keyed: DataFrame) -> DataFrame:
    """``keyed`` with ``_copy``: 0, but a running number where more than ``COPIES`` rows share id and tie."""
    many = keyed.groupBy("_id", "_tie").agg(F.count("*").alias("n")).filter(F.col("n") > COPIES).select("_id", "_tie")
    many = cut(many)
    if many.isEmpty():
        return keyed.withColumn("_copy", F.lit(0).cast("long"))
    one = with_prefix(join_null_safe(keyed, many, ["_id", "_tie"], "left_semi"), ["_id", "_tie"], ["_bytes"], out="_copy")
    return join_null_safe(keyed, many, ["_id", "_tie"], "left_anti").withColumn("_copy", F.lit(0).cast("long")).unionByName(one)


def shard_rows(
    rows: DataFrame, *, id: str = "doc_id", size: str | Column = "size", tie: str | Column | None = None,
    shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES, slack: float = SLACK,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``, a gapless number from 0 in the shard; columns of these names are replaced.

    The load of a row is ``size`` plus one, null as none. Rows with equal ids, null ids among them, are told apart by ``tie``
    (their size if none is given). Rows equal in both share a place on the ring if they are at most ``COPIES``; more are
    spread by their numbers. An empty table stays empty.
    """
    size, tie = (F.col(c) if isinstance(c, str) else c for c in (size, size if tie is None else tie))
    others = [c for c in rows.columns if c not in ("shard", "slot")]
    keyed = rows.select(
        F.struct(*others).alias("row"), F.col(id).alias("_id"),
        (F.coalesce(size.cast("long"), F.lit(0)) + 1).alias("_bytes"), F.xxhash64(F.col(id).isNull(), tie).alias("_tie"),
    )
    spot = F.xxhash64(F.lit("row"), "_id", "_tie", "_copy")
    placed = _numbered(keyed).withColumn("_spot", spot).withColumn(
        "_cell", F.shiftrightunsigned("_spot", 64 - CELL_BITS).cast("int")
    )
    loads = placed.groupBy("_cell").agg(F.sum("_bytes").alias("load"), F.count("*").alias("rows"))
    cells = _preferences(rows.sparkSession, shards, virtual_nodes).join(
        loads.withColumnRenamed("_cell", "cell"), "cell"
    )
    settled = _settle(cells, shards, slack)
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    lookup = settled.select(
        F.col("cell").alias("_cell"), "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("_cell").orderBy("_spot", "_id", "_tie", "_copy", "_bytes")
    numbered = placed.withColumn("_rank", F.row_number().over(within))
    # At most CELLS rows of three numbers are broadcast, whatever the input.
    return numbered.join(F.broadcast(lookup), "_cell").select(
        "row.*", "shard", (F.col("_before") + F.col("_rank") - 1).cast("long").alias("slot")
    )
