"""Writing micro-batches so that a repeated batch leaves no trace."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]


def parquet_batches(path: str) -> BatchWriter:
    """One directory per batch, replaced when the batch is replayed after a failure."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All batches with their ``batch_id``."""
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(stored).option("basePath", path).parquet(path)


def start_batches(
    stream: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    *,
    output_mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Run ``write`` per micro-batch; without a trigger all available input is processed, then it ends."""
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def drain(query: StreamingQuery, seconds: float = 600.0) -> None:
    """Let a stream with timers run until its input is read and its timers have emptied its state, then stop it."""
    deadline = time.monotonic() + seconds
    try:
        while time.monotonic() < deadline:
            time.sleep(0.2)
            if query.exception() is not None:
                raise query.exception()
            progress = query.lastProgress
            if progress and progress["batchId"] > 0 and progress["numInputRows"] == 0 and not sum(
                operator["numRowsTotal"] for operator in progress["stateOperators"]
            ):
                return
        raise TimeoutError(f"the state was not empty after {seconds} s")
    finally:
        query.stop()
