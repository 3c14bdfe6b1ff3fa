"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsense.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def words(text: str | None) -> list[bytes]:
    """Maximal runs of anything but space and U+0009 to U+000D, as UTF-8; null has none."""
    return text.encode().split() if text else []


def map_batches(frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow``; for a function whose state does not outlive its partition."""
    return frame.mapInArrow(function, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def cut(frame: DataFrame) -> DataFrame:
    """The rows of ``frame``, written to the shared checkpoint folder, so that nothing before it is computed again.

    The folder is ``spark.checkpoint.dir``; only a session that is local as a whole and sets none gets its own.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(frame.sparkSession, "checkpoints"))
    return frame.checkpoint()


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Runs of equal keys in a sorted partition, each as slices of the batches it lies in.

    Every group is held once, so the caller bounds the rows of a group.
    """
    held: list[pa.RecordBatch] = []
    held_key: tuple | None = None
    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [rows.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(rows.num_rows, dtype=bool)
        for column in columns:
            changed[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(changed).tolist(), rows.num_rows]
        for start, end in zip(starts, starts[1:]):
            key = tuple(column[start] for column in columns)
            if held and key != held_key:
                yield held_key, held
                held = []
            held_key = key
            held.append(rows.slice(start, end - start))
    if held:
        yield held_key, held


def numbers(slices: list[pa.RecordBatch], name: str) -> np.ndarray:
    return np.concatenate([s.column(name).to_numpy(zero_copy_only=False) for s in slices])


def text_key(text: str) -> list:
    """Columns that name a row by id and text; rows equal in both get equal decisions from any operator."""
    return [F.xxhash64(F.coalesce(F.col(text), F.lit("\0"))).alias("_text_hash")]
