"""Messages to the sample table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripsense.sources.messages import parse_messages
from tripsense.sources.schemas import RAW_SCHEMA
from tripsense.sources.tables import insert_raw
from tripsense.streaming.sinks import BatchWriter, parquet_batches, start_batches


def start_raw_ingest(
    samples: DataFrame, raw_path: str, checkpoint: str, *, arrival: Sequence[str], trigger: dict | None = None
) -> StreamingQuery:
    """Insert parsed samples, first writer wins. A replayed batch finds its own keys and adds nothing."""

    def insert(batch: DataFrame, batch_id: int) -> None:
        insert_raw(batch, raw_path, arrival)

    return start_batches(samples, insert, checkpoint, trigger=trigger)


def start_message_ingest(
    messages: DataFrame,
    raw_path: str,
    rejects_path: str,
    checkpoint: str,
    *,
    arrival: Sequence[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Insert JSON messages; text that does not parse or lacks part of the key is kept aside by batch."""
    keep_aside = parquet_batches(rejects_path)

    def insert(batch: DataFrame, batch_id: int) -> None:
        usable = "NOT rejected AND second IS NOT NULL"
        parsed = parse_messages(batch).persist()
        try:
            keep_aside(parsed.filter(f"NOT ({usable})").select("value"), batch_id)
            insert_raw(parsed.filter(usable).drop("value", "rejected"), raw_path, arrival)
        finally:
            parsed.unpersist()

    return start_batches(messages, insert, checkpoint, trigger=trigger)


def start_rejects(
    messages: DataFrame, write: BatchWriter, checkpoint: str, *, schema: T.StructType = RAW_SCHEMA, trigger: dict | None = None
) -> StreamingQuery:
    """The texts that a prediction or a feed over the same messages leaves out, for a writer of their own."""
    rejected = parse_messages(messages, schema).filter("rejected").select("value")
    return start_batches(rejected, write, checkpoint, trigger=trigger)
