"""JSON messages: topic options, parsing with rejects, and encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripsense.sources.schemas import RAW_SCHEMA, optional


def topic_source_options(
    servers: str, topic: str, *, starting: str = "latest", max_offsets_per_trigger: int | None = 1_000_000,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """``latest`` for scoring and ingest, ``earliest`` for a feed that replays predictions.

    The query stops when messages expired before it read them; ``fail_on_data_loss=False`` goes on without them.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def topic_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """``value`` and the arrival columns of a topic."""
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(F.col("value").cast("string").alias("value"), "timestamp", "partition", "offset")


def read_json_lines(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as a stream of ``value`` strings, in place of a topic."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parse_messages(messages: DataFrame, schema: T.StructType = RAW_SCHEMA, required: str = "bookingid") -> DataFrame:
    """The message fields plus ``value`` and a ``rejected`` flag.

    Malformed text, messages without the required field and messages with a value that its field's type cannot
    hold are flagged rather than raised, so one bad message does not stop the stream. Other columns (offsets,
    arrival time) are kept.
    """
    corrupt = "_unreadable"
    wanted = T.StructType([*optional(schema).fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json("value", wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
    return (
        messages.withColumn("_message", parsed)
        .select("*", "_message.*")
        .withColumn("rejected", F.col(required).isNull() | F.col(corrupt).isNotNull())
        .drop("_message", corrupt)
    )


def encode_messages(df: DataFrame, *, key: str | None = None) -> DataFrame:
    """``value`` holds the row as JSON; ``key`` keeps the messages of one trip in one partition, in order."""
    columns = [F.to_json(F.struct(*df.columns)).alias("value")]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)
