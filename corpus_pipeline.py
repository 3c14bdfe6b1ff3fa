"""A training corpus from raw documents: filter, de-duplicate, decontaminate, mix and shard.

Each stage takes what the one before kept, as written and read again, and returns the columns of documents; the last one
adds the shard and the place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripsense.llm import decontaminate, mixing, ring, simhash, toxicity
from tripsense.llm.common import table
from tripsense.session import scratch_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_harmless(docs, machine)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles are linked by at most three differing bits."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row per document and reading of its source."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, each with a shard of the ring and its slot there."""
    return ring.shard_rows(docs, size=ring.text_bytes("text"), tie="text")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Learnt scores, fingerprints and random draws are beyond SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    place = scratch_dir(spark, "corpus")
    for number, (name, stage) in enumerate(STAGES):
        out = f"{place}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
