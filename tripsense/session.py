"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def object_store_options(endpoint: str, access_key: str, secret_key: str, *, tls: bool = False) -> dict[str, str]:
    """Session options for an S3-compatible store reached by path-style addresses."""
    scheme = "https" if tls else "http"
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint if "://" in endpoint else f"{scheme}://{endpoint}",
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }


def session_options() -> dict[str, str]:
    """Settings the operators are planned for; everything else stays at the cluster's own values."""
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **keyed_state_options(),
    }


def keyed_state_options() -> dict[str, str]:
    """Keyed streaming state on local disk with changelog upload, not on the JVM heap."""
    return {
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


# A sort or aggregation of this much data runs in an executor core's share of memory with little spilling.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_options(shuffled_bytes: int, *, least: int = 200) -> dict[str, str]:
    """Shuffle partitions for a given amount of shuffled data.

    Adaptive execution merges partitions that turn out small and splits skewed join sides, but it does not add
    partitions to an aggregation or a sort; those have to be planned.
    """
    partitions = max(least, -(-shuffled_bytes // SHUFFLE_PARTITION_BYTES))
    return {"spark.sql.shuffle.partitions": str(partitions)}


def build_session(app_name: str, *, master: str | None = None, options: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**session_options(), **(options or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Executors must see the folder, so a machine-local one is used only when the whole session is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if spark.conf.get("spark.master", "").startswith("local"):
        return tempfile.mkdtemp(prefix=f"tripsense-{label}-")
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a query go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, so the steps of a job add up on disk. A later reader
    of such files has their stage computed again.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def cut_lineage(frame: DataFrame) -> DataFrame:
    """The rows of ``frame`` as written to the shared checkpoint folder; nothing before it is computed again."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(frame.sparkSession, "checkpoints"))
    return frame.checkpoint()
