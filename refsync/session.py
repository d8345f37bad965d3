"""Session settings and shared working storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Joins against tables too large to broadcast rely on the runtime re-plan to
# split the partition of a hot key, also where that costs one more shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# What one shuffle partition should hold, so that it sorts and joins in memory.
PARTITION_BYTES = 128 * 1024 * 1024

_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def configure(spark: SparkSession, shuffled_bytes: int | None = None) -> SparkSession:
    """Set the runtime options the operators count on; all are per session.

    ``shuffled_bytes``, the size of the largest input that is shuffled, raises
    the number of shuffle partitions to fit it; the re-plan puts small ones
    together again.
    """
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffled_bytes is not None:
        current = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = -(-shuffled_bytes // PARTITION_BYTES)
        spark.conf.set("spark.sql.shuffle.partitions", max(current, wanted))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster."""
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
    return configured.rstrip("/")


def name_local_folder(spark: SparkSession) -> SparkSession:
    """Name a folder for a local session that has none. For entry points of a sandbox only."""
    if not spark.conf.get(CHECKPOINT_DIR, None) and spark.conf.get("spark.master", "").startswith(
        "local["
    ):
        spark.conf.set(CHECKPOINT_DIR, tempfile.mkdtemp(prefix="refsync-"))
    return spark


def new_shared_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables that were materialized inside, once the block has written its results.

    Only for blocks that leave no lazy result behind.
    """
    made: list[str] = []
    outer = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(outer)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark._jsc.hadoopConfiguration()
        for path in made:
            folder = hadoop(path)
            folder.getFileSystem(conf).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that outlives any executor, and computes the
    input once where several results are drawn from it.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
