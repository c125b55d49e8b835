"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every operator counts on. Shuffle width, memory and broadcast
# threshold stay with the cluster: joins carry no broadcast hint, so Spark
# broadcasts a side only when its measured size is below that threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A task that writes a few folders keeps a file open for each and need not sort its rows by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}

# How files of lasting tables are compressed: about a fifth smaller than by Spark's default codec.
CODEC = "zstd"

_local_scratch: dict[str, str] = {}
# The folder of the innermost ``scratch_scope``.
_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def settle(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a session and return it."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession) -> str:
    """A new folder path below ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary
    folder; a cluster must name a shared one, since executors can be lost.
    """
    base = _scope.get() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="shelfline-")
        base = _local_scratch[app]
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a folder from the file system it lies on."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch folders made inside lie in one folder, which goes when the scope ends.

    For work that writes its results before it ends, as a micro-batch does; a frame that
    reads a scratch table must not leave the scope.
    """
    path = scratch(spark)
    token = _scope.set(path)
    try:
        yield path
    finally:
        _scope.reset(token)
        dropped(spark, path)


def kept(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    Cuts the lineage of a frame that several branches of a plan use; unlike a
    cache it survives the loss of executors and keeps column pruning. It also tells
    the planner the frame's true size: a small result is then broadcast because it
    was measured to be small, and a large one is joined by a shuffle.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """How many tasks one shuffle is cut into."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
