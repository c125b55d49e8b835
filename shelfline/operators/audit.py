"""Audit rows for every step of a job."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import (
    LongType, MapType, StringType, StructField, StructType, TimestampType,
)

AUDIT = StructType([
    StructField("run_id", StringType()), StructField("step", StringType()),
    StructField("started_at", TimestampType()), StructField("ended_at", TimestampType()),
    StructField("status", StringType()), StructField("counts", MapType(StringType(), LongType())),
])


def audited(spark: SparkSession, audit_path: str, run_id: str, step: str, source: DataFrame,
            work: Callable[[DataFrame], DataFrame],
            write: Callable[[DataFrame], None],
            reject: Callable[[DataFrame], None]) -> dict[str, int]:
    """Run ``work`` (frame to rows with the rules they fail, see ``quality.checked``), write both kinds, log one audit row.

    The source is read and worked on once: one job counts the rows that go in, out and to the side and holds them, in
    memory and else on the executors' disks, from where ``write`` and ``reject`` each read their own part. A failed
    step is logged with status "failed" and raises.
    """
    started, counts, status = datetime.now(timezone.utc), {}, "failed"
    try:
        seen = Observation(f"{step}-in")
        bad = F.size("failed") > 0
        rows = work(source.observe(seen, F.count(F.lit(1)).alias("rows"))).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            split = rows.agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad")).first()
            write(rows.filter(~bad).drop("failed"))
            reject(rows.filter(bad))
        finally:
            rows.unpersist()
        counts = {"rows_in": seen.get["rows"], "rows_out": split["good"], "rows_rejected": split["bad"]}
        status = "done"
    finally:
        row = (run_id, step, started, datetime.now(timezone.utc), status, counts)
        spark.createDataFrame([row], AUDIT).write.mode("append").parquet(audit_path)
    return counts


def audit_log(spark: SparkSession, audit_path: str) -> DataFrame:
    """All audit rows with the run time in seconds."""
    return spark.read.schema(AUDIT).parquet(audit_path).withColumn(
        "seconds", (F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1e6)
