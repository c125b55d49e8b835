"""Topics landed in bronze and aggregated from the same batches.

Every event of a batch goes to bronze; those in time also go to window states. Which are too late is decided as
streaming aggregates do it: the watermark is the latest event time seen less the delay, a window that has ended by
then is closed, and the batch after that leaves out its events. They are counted, and bronze has them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from shelfline.schemas import PRICE_EVENT, schema_of
from shelfline.session import kept, scratch_scope
from shelfline.sinks.layers import write_bronze
from shelfline.streaming.generations import BatchTable, added_up, newest, stream_id
from shelfline.streaming.windows import DELAY

BY = ("topic", "retailer_id")
_MEASURES = {"n": F.sum, "priced": F.sum, "total": F.sum, "min_price": F.min, "max_price": F.max}
_PROGRESS = schema_of("stream string, landed bigint, late bigint, undated bigint, latest_micros bigint, "
                      "before_micros bigint")


def _windows(spark: SparkSession, path: str, by: Sequence[str], events: StructType) -> BatchTable:
    measured = schema_of("n bigint, priced bigint, total double, min_price double, max_price double")
    keys = ["start_at", "end_at", *by]
    schema = StructType([*schema_of("start_at timestamp, end_at timestamp").fields, *[events[c] for c in by], *measured.fields])
    return BatchTable(spark, f"{path}/windows", schema, keys, added_up(keys, _MEASURES))


def _progress(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, f"{path}/progress", _PROGRESS, ["stream"], newest(["stream"], [], by_batch=True))


def land(stream: DataFrame, root: str, dataset: str, path: str, checkpoint: str, size: str = "1 hour",
         by: Sequence[str] = BY, delay: str = DELAY, fold_every: int = 64) -> DataStreamWriter:
    """Writer of a topic to bronze ``dataset`` below ``root`` and of its price statistics per window to ``path``.

    A batch is read once. Run again, it replaces its bronze run, its window states and its progress row. States hold
    counts, sums and extremes, which ``read_windows`` merges; every ``fold_every`` batches they are folded.
    """
    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = stream_id(spark, checkpoint)
        windows, progress = _windows(spark, path, by, batch.schema), _progress(spark, path)
        if number and number % fold_every == 0:
            windows.fold((name, number))
            progress.fold((name, number))
        with scratch_scope(spark):
            rows = kept(batch)
            write_bronze(rows, root, dataset, f"{name}-{number}", "stream")
            before = progress.read((name, number)).filter(F.col("stream") == name).first()
            known = before["latest_micros"] if before else None
            closed = F.lit(before["before_micros"] if before else None).cast("bigint") - F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {delay})")
            placed = rows.select(*by, "new_price", F.window("event_time", size).alias("_w"))
            late = F.coalesce(F.unix_micros("_w.end") <= closed, F.lit(False))
            in_time = placed.filter(~late)
            windows.put(in_time.groupBy(F.col("_w.start").alias("start_at"), F.col("_w.end").alias("end_at"), *by).agg(
                F.count(F.lit(1)).alias("n"), F.count("new_price").alias("priced"), F.sum("new_price").alias("total"),
                F.min("new_price").alias("min_price"), F.max("new_price").alias("max_price")), name, number)
            so_far = lambda c: F.lit(before[c] if before else 0)
            counts = rows.agg(F.count(F.lit(1)).alias("landed"), F.count_if(F.col("event_time").isNull()).alias("undated"),
                              F.max(F.unix_micros("event_time")).alias("latest"))
            n_late = placed.agg(F.count_if(late).alias("late")).first()["late"]
            progress.put(counts.select(
                F.lit(name).alias("stream"), (so_far("landed") + F.col("landed")).alias("landed"),
                (so_far("late") + F.lit(n_late)).alias("late"), (so_far("undated") + F.col("undated")).alias("undated"),
                F.greatest("latest", F.lit(known).cast("bigint")).alias("latest_micros"),
                F.lit(known).cast("bigint").alias("before_micros")), name, number)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def read_windows(spark: SparkSession, path: str, by: Sequence[str] = BY, closed_after: str | None = None,
                 events: StructType = PRICE_EVENT) -> DataFrame:
    """Price statistics per window over all batches landed; with ``closed_after``, a delay, only of closed windows."""
    rows = _windows(spark, path, by, events).read()
    if closed_after is not None:
        latest = _progress(spark, path).read().agg(F.max("latest_micros")).first()[0]
        end = F.timestamp_micros(F.lit(latest).cast("bigint")) - F.expr(f"INTERVAL {closed_after}")
        rows = rows.filter(F.col("end_at") <= end)
    return rows.select("start_at", "end_at", *by, "n", (F.col("total") / F.nullif("priced", F.lit(0))).alias("avg_price"),
                       "min_price", "max_price")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Per stream the events landed, those too late for their window, those without a time, and the latest time."""
    return _progress(spark, path).read()
