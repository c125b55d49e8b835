"""Decoding, lateness, duplicates, windowed aggregates, joins and latency.

The functions take streaming frames of the price_event contract and, unless
noted, give the same result on static ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from shelfline.functions.numbers import share_of
from shelfline.functions.ordered import GROUP_ROWS, OrderedGroups
from shelfline.operators.quality import split_corrupt
from shelfline.session import kept
from shelfline.streaming.generations import stream_id

DELAY = "10 minutes"


def decode(stream: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(decoded, malformed): payload fields in columns, bad payloads kept as text."""
    return split_corrupt(stream, "payload", schema)


def with_lateness(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Watermark on event_time: aggregates drop rows later than ``delay``; the bronze
    copy of the topic keeps them."""
    return stream.withWatermark("event_time", delay)


def dedup_stream(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """One row per event_id; a stream forgets ids ``delay`` after their event time."""
    if not stream.isStreaming:
        return stream.dropDuplicates(["event_id"])
    return with_lateness(stream, delay).dropDuplicatesWithinWatermark(["event_id"])


def _stats(stream: DataFrame, span: Column, by: Sequence[str], delay: str) -> DataFrame:
    return (with_lateness(stream, delay).groupBy(span.alias("_span"), *by)
            .agg(F.count(F.lit(1)).alias("n"), F.avg("new_price").alias("avg_price"),
                 F.min("new_price").alias("min_price"), F.max("new_price").alias("max_price"))
            .select(F.col("_span.start").alias("start_at"), F.col("_span.end").alias("end_at"),
                    *by, "n", "avg_price", "min_price", "max_price"))


def agg_tumbling(stream: DataFrame, size: str = "1 hour",
                 by: Sequence[str] = ("topic", "retailer_id"), delay: str = DELAY) -> DataFrame:
    """Event count and price statistics per fixed window."""
    return _stats(stream, F.window("event_time", size), by, delay)


def agg_sliding(stream: DataFrame, size: str = "1 hour", step: str = "15 minutes",
                by: Sequence[str] = ("topic", "retailer_id"), delay: str = DELAY) -> DataFrame:
    """The same over windows of ``size`` starting every ``step``."""
    return _stats(stream, F.window("event_time", size, step), by, delay)


def agg_session(stream: DataFrame, gap: str = "30 minutes",
                by: Sequence[str] = ("product_id",), delay: str = DELAY,
                group_rows: int = GROUP_ROWS) -> DataFrame:
    """Bursts: events of a product no further than ``gap`` apart.

    On a stream these are session windows. A static frame is cut, for keys of more than ``group_rows`` events and more than
    a task's share, into slices along time; bursts are found in each slice, and only the first and
    last one of a slice are compared with those of the slices beside it.
    """
    if stream.isStreaming:
        return _stats(stream, F.session_window("event_time", gap), by, delay)
    by = list(by)
    rows = stream.filter("event_time IS NOT NULL").select(*by, "event_time", "new_price")
    groups = OrderedGroups(rows, by, ["event_time"], group_rows)
    if groups.hot is None:
        bursts = _bursts(rows, by, F.col("event_time"), F.col("event_time"), gap, {
            "n": F.count(F.lit(1)), "priced": F.count("new_price"), "total": F.sum("new_price"),
            "min_price": F.min("new_price"), "max_price": F.max("new_price")})
    else:
        part = [*by, "_slice"]
        parts = _bursts(groups.slice(rows), part, F.col("event_time"), F.col("event_time"), gap, {
            "n": F.count(F.lit(1)), "priced": F.count("new_price"), "total": F.sum("new_price"),
            "min_price": F.min("new_price"), "max_price": F.max("new_price")})
        at_end = F.col("_burst") == F.max("_burst").over(Window.partitionBy(*part))
        parts = kept(parts.withColumn("_edge", (F.col("_slice") >= 0) & ((F.col("_burst") == 1) | at_end)))
        joined = _bursts(parts.filter("_edge").drop("_burst"), by, F.col("first"), F.col("last"), gap, {
            "n": F.sum("n"), "priced": F.sum("priced"), "total": F.sum("total"),
            "min_price": F.min("min_price"), "max_price": F.max("max_price")})
        bursts = parts.filter("NOT _edge").select(*joined.columns).unionByName(joined)
    return bursts.select(
        F.col("first").alias("start_at"), (F.col("last") + F.expr(f"INTERVAL {gap}")).alias("end_at"), *by, "n",
        (F.col("total") / F.nullif("priced", F.lit(0))).alias("avg_price"), "min_price", "max_price")


def _bursts(rows: DataFrame, keys: Sequence[str], start: Column, end: Column, gap: str,
            measures: dict[str, Column]) -> DataFrame:
    """Per key the stretches of rows of which none starts later than ``gap`` after all before it have ended.

    ``_burst`` numbers them, ``first`` and ``last`` are where they start and end.
    """
    rows = rows.withColumns({"_start": start, "_end": end})
    along = Window.partitionBy(*keys).orderBy("_start", "_end")
    fresh = F.coalesce(F.col("_start") > F.lag("_end").over(along) + F.expr(f"INTERVAL {gap}"), F.lit(True))
    so_far = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("_fresh", fresh.cast("int")).withColumn("_burst", F.sum("_fresh").over(so_far))
    return numbered.groupBy(*keys, "_burst").agg(
        F.min("_start").alias("first"), F.max("_end").alias("last"), *[m.alias(name) for name, m in measures.items()])


def enrich(stream: DataFrame, product: DataFrame, retailer: DataFrame) -> DataFrame:
    """Add product and retailer attributes from static tables."""
    return (stream.join(product, "product_id", "left")
            .join(retailer, "retailer_id", "left"))


def promo_reaction(promo: DataFrame, price: DataFrame, delay: str = DELAY) -> DataFrame:
    """Price changes within one hour after a promotion event of the same product.

    Each price change comes out once, whatever the number of promotions before it.
    The join key holds the hour, so a busy product spreads over tasks and state: a
    promotion counts for its own hour and the next. A static promotion side shrinks to
    its first and last event per product and hour, which decide the test.
    """
    hour = F.date_trunc("hour", "event_time")
    starts = promo.select("product_id", F.col("event_time").alias("promo_time"))
    if not promo.isStreaming:
        starts = (starts.groupBy("product_id", F.date_trunc("hour", "promo_time").alias("_h"))
                  .agg(F.min("promo_time").alias("first"), F.max("promo_time").alias("last"))
                  .select("product_id", F.explode(F.array_distinct(F.array("first", "last")))
                          .alias("promo_time")))
    else:
        starts = starts.withWatermark("promo_time", delay)
        price = with_lateness(price, delay)
    promo_hour = F.date_trunc("hour", "promo_time")
    starts = starts.select(F.col("product_id").alias("promo_product"), "promo_time",
                           F.explode(F.array(promo_hour, promo_hour + F.expr("INTERVAL 1 HOUR")))
                           .alias("promo_hour"))
    changes = price.withColumn("_hour", hour)
    return changes.join(starts, F.expr(
        "product_id = promo_product AND _hour = promo_hour AND event_time >= promo_time "
        "AND event_time < promo_time + INTERVAL 1 HOUR"), "left_semi").drop("_hour")


def latency(stream: DataFrame, arrived: Column | None = None, target_seconds: float = 300.0,
            by: Sequence[str] = ("topic",)) -> DataFrame:
    """Seconds from event time to processing: median, p95, maximum, share in target.

    ``arrived`` is the processing time, the current time by default. Percentiles
    are sketches of bounded size.
    """
    arrived = F.current_timestamp() if arrived is None else arrived
    waited = (F.unix_micros(arrived) - F.unix_micros("event_time")) / 1e6
    return (stream.withColumn("_waited", waited).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.percentile_approx("_waited", 0.5, 10000).alias("p50"),
                 F.percentile_approx("_waited", 0.95, 10000).alias("p95"),
                 F.max("_waited").alias("slowest"),
                 share_of(F.col("_waited") <= target_seconds).alias("within_target")))


# Most values a quantile state of one batch and group holds: its rank error is about 1 in 20,000.
QUANTILE_STATE = 32_768
_LATENCY = "topic string, n bigint, within bigint, slowest double, sketch binary"


def latency_states(batch: DataFrame, arrived: Column, target_seconds: float = 300.0) -> DataFrame:
    """Per topic what ``merged_latency`` adds up: counts, the slowest, and a mergeable quantile sketch."""
    waited = (F.unix_micros(arrived) - F.unix_micros("event_time")) / 1e6
    return (batch.withColumn("_waited", waited).filter("_waited IS NOT NULL").groupBy("topic")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_waited") <= target_seconds).alias("within"),
                 F.max("_waited").alias("slowest"),
                 F.kll_sketch_agg_double("_waited", F.lit(QUANTILE_STATE)).alias("sketch")))


def merged_latency(states: DataFrame) -> DataFrame:
    """The report of ``latency`` from the states of any number of batches."""
    merged = states.groupBy("topic").agg(
        F.sum("n").alias("n"), F.sum("within").alias("within"), F.max("slowest").alias("slowest"),
        F.kll_merge_agg_double("sketch", QUANTILE_STATE).alias("sketch"))
    return merged.select("topic", "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(name) for name, p in (("p50", 0.5), ("p95", 0.95))],
        "slowest", (F.col("within") / F.col("n")).alias("within_target"))


def latency_stream(stream: DataFrame, path: str, checkpoint: str, arrived: Column | None = None,
                   target_seconds: float = 300.0) -> DataStreamWriter:
    """Writer that keeps the latency of a running stream: one small state per batch and topic below ``path``.

    ``arrived`` is the time of the batch by default. A batch that is run again replaces its state.
    ``read_latency`` merges the states at any time, also while the stream runs.
    """
    def put(batch: DataFrame, number: int) -> None:
        states = latency_states(batch, F.current_timestamp() if arrived is None else arrived, target_seconds)
        name = stream_id(batch.sparkSession, checkpoint)
        states.coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}/{number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def read_latency(spark: SparkSession, path: str) -> DataFrame:
    """Latency per topic over all batches that ``latency_stream`` has seen."""
    return merged_latency(spark.read.schema(_LATENCY).parquet(f"{path}/*/*"))
