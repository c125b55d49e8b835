"""Recency, frequency and monetary value of products."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from shelfline.functions.numbers import money_sum
from shelfline.functions.ordered import number_rows, tile


def rfm(sales: DataFrame, as_of: date | str) -> DataFrame:
    """Per product: days since the last sale, distinct orders, total amount."""
    return (sales.filter(F.col("sold_at") < F.date_add(F.lit(as_of).cast("date"), 1))
            .groupBy("product_id")
            .agg(F.datediff(F.lit(as_of).cast("date"), F.max("sold_at").cast("date"))
                 .alias("recency"),
                 F.count_distinct("order_id").alias("frequency"),
                 money_sum(F.col("amount")).alias("monetary")))


def rfm_score(rfm: DataFrame, tiles: int = 5) -> DataFrame:
    """Scores 1 to ``tiles`` per measure, best highest, ties by product_id.

    Equal to ``ntile`` over the whole table, without its single-task window.
    """
    placed = number_rows(rfm, {"_r": ("recency", False), "_f": ("frequency", True),
                               "_m": ("monetary", True)}, tie="product_id",
                         totals={"_rows": F.count(F.lit(1))})
    return placed.select(*rfm.columns, *[
        tile(F.col(place), F.col("_rows"), tiles).alias(score)
        for place, score in (("_r", "r_score"), ("_f", "f_score"), ("_m", "m_score"))])


def rfm_segment(scored: DataFrame) -> DataFrame:
    """Add ``segment`` from the scores."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.withColumn("segment", (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "star")
        .when((f >= 4) & (r <= 2), "fading")
        .when((r >= 4) & (f <= 2), "rising")
        .when((r <= 2) & (f <= 2) & (m <= 2), "dormant")
        .otherwise("steady")))


def segment_sizes(segmented: DataFrame) -> DataFrame:
    """Products and amount per segment."""
    return segmented.groupBy("segment").agg(
        F.count(F.lit(1)).alias("products"), money_sum(F.col("monetary")).alias("monetary"))
