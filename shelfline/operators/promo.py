"""Promotion attribution, uplift, return and forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numbers import fine_sum, from_fine, ratio
from shelfline.session import kept


def revenue(qty: str = "qty", price: str = "net_price") -> Column:
    """Exact revenue sum, independent of the order of rows."""
    return from_fine(fine_sum(F.col(qty) * F.col(price)))


def attribute(sales: DataFrame, promos: DataFrame) -> DataFrame:
    """Promoted sales with each promotion of their category active at sale time.

    The interval join is an equality join on (category, month) with the exact
    bounds as a filter; a promotion is listed once per month it touches. A promotion
    without an end holds up to the last sale. The list of months is written once, so
    Spark knows its size: a small one is broadcast, a large one meets the sales by month.
    """
    if promos.filter("end_at IS NULL").isEmpty():
        end = F.col("end_at")
    else:
        last_sale = sales.agg(F.max("sold_at")).first()[0]
        end = F.coalesce("end_at", F.lit(last_sale).cast("timestamp") + F.expr("INTERVAL 1 MICROSECOND"))
    bounded = promos.withColumn("end_at", end).filter("start_at < end_at")
    last = F.col("end_at") - F.expr("INTERVAL 1 MICROSECOND")
    months = kept(bounded.select(
        "promo_id", "category", "depth", "start_at", "end_at",
        F.explode(F.sequence(F.date_trunc("month", "start_at"), F.date_trunc("month", last),
                             F.expr("INTERVAL 1 MONTH"))).alias("_month")))
    sold = sales.filter("is_promo").withColumn("_month", F.date_trunc("month", "sold_at"))
    return (sold.join(months, ["category", "_month"])
            .filter("sold_at >= start_at AND sold_at < end_at")
            .drop("_month", "start_at", "end_at"))


def promo_performance(sales: DataFrame, promos: DataFrame) -> DataFrame:
    """Lines, units, revenue and distinct orders of each promotion."""
    return (attribute(sales, promos).groupBy("promo_id", "category")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("qty").alias("units"), revenue().alias("revenue"),
                 F.count_distinct("order_id").alias("orders")))


def promo_uplift(sales: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    """Promoted mean quantity over the baseline mean, minus one.

    Both group sizes are reported: a thin baseline makes the uplift weak.
    """
    promo = F.when(F.col("is_promo"), F.col("qty"))
    base = F.when(~F.col("is_promo"), F.col("qty"))
    return (sales.groupBy(*by)
            .agg(F.count(promo).alias("n_promo"), F.count(base).alias("n_base"),
                 F.avg(promo).alias("promo_qty"), F.avg(base).alias("base_qty"))
            .withColumn("uplift", ratio(F.col("promo_qty"), F.col("base_qty")) - 1))


def promo_roi(sales: DataFrame, cost_ratio: float = 0.7,
              by: Sequence[str] = ("category",)) -> DataFrame:
    """(incremental margin - discount cost) / discount cost per group.

    Unit cost is ``cost_ratio`` of the list price. A promoted line's increment is
    its quantity beyond the group's baseline mean; the discount cost is the list
    value given away. ROI is null without a discount cost or a baseline.
    """
    listed = F.col("net_price") / F.nullif(1 - F.col("discount"), F.lit(0.0))
    margin = F.col("net_price") - cost_ratio * listed
    promo = F.col("is_promo")
    sums = sales.groupBy(*by).agg(
        F.avg(F.when(~promo, F.col("qty"))).alias("base_qty"),
        F.sum(F.when(promo, F.col("qty") * margin)).alias("_earned"),
        F.sum(F.when(promo, margin)).alias("_per_unit"),
        F.sum(F.when(promo, F.col("qty") * listed * F.col("discount"))).alias("discount_cost"))
    return (sums.withColumn("incremental_margin",
                            F.col("_earned") - F.col("base_qty") * F.col("_per_unit"))
            .withColumn("roi", ratio(F.col("incremental_margin") - F.col("discount_cost"),
                                     F.col("discount_cost")))
            .drop("_earned", "_per_unit"))


def promo_forecast(sales: DataFrame, plan: DataFrame) -> DataFrame:
    """Predicted units per line at planned depths: category, depth, predicted_qty.

    A straight line of quantity on depth is fitted per category.
    """
    fitted = sales.groupBy("category").agg(
        F.regr_slope("qty", "discount").alias("slope"),
        F.regr_intercept("qty", "discount").alias("intercept"),
        F.regr_count("qty", "discount").alias("n"))
    return (plan.join(fitted, "category", "left")
            .withColumn("predicted_qty", F.col("intercept") + F.col("slope") * F.col("depth")))


def promo_cube(sales: DataFrame) -> DataFrame:
    """Lines, units and revenue for every combination of category and depth.

    ``level`` is the grouping id: 0 both, 1 category, 2 depth, 3 total. Lines are summed per
    (category, depth) first, so the cube expands totals and not lines.
    """
    cells = sales.groupBy("category", F.col("discount").alias("depth")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("units"),
        fine_sum(F.col("qty") * F.col("net_price")).alias("money"))
    return (cells.cube("category", "depth")
            .agg(F.grouping_id().cast("int").alias("level"), F.sum("n").alias("n"),
                 F.sum("units").alias("units"), from_fine(F.sum("money")).alias("revenue")))
