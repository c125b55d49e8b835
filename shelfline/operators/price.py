"""Price comparison, history, trend, movement and sensitivity."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.merging import averaged, counted, summed_below
from shelfline.functions.numbers import ratio
from shelfline.functions.ordered import GROUP_ROWS, OrderedGroups
from shelfline.operators.quality import dedup
from shelfline.schemas import OBSERVED_ORDER

SERIES = ("product_id", "retailer_id")


def current_price(obs: DataFrame) -> DataFrame:
    """Latest observation of each product and retailer."""
    return dedup(obs, SERIES, OBSERVED_ORDER)


def price_gap(current: DataFrame, own: int = 0) -> DataFrame:
    """Own price against the competitors' current prices, per product.

    gap = (own - mean of competitors) / mean of competitors. One aggregate
    instead of a self join; products without an own price or without a competitor
    are left out.
    """
    mine = F.col("retailer_id") == own
    rival = F.when(~mine, F.col("price"))
    return (current.groupBy("product_id")
            .agg(F.max(F.when(mine, F.col("price"))).alias("own_price"),
                 F.count(rival).alias("n_competitors"),
                 F.min(rival).alias("competitor_min"),
                 F.avg(rival).alias("competitor_avg"),
                 F.max(rival).alias("competitor_max"))
            .filter("own_price IS NOT NULL AND n_competitors > 0")
            .withColumn("gap", ratio(F.col("own_price") - F.col("competitor_avg"),
                                     F.col("competitor_avg"))))


def price_rank(current: DataFrame, own: int = 0) -> DataFrame:
    """Where the own price stands among the retailers of a product, cheapest first.

    A product's group holds at most one row per retailer.
    """
    by_price = Window.partitionBy("product_id").orderBy("price")
    return (current.select("product_id", "retailer_id", "price",
                           F.rank().over(by_price).alias("price_rank"),
                           F.dense_rank().over(by_price).alias("dense_price_rank"),
                           F.percent_rank().over(by_price).alias("price_percent_rank"))
            .filter(F.col("retailer_id") == own))


def price_matrix(current: DataFrame, retailers: Sequence[int]) -> DataFrame:
    """Products in rows, one price column ``retailer_<id>`` per retailer."""
    wide = (current.groupBy("product_id").pivot("retailer_id", list(retailers))
            .agg(F.max("price")))
    return wide.select("product_id", *[F.col(str(r)).alias(f"retailer_{r}") for r in retailers])


def category_prices(obs: DataFrame, product: DataFrame) -> DataFrame:
    """Price statistics by category and brand with subtotals.

    ``level`` is the grouping id: 0 brand, 1 category, 3 everything. Prices are
    summed per product before the join and per brand before the rollup.
    """
    per_product = obs.groupBy("product_id").agg(
        F.count("price").alias("n"), F.sum("price").alias("total"),
        F.min("price").alias("low"), F.max("price").alias("high"))
    per_brand = (per_product.join(product.select("product_id", "category", "brand"), "product_id")
                 .groupBy("category", "brand")
                 .agg(F.sum("n").alias("n"), F.sum("total").alias("total"),
                      F.min("low").alias("low"), F.max("high").alias("high")))
    return (per_brand.rollup("category", "brand")
            .agg(F.grouping_id().alias("level"), F.sum("n").alias("n"),
                 ratio(F.sum("total"), F.sum("n")).alias("avg_price"),
                 F.min("low").alias("min_price"), F.max("high").alias("max_price"))
            .select("category", "brand", F.col("level").cast("int").alias("level"), "n",
                    "avg_price", "min_price", "max_price"))


def price_trend(df: DataFrame, by: Sequence[str], grain: str = "month", k: int = 3,
                frame: str = "rows", dimension: DataFrame | None = None) -> DataFrame:
    """Mean price per period with change and moving average.

    ``dimension`` holds the columns ``by`` per product_id, if ``df`` has them not; prices are then summed per product
    before they meet it.

    ``frame`` "rows" averages the last ``k`` periods that hold data, "range" the
    last ``k`` calendar periods. Windows run over one row per period.
    """
    if grain not in ("day", "week", "month", "quarter", "year"):
        raise ValueError(f"unknown grain {grain!r}")
    period = F.date_trunc(grain, F.col("observed_at"))
    if dimension is None:
        periods = (df.groupBy(*by, period.alias("period"))
                   .agg(F.count("price").alias("n"), F.avg("price").alias("avg_price")))
    else:
        periods = summed_below(df, ["product_id"], dimension, by, {
            "n": counted("price"), "avg_price": averaged("price")}, {"period": period})
    along = Window.partitionBy(*by).orderBy("period")
    before = F.lag("avg_price").over(along)
    if frame == "rows":
        moving = F.avg("avg_price").over(along.rowsBetween(-k + 1, 0))
    else:
        step = f"{(k - 1) * 3} MONTH" if grain == "quarter" else f"{k - 1} {grain.upper()}"
        keys = ", ".join(f"`{c}`" for c in by)
        moving = F.expr(f"avg(avg_price) OVER (PARTITION BY {keys} ORDER BY period "
                        f"RANGE BETWEEN INTERVAL {step} PRECEDING AND CURRENT ROW)")
    return periods.select("*", (F.col("avg_price") - before).alias("change"),
                          ratio(F.col("avg_price") - before, before).alias("pct_change"),
                          moving.alias("moving_avg"))


def price_moves(obs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Change from the previous observation of the same product and retailer."""
    groups = OrderedGroups(obs, SERIES, OBSERVED_ORDER, group_rows)
    moved = groups.shift(obs, {"old_price": "price", "old_at": "observed_at"})
    change = F.col("price") - F.col("old_price")
    return (moved.filter("old_price IS NOT NULL")
            .withColumn("change", change)
            .withColumn("pct", ratio(change, F.col("old_price")))
            .withColumn("direction", F.signum("change").cast("int")))


def significant_moves(moves: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Moves of at least ``threshold`` in either direction."""
    return moves.filter(F.abs("pct") >= threshold)


def price_history(obs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Validity intervals [valid_from, valid_to) of each product and retailer.

    The last observation at one instant counts; equal neighbours are merged; the
    open interval has null valid_to. All three steps share one shuffle.
    """
    groups = OrderedGroups(obs, SERIES, OBSERVED_ORDER, group_rows)
    at_end = groups.shift(obs, {"_next_at": "observed_at"}, forward=True).filter(
        "_next_at IS NULL OR _next_at > observed_at").drop("_next_at")
    changed = groups.shift(at_end, {"_old": "price"}).filter(
        "_old IS NULL OR _old <> price").drop("_old")
    return (groups.shift(changed, {"valid_to": "observed_at"}, forward=True)
            .select(*SERIES, "price", F.col("observed_at").alias("valid_from"), "valid_to"))


def price_as_of(history: DataFrame, at: datetime | str) -> DataFrame:
    """The price that was valid at a time."""
    t = F.lit(at).cast("timestamp")
    return (history.filter((F.col("valid_from") <= t)
                           & (F.col("valid_to").isNull() | (t < F.col("valid_to"))))
            .select(*SERIES, "price", "valid_from"))


def asof_price(sales: DataFrame, obs: DataFrame, own: int = 0,
               group_rows: int = GROUP_ROWS) -> DataFrame:
    """Each own sale with the last competitor price at or before it.

    Both sides are stacked and the last price is carried forward, so each row is
    shuffled and sorted once and no pairs are formed.
    """
    rivals = obs.filter(F.col("retailer_id") != own).select(
        "product_id", F.col("observed_at").alias("at"), F.lit(0).alias("is_sale"),
        "order_id", "line_no", F.col("price").alias("tie"),
        F.col("price").alias("rival_price"), F.col("retailer_id").alias("rival"),
        F.lit(None).cast("double").alias("net_price"))
    own_sales = sales.filter(F.col("retailer_id") == own).select(
        "product_id", F.col("sold_at").alias("at"), F.lit(1).alias("is_sale"),
        "order_id", "line_no", F.col("net_price").alias("tie"),
        F.lit(None).cast("double").alias("rival_price"),
        F.lit(None).cast("bigint").alias("rival"), "net_price")
    both = rivals.unionByName(own_sales).withColumn("is_price", F.col("is_sale") == 0)
    groups = OrderedGroups(both, ["product_id"],
                           ["at", "is_sale", "order_id", "line_no", "tie"], group_rows)
    found = groups.last_known(both, {"competitor_price": "rival_price",
                                     "competitor_id": "rival", "competitor_at": "at"}, "is_price")
    return found.filter("is_sale = 1").select(
        "order_id", "line_no", "product_id", F.col("at").alias("sold_at"), "net_price",
        "competitor_price", "competitor_id", "competitor_at")


def slope() -> Column:
    """Aggregate: slope of ln(qty) on ln(net_price) over the rows where both are positive.

    Stands beside other aggregates of the same rows, so they need no scan of their own.
    """
    both = (F.col("qty") > 0) & (F.col("net_price") > 0)
    return F.regr_slope(F.when(both, F.ln("qty")), F.when(both, F.ln("net_price")))


def elasticity(sales: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    """Price sensitivity: slope of ln(qty) on ln(net_price), R² and n per group."""
    y, x = F.ln("qty"), F.ln("net_price")
    return (sales.filter("qty > 0 AND net_price > 0").groupBy(*by)
            .agg(F.regr_slope(y, x).alias("elasticity"), F.regr_r2(y, x).alias("r2"),
                 F.regr_count(y, x).alias("n")))


def vs_market(obs: DataFrame, market: DataFrame, own: int = 0, dimension: DataFrame | None = None) -> DataFrame:
    """Own mean price against the market trend by category and month.

    ``obs`` carries a category column, or ``dimension`` has one per product_id: prices are then summed per product
    before they meet it.
    """
    mine, month = obs.filter(F.col("retailer_id") == own), F.date_trunc("month", F.col("observed_at"))
    if dimension is None:
        mine = (mine.groupBy("category", month.alias("month"))
                .agg(F.avg("price").alias("own_price"), F.count("price").alias("n")))
    else:
        mine = summed_below(mine, ["product_id"], dimension, ["category"], {
            "own_price": averaged("price"), "n": counted("price")}, {"month": month})
    return (mine.join(market, ["category", "month"], "left")
            .withColumn("market_gap", ratio(F.col("own_price") - F.col("market_price"),
                                            F.col("market_price"))))
