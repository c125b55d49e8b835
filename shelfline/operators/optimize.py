"""Price adjustment, what-if, optimum, recommendation and backtest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numbers import ratio
from shelfline.operators.price import slope
from shelfline.session import kept

COST_RATIO = 0.7


def price_base(sales: DataFrame) -> DataFrame:
    """Starting point per category: mean paid price, units and elasticity."""
    return sales.groupBy("category").agg(
        F.avg("net_price").alias("base_price"), F.sum("qty").alias("base_units"),
        slope().alias("elasticity"))


def _impact(delta: Column, cost_ratio: float) -> dict[str, Column]:
    price = F.col("base_price") * (1 + delta)
    units = F.col("base_units") * F.pow(1 + delta, F.col("elasticity"))
    return {"new_price": price, "units": units, "revenue": price * units,
            "margin": (price - cost_ratio * F.col("base_price")) * units}


def adjustment_impact(base: DataFrame, delta: float | Column,
                      cost_ratio: float = COST_RATIO) -> DataFrame:
    """Units, revenue and margin per category after a price change, and the changes.

    Unit cost is ``cost_ratio`` of the base price.
    """
    delta = delta if isinstance(delta, Column) else F.lit(float(delta))
    after = _impact(delta, cost_ratio)
    old_revenue = F.col("base_price") * F.col("base_units")
    return base.select(
        "*", *[c.alias(name) for name, c in after.items()],
        (after["units"] - F.col("base_units")).alias("units_change"),
        (after["revenue"] - old_revenue).alias("revenue_change"),
        (after["margin"] - (1 - cost_ratio) * old_revenue).alias("margin_change"))


def what_if(base: DataFrame, scenarios: dict[str, float],
            cost_ratio: float = COST_RATIO) -> DataFrame:
    """Every scenario (name to price change) of every category side by side.

    Scenarios are a short literal list, so they are unfolded in place.
    """
    rows = F.array(*[F.struct(F.lit(name).alias("scenario"), F.lit(float(d)).alias("delta"))
                     for name, d in scenarios.items()])
    unfolded = base.select("*", F.inline(rows))
    return adjustment_impact(unfolded, F.col("delta"), cost_ratio)


def optimal_price(base: DataFrame, bound: float = 0.2, steps: int = 20,
                  cost_ratio: float = COST_RATIO) -> DataFrame:
    """Grid point with the greatest margin within +/- ``bound`` of the base price.

    ``steps`` grid points lie on each side; a tie goes to the smallest change. The
    best point is picked inside each row, so nothing is shuffled.
    """
    grid = F.transform(F.sequence(F.lit(-steps), F.lit(steps)), lambda i: F.struct(
        _impact(i * F.lit(bound / steps), cost_ratio)["margin"].alias("margin"),
        (-F.abs(i)).alias("closeness"),
        (i * F.lit(bound / steps)).alias("delta")))
    return (base.withColumn("_best", F.array_max(grid))
            .withColumn("best_delta", F.col("_best.delta"))
            .withColumn("best_price", F.col("base_price") * (1 + F.col("best_delta")))
            .withColumn("best_margin", F.col("_best.margin")).drop("_best"))


def recommend(gap: DataFrame, product: DataFrame, optimal: DataFrame, market: DataFrame,
              tolerance: float = 0.05) -> DataFrame:
    """Raise, lower or hold per product.

    Three votes, each -1, 0 or 1: the gap to competitors, the category's optimal
    change, and the category's gap to the market (``market`` from
    ``market_position``). Two votes or more for a direction decide. The suggested price moves by
    the optimal change, or by ``tolerance`` where that points the other way.
    """
    def against(value: Column) -> Column:
        return F.when(value > tolerance, -1).when(value < -tolerance, 1).otherwise(0)

    joined = (gap.select("product_id", "own_price", "competitor_avg", "gap")
              .join(product.select("product_id", "category"), "product_id")
              .join(kept(optimal.select("category", "best_delta")), "category", "left")
              .join(kept(market.select("category", "market_gap")), "category", "left"))
    votes = (against(F.col("gap")) + against(F.col("market_gap"))
             + F.coalesce(F.signum("best_delta").cast("int"), F.lit(0)))
    way = F.when(votes >= 2, 1).when(votes <= -2, -1).otherwise(0)
    size = F.when(F.signum("best_delta").cast("int") == way, F.abs("best_delta")).otherwise(
        tolerance)
    return (joined.withColumn("votes", votes).withColumn("_way", way)
            .withColumn("action", F.when(way == 1, "raise").when(way == -1, "lower")
                        .otherwise("hold"))
            .withColumn("suggested_price", F.col("own_price") * (1 + F.col("_way") * size))
            .drop("_way"))


def market_position(by_month: DataFrame) -> DataFrame:
    """Own price against the market per category over all months of ``vs_market``."""
    return (by_month.filter("market_price IS NOT NULL").groupBy("category")
            .agg(F.sum(F.col("own_price") * F.col("n")).alias("_own"),
                 F.sum(F.col("market_price") * F.col("n")).alias("_market"))
            .select("category", (ratio(F.col("_own"), F.col("_market")) - 1).alias("market_gap")))


def backtest(sales: DataFrame, cut: str, by: Sequence[str] = ("category",)) -> DataFrame:
    """Fit price sensitivity before ``cut`` and score it on the sales from then on.

    Predicted quantity is base_qty x (price / base_price)^elasticity. Reports n,
    mean absolute error, mean absolute percentage error and bias.
    """
    when = F.lit(cut).cast("timestamp")
    train = sales.filter(F.col("sold_at") < when)
    fitted = kept(train.groupBy(*by).agg(F.avg("net_price").alias("_price"), F.avg("qty").alias("_qty"),
                                         slope().alias("elasticity")))
    scored = (sales.filter((F.col("sold_at") >= when) & (F.col("net_price") > 0))
              .join(fitted, list(by))
              .withColumn("_error", F.col("_qty") * F.pow(
                  F.col("net_price") / F.col("_price"), F.col("elasticity")) - F.col("qty")))
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs("_error")).alias("mae"),
        F.avg(F.abs("_error") / F.nullif("qty", F.lit(0.0))).alias("mape"),
        F.avg("_error").alias("bias"))
