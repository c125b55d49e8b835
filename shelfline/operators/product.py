"""Price bands, best sellers, contribution and demand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.numbers import ratio
from shelfline.functions.ordered import exact_quantiles, number_rows
from shelfline.operators.price import slope
from shelfline.operators.promo import revenue
from shelfline.session import kept


def quantile_edges(df: DataFrame, price: str, bands: int) -> list[float]:
    """Inner edges that cut the prices into ``bands`` equal parts."""
    probs = [i / bands for i in range(1, bands)]
    found = exact_quantiles(df, [], price, probs).first()
    return list(found["quantiles"]) if found else []


def price_band(df: DataFrame, price: str, edges: Sequence[float]) -> DataFrame:
    """Add ``band``: how many of the rising ``edges`` the price has reached."""
    return df.withColumn("band", F.when(F.col(price).isNotNull(), _last_edge(price, edges)))


def _last_edge(price: str, edges: Sequence[float]) -> Column:
    label = F.lit(0)
    for number, edge in enumerate(edges, 1):
        label = F.when(F.col(price) >= float(edge), number).otherwise(label)
    return label


def product_totals(sales: DataFrame) -> DataFrame:
    """Units, revenue and mean paid price of each product."""
    return (sales.groupBy("product_id", "category")
            .agg(F.sum("qty").alias("units"), revenue().alias("revenue"))
            .withColumn("paid_price", ratio(F.col("revenue"), F.col("units"))))


def best_sellers(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with most units in each category, ties by product_id.

    Spark keeps ``k`` rows per category in each task before the shuffle.
    """
    return _leading(product_totals(sales), k)


def _leading(totals: DataFrame, k: int) -> DataFrame:
    top = Window.partitionBy("category").orderBy(F.col("units").desc(), "product_id")
    return totals.withColumn("place", F.row_number().over(top)).filter(F.col("place") <= k)


def top_products(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with most units overall."""
    return (product_totals(sales)
            .orderBy(F.col("units").desc(), "product_id").limit(k))


def best_seller_share(sales: DataFrame, k: int, edges: Sequence[float]) -> DataFrame:
    """Products, best sellers and their share per price band."""
    totals = kept(product_totals(sales))
    best = _leading(totals, k).select("product_id", F.lit(True).alias("_best"))
    banded = price_band(totals, "paid_price", edges)
    return (banded.join(best, "product_id", "left").groupBy("band")
            .agg(F.count(F.lit(1)).alias("products"), F.count("_best").alias("best_sellers"))
            .withColumn("share", ratio(F.col("best_sellers"), F.col("products"))))


def product_performance(sales: DataFrame) -> DataFrame:
    """Totals per product, its share of revenue and the share summed from the top.

    ``place`` orders by revenue, ties by product_id.
    """
    totals = product_totals(sales).withColumn("_money", F.col("revenue").cast("decimal(28,6)"))
    placed = number_rows(totals, {"place": ("revenue", False)}, tie="product_id",
                         running={"_so_far": "_money"}, totals={"_whole": F.sum("_money")})
    return (placed.withColumn("share", ratio(F.col("_money"), F.col("_whole")))
            .withColumn("cumulative_share", ratio(F.col("_so_far"), F.col("_whole")))
            .drop("_money", "_so_far", "_whole"))


def price_demand_corr(sales: DataFrame, by: Sequence[str] = ("category",)) -> DataFrame:
    """Correlation and covariance of paid price and quantity per group."""
    return sales.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.corr("net_price", "qty").alias("corr"),
        F.covar_samp("net_price", "qty").alias("covar"))


def demand_forecast(sales: DataFrame, deltas: Sequence[float]) -> DataFrame:
    """Mean quantity per category under price changes: qty x (1 + delta)^elasticity."""
    base = sales.groupBy("category").agg(F.avg("qty").alias("base_qty"), slope().alias("elasticity"))
    return (base
            .withColumn("delta", F.explode(F.array(*[F.lit(float(d)) for d in deltas])))
            .withColumn("forecast_qty",
                        F.col("base_qty") * F.pow(1 + F.col("delta"), F.col("elasticity"))))


DEMAND_FEATURES = ("net_price", "discount", "month")


def _featured(sales: DataFrame) -> DataFrame:
    return sales.withColumn("month", F.month("sold_at").cast("double"))


def fit_demand(sales: DataFrame):
    """Linear model of quantity on paid price, discount and month of year.

    Solved by normal equations: one pass over the data, a 4 x 4 system on the driver.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    features = VectorAssembler(inputCols=list(DEMAND_FEATURES), outputCol="features",
                               handleInvalid="skip")
    line = LinearRegression(featuresCol="features", labelCol="qty", solver="normal")
    return Pipeline(stages=[features, line]).fit(_featured(sales).select(*DEMAND_FEATURES, "qty"))


def predict_demand(model, sales: DataFrame) -> DataFrame:
    """Sales with ``prediction`` from ``fit_demand``."""
    return model.transform(_featured(sales)).drop("features", "month")


def demand_fit_by_category(sales: DataFrame, model) -> DataFrame:
    """How the demand model fits: n, mean quantity, mean prediction, RMSE per category."""
    error = F.col("prediction") - F.col("qty")
    return predict_demand(model, sales).groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.avg("qty").alias("avg_qty"),
        F.avg("prediction").alias("avg_prediction"),
        F.sqrt(F.avg(error * error)).alias("rmse"))
