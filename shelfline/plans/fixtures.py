"""Maps the TPC-H-like tables to the canonical retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.functions.numbers import tidy
from shelfline.operators.normalize import standardize_market
from shelfline.sources.topics import price_events

EVENTS = "events.parquet"
OWN = 0
COMPETITORS = (1, 2, 3, 4)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        (F.col("l_suppkey") % 5).alias("retailer_id"),
        F.col("l_shipdate").cast("timestamp").alias("observed_at"),
        (F.col("l_extendedprice") / F.nullif("l_quantity", F.lit(0.0))).alias("price"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("list_price"), F.col("p_size").alias("pack_size"),
    )


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales without product attributes, for operators that need none."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), (F.col("l_suppkey") % 5).alias("retailer_id"),
        F.col("l_shipdate").cast("timestamp").alias("sold_at"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("amount"),
        F.col("l_discount").alias("discount"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sale_lines(spark, sf_dir).join(products(spark, sf_dir), "product_id").select(
        "order_id", "line_no", "product_id", "retailer_id", "sold_at", "qty", "amount",
        "discount", (F.col("list_price") * (1 - F.col("discount"))).alias("net_price"),
        (F.col("discount") > 0).alias("is_promo"), "category", "brand",
    )


def promotions(sales: DataFrame) -> DataFrame:
    """One promotion per category and month with discounted sales."""
    month = F.date_trunc("month", F.col("sold_at"))
    return (sales.filter("is_promo").groupBy("category", month.alias("start_at"))
            .agg(tidy(F.avg("discount")).alias("depth"))
            .select(F.concat_ws("-", "category", F.date_format("start_at", "yyyyMM"))
                    .alias("promo_id"), "category", "depth", "start_at",
                    (F.col("start_at") + F.expr("INTERVAL 1 MONTH")).alias("end_at")))


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = (observations(spark, sf_dir).filter(F.col("retailer_id").isin(*COMPETITORS))
              .join(products(spark, sf_dir).select("product_id", "category"), "product_id"))
    return standardize_market(quotes, "category", "observed_at", "price")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_events(load(spark, sf_dir, "events"))


def retailers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The own chain and its competitors, one row each."""
    ids = load(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") % 5).alias("retailer_id")).distinct()
    return ids.select("retailer_id", F.when(F.col("retailer_id") == OWN, "OWN").otherwise(
        F.concat(F.lit("COMP_"), F.col("retailer_id").cast("string"))).alias("retailer"),
        (F.col("retailer_id") == OWN).alias("is_own"))
