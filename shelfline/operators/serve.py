"""Result sets behind the price, promotion and product interfaces and reports."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numbers import money_sum, ratio, share_of
from shelfline.operators.product import price_band
from shelfline.session import kept


def price_kpis(recommendations: DataFrame, categories: DataFrame, category: str | None = None,
               min_gap: float | None = None, limit: int | None = None, retailer: int | None = None,
               current: DataFrame | None = None) -> DataFrame:
    """Price gaps with category means and recommendations, largest gap first.

    ``recommendations`` comes from ``optimize.recommend``, ``categories`` from
    ``price.category_prices``. With ``retailer`` only products that it has are listed, with its price in ``current``
    (``price.current_price``) and the own price's gap to it.
    """
    if category is not None:
        recommendations = recommendations.filter(F.col("category") == category)
    if min_gap is not None:
        recommendations = recommendations.filter(F.abs("gap") >= min_gap)
    means = kept(categories.filter("level = 1").select(
        "category", F.col("avg_price").alias("category_avg")))
    more = []
    if retailer is not None:
        theirs = current.filter(F.col("retailer_id") == retailer).select("product_id", F.col("price").alias("retailer_price"))
        recommendations = recommendations.join(theirs, "product_id")
        gap = ratio(F.col("own_price") - F.col("retailer_price"), F.col("retailer_price"))
        more = ["retailer_price", gap.alias("retailer_gap")]
    out = (recommendations.join(means, "category", "left")
           .select("product_id", "category", "own_price", "competitor_avg", "gap", "category_avg",
                   "action", "suggested_price", *more)
           .orderBy(F.col("gap").desc(), "product_id"))
    return out.limit(limit) if limit is not None else out


def promotion_kpis(performance: DataFrame, uplift: DataFrame, roi: DataFrame,
                   category: str | None = None) -> DataFrame:
    """Each promotion's results with uplift and ROI of its category."""
    if category is not None:
        performance = performance.filter(F.col("category") == category)
    return (performance
            .join(kept(uplift.select("category", "uplift", "n_base")), "category", "left")
            .join(kept(roi.select("category", "roi")), "category", "left"))


def product_kpis(performance: DataFrame, scored: DataFrame, best: DataFrame,
                 category: str | None = None, edges: Sequence[float] | None = None,
                 shares: DataFrame | None = None) -> DataFrame:
    """Each product's contribution, scores and place among the best sellers.

    With ``edges`` also its price band, and with ``shares`` (``product.best_seller_share`` over the same edges) the share of
    best sellers among the products of that band.
    """
    if category is not None:
        performance = performance.filter(F.col("category") == category)
    if edges is not None:
        performance = price_band(performance, "paid_price", edges)
        if shares is not None:
            bands = kept(shares.select(F.col("band").alias("_band"), F.col("share").alias("band_best_seller_share")))
            performance = performance.join(bands, F.col("band").eqNullSafe(F.col("_band")), "left").drop("_band")
    return (performance
            .join(scored.select("product_id", "r_score", "f_score", "m_score"),
                  "product_id", "left")
            .join(best.select("product_id", F.col("place").alias("best_seller_place")),
                  "product_id", "left"))


def executive_summary(sales: DataFrame) -> DataFrame:
    """Long table (kpi, period, value) by month and year.

    Sales are read once into monthly sums; years are added up from months.
    """
    one = F.lit(1)
    months = sales.groupBy(F.date_format("sold_at", "yyyy-MM").alias("month")).agg(
        F.count(one).alias("lines"), F.sum("qty").alias("units"),
        money_sum(F.col("amount")).alias("amount"), F.sum("net_price").alias("paid"),
        F.count("net_price").alias("priced"), F.count_if(F.col("is_promo")).alias("promoted"))
    spans = months.withColumn("period", F.explode(F.array(
        F.col("month"), F.substring("month", 1, 4))))
    wide = spans.groupBy("period").agg(
        F.sum("lines").cast("double").alias("lines"), F.sum("units").alias("units"),
        F.sum("amount").alias("amount"),
        ratio(F.sum("paid"), F.sum("priced")).alias("average_paid_price"),
        ratio(F.sum("promoted"), F.sum("lines")).alias("promo_share"))
    kpis = ["lines", "units", "amount", "average_paid_price", "promo_share"]
    return wide.unpivot(["period"], kpis, "kpi", "value").select("kpi", "period", "value")


# What a custom report may group by; _measures lists what it may show.
DIMENSIONS = ("category", "brand", "retailer_id", "is_promo", "month", "year")


def _measures() -> dict[str, Column]:
    return {"lines": F.count(F.lit(1)), "units": F.sum("qty"), "amount": money_sum(F.col("amount")),
            "avg_price": F.avg("net_price"), "avg_discount": F.avg("discount"),
            "orders": F.count_distinct("order_id"), "promo_share": share_of(F.col("is_promo")),
            "price_per_unit": ratio(money_sum(F.col("amount")), F.sum("qty"))}


def custom_report(sales: DataFrame, dims: Sequence[str], measures: Sequence[str],
                  filters: dict | None = None, since: str | None = None,
                  until: str | None = None) -> DataFrame:
    """Chosen measures by chosen dimensions over [since, until).

    Only listed dimensions and measures are accepted. ``filters`` maps a
    dimension to the value or list of values kept.
    """
    known = _measures()
    filters = filters or {}
    wrong = ([d for d in [*dims, *filters] if d not in DIMENSIONS]
             + [m for m in measures if m not in known])
    if wrong:
        raise ValueError(f"not available in reports: {', '.join(wrong)}")
    bounds = [F.col("sold_at") >= F.lit(since).cast("timestamp")] if since else []
    bounds += [F.col("sold_at") < F.lit(until).cast("timestamp")] if until else []
    if bounds:
        sales = sales.filter(reduce(lambda a, b: a & b, bounds))
    dated = (sales.withColumn("month", F.date_format("sold_at", "yyyy-MM"))
             .withColumn("year", F.date_format("sold_at", "yyyy")))
    for column, wanted in filters.items():
        wanted = wanted if isinstance(wanted, (list, tuple)) else [wanted]
        dated = dated.filter(F.col(column).isin(*wanted))
    return dated.groupBy(*dims).agg(*[known[m].alias(m) for m in measures])


def source_files(df: DataFrame) -> list[str]:
    """The files a frame comes from, also those that Spark does not read again as it holds their rows."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    read = [leaf.relation() for leaf in map(leaves.apply, range(leaves.size()))
            if leaf.getClass().getSimpleName() == "LogicalRelation"]
    held = [r.inputFiles() for r in read if r.getClass().getSimpleName() == "HadoopFsRelation"]
    return sorted({*df.inputFiles(), *(f for files in held for f in files)})


def source_mark(df: DataFrame) -> str:
    """A mark of the files a frame reads: their paths, sizes and times of change.

    Folders are listed once each, by the driver, and no data is read.
    """
    files = source_files(df)
    if not files:
        raise ValueError("only results of files can be kept by their sources")
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    found = []
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        found += [f"{s.getPath()} {s.getLen()} {s.getModificationTime()}"
                  for s in at.getFileSystem(conf).listStatus(at) if s.isFile()]
    return hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()


def cached_result(df: DataFrame, root: str, name: str) -> DataFrame:
    """A result set kept as a table below ``root`` under its plan and the state of its sources.

    While both stay as they are it is read back, also by other sessions; once a source file has changed the result
    is worked out anew and the old one goes. Results of the current time or of chance are kept like any other.
    """
    spark = df.sparkSession
    plan = re.sub(r"#\d+L?|\[plan_id=\d+\]", "", df._jdf.queryExecution().analyzed().canonicalized().toString())
    key = hashlib.md5(f"{plan}\n{df.semanticHash()}\n{df.schema.json()}\n{source_mark(df)}".encode()).hexdigest()
    jvm, path = spark._jvm, f"{root}/{name}/{key}"
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        df.write.mode("overwrite").parquet(path)
        for other in files.listStatus(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")):
            if other.getPath().getName() != key:
                files.delete(other.getPath(), True)
    return spark.read.schema(df.schema).parquet(path)


def cached(df: DataFrame, name: str) -> DataFrame:
    """Keep a result set for repeated reads under a view name; spills to disk."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.createOrReplaceTempView(name)
    return df
