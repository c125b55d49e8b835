"""Price normalisation, categories, names and product matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfline.functions.numbers import ratio
from shelfline.functions.text import canonical_name, near_keys, parse_pack
from shelfline.session import kept


def normalize_price(df: DataFrame, rates: DataFrame, tax_rate: float = 0.1) -> DataFrame:
    """Add ``norm_price`` (base currency, tax included) and ``unit_price``.

    ``df`` needs price, currency, tax_included and content (amount in the pack);
    ``rates`` holds one row (currency, rate) per currency. A currency without a rate gives null.
    """
    joined = df.join(kept(rates.select("currency", "rate")), "currency", "left")
    taxed = F.col("price") * F.when(F.col("tax_included"), 1.0).otherwise(1.0 + tax_rate)
    return (joined.withColumn("norm_price", taxed * F.col("rate"))
            .withColumn("unit_price", ratio(F.col("norm_price"), F.col("content")))
            .drop("rate"))


def add_pack(df: DataFrame, name: str) -> DataFrame:
    """Add pack_count, unit_size, unit and content read from a product name."""
    return df.withColumn("_pack", parse_pack(F.col(name))).select(*df.columns, "_pack.*")


def price_index(df: DataFrame) -> DataFrame:
    """Add each row's price over the product's mean (``index``) and its z-score."""
    stats = df.groupBy("product_id").agg(
        F.avg("price").alias("_mean"), F.stddev_samp("price").alias("_sd"))
    return (df.join(stats, "product_id")
            .withColumn("index", ratio(F.col("price"), F.col("_mean")))
            .withColumn("z_score", ratio(F.col("price") - F.col("_mean"), F.col("_sd")))
            .drop("_mean", "_sd"))


def categorize(df: DataFrame, rules: Sequence[tuple[str, str]], name: str = "name",
               default: str = "other") -> DataFrame:
    """Add ``rule_category``: the first rule whose pattern is found wins.

    ``rules`` is an ordered list of (pattern, category), a fixed small set.
    """
    text = F.lower(F.col(name))
    label: Column = F.lit(default)
    for pattern, category in reversed(list(rules)):
        label = F.when(text.rlike(pattern), category).otherwise(label)
    return df.withColumn("rule_category", F.when(F.col(name).isNotNull(), label)
                         .otherwise(default))


def match_products(a: DataFrame, b: DataFrame, block: str, max_dist: int = 1) -> DataFrame:
    """Best match in ``b`` for each row of ``a``: product_id, match_id, distance.

    Both sides need product_id, name and the block column. Within a block an equal
    canonical name wins; otherwise the smallest distance up to ``max_dist``,
    then the smallest product_id. Rows of ``a`` without a match have null match_id.

    The distance of two names is the edit distance of their sorted tokens or, if all their tokens but one
    are the same, that of the odd ones, whichever is less: a typo at the start of a token puts it elsewhere in the order.

    Names are made distinct per block first, so many products of one name cost
    no more than one. Close names are then found by equality on their shortened forms, and on all tokens but
    one with the shortened forms of that one,
    which only pairs names within twice the distance, and never compares a block in full.
    """
    named = lambda df: df.withColumn("_name", canonical_name(F.col("name")))
    left = named(a)
    names_a = left.select(block, "_name").distinct()
    names_b = (named(b).groupBy(block, "_name")
               .agg(F.min("product_id").alias("match_id")))
    exact = (names_a.join(names_b, [block, "_name"])
             .select(block, "_name", "match_id", F.lit(0).alias("distance")))
    rest = names_a.join(names_b, [block, "_name"], "left_anti")

    def keyed(df: DataFrame) -> DataFrame:
        """A row per key: what two names must have in common (``_rest``) and what may differ (``_odd``)."""
        tokens = F.split("_name", " ")
        whole = F.array(F.struct(F.lit(None).cast("string").alias("_rest"), F.col("_name").alias("_odd")))
        each = F.transform(tokens, lambda token, i: F.struct(
            F.array_join(F.filter(tokens, lambda _, j: j != i), " ").alias("_rest"), token.alias("_odd")))
        # A name of one token has no other token to go by.
        ways = F.explode(F.when(F.size(tokens) > 1, F.array_distinct(F.concat(whole, each))).otherwise(whole))
        split = df.withColumn("_way", ways).select(*df.columns, "_way.*")
        return split.withColumn("_key", F.explode(F.transform(
            near_keys(F.col("_odd"), max_dist), lambda s: F.xxhash64(F.col("_rest"), s))))

    pairs = (keyed(rest).alias("x").join(keyed(names_b).alias("y"), [block, "_key"])
             .filter(F.col("x._rest").eqNullSafe(F.col("y._rest")))
             .select(block, F.col("x._name").alias("_name"), "match_id",
                     F.levenshtein("x._odd", "y._odd").alias("distance"))
             .filter(F.col("distance") <= max_dist))
    near = (pairs.groupBy(block, "_name")
            .agg(F.min(F.struct("distance", "match_id")).alias("_best"))
            .select(block, "_name", "_best.match_id", "_best.distance"))
    best = exact.unionByName(near)
    return (left.join(best, [block, "_name"], "left")
            .select("product_id", block, "match_id", "distance"))


def standardize_market(df: DataFrame, category: str, at: str, price: str) -> DataFrame:
    """Mean price per category and month: category, month, market_price."""
    return (df.groupBy(F.col(category).alias("category"),
                       F.date_trunc("month", F.col(at)).alias("month"))
            .agg(F.avg(price).alias("market_price")))
