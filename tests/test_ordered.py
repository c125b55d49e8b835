"""Sliced ordered operations against plain windows, with skewed keys and copies."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window, functions as F

from shelfline.functions.ordered import (
    OrderedGroups, _below, exact_quantiles, number_rows, tile, with_slice,
)
from shelfline.operators import price
from shelfline.schemas import PRICE_OBSERVATION


def skewed(spark, seed, rows=1500):
    """Two thirds of the rows belong to one key, half of those to one day; some prices repeat."""
    pick = random.Random(seed)
    start = dt.datetime(2020, 1, 1)
    data = set()
    while len(data) < rows:
        key = 1 if pick.random() < 0.67 else pick.randint(2, 30)
        day = 100 if pick.random() < 0.5 else pick.randint(0, 300)
        data.add((key, 0, start + dt.timedelta(days=day), float(pick.randint(1, 4)),
                  pick.randint(1, 40), pick.randint(1, 5)))
    return spark.createDataFrame(list(data), PRICE_OBSERVATION).repartition(5)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("forward", [False, True])
def test_shift_of_hot_key_equals_window(spark, seed, forward):
    df = skewed(spark, seed)
    keys, order = ["product_id", "retailer_id"], ["observed_at", "order_id", "line_no", "price"]
    groups = OrderedGroups(df, keys, order, group_rows=50)
    assert groups.hot is not None
    columns = {"near_price": "price", "near_at": "observed_at"}
    plain = OrderedGroups(df, keys, order)
    assert plain.hot is None
    assert same(groups.shift(df, columns, forward), plain.shift(df, columns, forward))


def test_slices_do_not_depend_on_the_time_zone(spark):
    df = skewed(spark, 12)
    groups = OrderedGroups(df, ["product_id"], ["observed_at", "order_id"], group_rows=50)
    on_hot_day = groups.slice(df).filter("product_id = 1").groupBy("observed_at").agg(
        F.count_distinct("_slice").alias("slices"), F.count(F.lit(1)).alias("rows"))
    assert on_hot_day.orderBy(F.desc("rows")).first()["slices"] > 4


def test_slices_of_hot_key_are_small(spark):
    df = skewed(spark, 3, 3000)
    groups = OrderedGroups(df, ["product_id"], ["observed_at", "order_id", "line_no", "price"],
                           group_rows=50)
    sizes = groups.slice(df).filter("product_id = 1").groupBy("_slice").count().agg(
        F.max("count"))
    whole = df.filter("product_id = 1").count()
    assert sizes.first()[0] < whole / 4


def test_slice_rises_along_the_order(spark):
    df = skewed(spark, 4).select("price", "order_id", "line_no")
    for descending in ((), ("price",)):
        cut = with_slice(df, ["price", "order_id"], [[2.0, 3.0], [10, 20]], descending)
        way = F.desc("price") if descending else F.asc("price")
        codes = [r["_slice"] for r in cut.orderBy(way, "order_id").collect()]
        assert codes == sorted(codes)


def test_hot_key_may_be_null(spark):
    df = skewed(spark, 11).withColumn("product_id", F.nullif("product_id", F.lit(1)))
    keys, order = ["product_id", "retailer_id"], ["observed_at", "order_id", "line_no", "price"]
    hot = OrderedGroups(df, keys, order, group_rows=50)
    assert hot.hot is not None
    plain = OrderedGroups(df, keys, order)
    assert same(hot.shift(df, {"near": "price"}), plain.shift(df, {"near": "price"}))


@pytest.mark.parametrize("marks", [[], [5], [1, 3, 3 + 1], list(range(0, 90, 3))])
def test_place_among_edges(spark, marks):
    found = spark.range(-2, 95).select("id", _below(F.col("id"), marks).alias("b"))
    for row in found.collect():
        assert row["b"] == sum(m < row["id"] for m in marks)


def test_history_and_moves_of_hot_key(spark):
    df = skewed(spark, 5)
    assert same(price.price_history(df, group_rows=50), price.price_history(df))
    assert same(price.price_moves(df, group_rows=50), price.price_moves(df))


def test_history_intervals_do_not_overlap(spark):
    history = price.price_history(skewed(spark, 6), group_rows=50)
    after = F.lead("valid_from").over(Window.partitionBy("product_id", "retailer_id")
                                      .orderBy("valid_from"))
    assert history.withColumn("after", after).filter("NOT (valid_to <=> after)").count() == 0


def test_last_known_of_hot_key(spark):
    df = skewed(spark, 7).withColumn("known", F.col("price") >= 3)
    keys, order = ["product_id"], ["observed_at", "order_id", "line_no", "price"]
    hot = OrderedGroups(df, keys, order, group_rows=50)
    assert hot.hot is not None
    columns = {"last_price": "price", "last_order": "order_id"}
    assert same(hot.last_known(df, columns, "known"),
                OrderedGroups(df, keys, order).last_known(df, columns, "known"))


@pytest.mark.parametrize("ascending", [True, False])
def test_number_rows_equals_row_number(spark, ascending):
    df = skewed(spark, 8).withColumn("id", F.monotonically_increasing_id()).select(
        "id", "price", (F.col("price") * 100).cast("decimal(18,2)").alias("money"))
    df = spark.createDataFrame(df.collect(), df.schema)
    way = F.col("price") if ascending else F.col("price").desc()
    along = Window.orderBy(way, "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("*", F.row_number().over(Window.orderBy(way, "id")).cast("bigint").alias("n"),
                      F.sum("money").over(along).alias("so_far"))
    placed = number_rows(df, {"n": ("price", ascending)}, "id", running={"so_far": "money"})
    key = lambda r: (r["id"], r["n"], float(r["so_far"]))
    assert sorted(map(key, placed.collect())) == sorted(map(key, plain.collect()))


def test_number_rows_per_key(spark):
    df = skewed(spark, 9).select("product_id", "price", "order_id", "line_no", "observed_at")
    df = df.withColumn("id", F.xxhash64(*df.columns))
    plain = df.withColumn("n", F.row_number().over(
        Window.partitionBy("product_id").orderBy("price", "id")).cast("bigint"))
    assert same(number_rows(df, {"n": ("price", True)}, "id", ["product_id"]), plain)


@pytest.mark.parametrize("rows", [1, 3, 5, 7, 23])
def test_tile_equals_ntile(spark, rows):
    df = spark.range(1, rows + 1)
    mine = tile(F.col("id"), F.lit(rows), 5)
    assert df.select(mine.alias("a"), F.ntile(5).over(Window.orderBy("id")).alias("b")).filter(
        "a <> b").count() == 0


def test_exact_quantiles(spark):
    df = skewed(spark, 10).withColumn("x", F.col("price") * F.col("order_id"))
    found = exact_quantiles(df, ["product_id"], "x", [0.1, 0.5, 0.9])
    want = df.groupBy("product_id").agg(F.percentile("x", F.array(
        F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("quantiles"))
    pairs = found.join(want.withColumnRenamed("quantiles", "w"), "product_id").collect()
    assert len(pairs) == want.count()
    for row in pairs:
        assert row["quantiles"] == pytest.approx(row["w"])


def test_exact_quantiles_with_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0), ("a", None)],
                               "k string, x double")
    found = {r["k"]: r["quantiles"] for r in exact_quantiles(df, ["k"], "x", [0.5]).collect()}
    assert found == {None: [2.0], "a": [5.0]}
