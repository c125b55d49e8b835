"""Losses the first round's review found, each with the data that showed it."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfline.functions.numbers import tidy
from shelfline.functions.ordered import OrderedGroups, number_rows
from shelfline.operators import optimize, product, promo, quality
from shelfline.plans import fixtures as fx
from shelfline.session import scratch
from shelfline.sinks.layers import upsert, write_silver
from shelfline.sources.tables import read_layer

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("month", ["01", "007", "A1", None])
def test_upsert_keeps_text_partitions_apart(spark, month):
    path, kind = scratch(spark), "m string, k long, v long"
    for value in (1, 2):
        upsert(path, spark.createDataFrame([(month, 7, value), ("12", value, 0)], kind), ["m", "k"], ["v"], ["m"])
    rows = sorted(spark.read.schema(kind).parquet(path).filter("k = 7").select("m", "k", "v").collect())
    assert [tuple(r) for r in rows] == [(month, 7, 2)]


def test_open_ended_promotion_counts(spark):
    at = datetime(2000, 1, 5)
    sales = spark.createDataFrame([("a", datetime(2000, 3, 1), True), ("a", datetime(1999, 3, 1), True)],
                                  "category string, sold_at timestamp, is_promo boolean")
    promos = spark.createDataFrame([("p", "a", 0.1, at, None), ("q", "a", 0.1, at, datetime(2000, 2, 1))],
                                   "promo_id string, category string, depth double, start_at timestamp, end_at timestamp")
    assert [r["promo_id"] for r in promo.attribute(sales, promos).collect()] == ["p"]


def test_a_rebuild_drops_partitions_that_went(spark):
    root, table = scratch(spark), "normalized"
    write_silver(spark.createDataFrame([(1, "a"), (2, "b")], "n long, c string"), root, table, ["c"], whole=True)
    write_silver(spark.createDataFrame([(3, "a")], "n long, c string"), root, table, ["c"], whole=True)
    assert [tuple(r) for r in read_layer(spark, root, "silver", table).collect()] == [(3, "a")]


def test_tidy_of_large_values(spark):
    df = spark.createDataFrame([(1.35e16,), (9.9e14,), (1.00005,), (-2.5,), (None,)], "v double")
    assert [r[0] for r in df.select(tidy(F.col("v"))).collect()] == [1.35e16, 9.9e14, 1.0001, -2.5, None]


def test_number_rows_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v long")
    out = number_rows(df, {"place": ("v", True)}, "v", keys=["k"])
    assert sorted((r["v"], r["place"]) for r in out.collect()) == [(1, 1), (2, 2), (3, 1)]


def test_ordered_groups_refuse_text_orders(spark):
    with pytest.raises(TypeError):
        OrderedGroups(spark.createDataFrame([("a", "x")], "k string, o string"), ["k"], ["o"])


def test_changed_rows_count_copies(spark):
    a = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x")], "n long, t string")
    b = spark.createDataFrame([(1, None), (3, "y")], "n long, t string")
    out = sorted((r["n"], r["t"] or "", r["side"]) for r in quality.changed_rows(a, b).collect())
    assert out == [(1, "", "a"), (1, "", "a"), (2, "x", "a"), (3, "y", "b")]


def test_one_scan_of_the_sales(spark, capsys):
    sales = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").selectExpr(
        "l_partkey AS product_id", "l_returnflag AS category", "l_quantity AS qty", "l_extendedprice AS net_price")
    for df in (optimize.price_base(sales), product.demand_forecast(sales, [0.1])):
        capsys.readouterr()
        df.explain("simple")
        assert capsys.readouterr().out.count("FileScan parquet") == 1
