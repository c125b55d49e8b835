import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.functions import merging
from shelfline.operators import optimize, price, product, promo, rfm, serve
from shelfline.schemas import PRICE_OBSERVATION, PROMOTION, SALE

DAY = dt.datetime(2024, 1, 1)


def at(days):
    return DAY + dt.timedelta(days=days)


def observed(spark, rows):
    """Rows of (product, retailer, day, price)."""
    return spark.createDataFrame([(p, r, at(d), float(x), i, 1)
                                  for i, (p, r, d, x) in enumerate(rows)], PRICE_OBSERVATION)


def sold(spark, rows):
    """Rows of (product, day, qty, list price, discount, category)."""
    return spark.createDataFrame(
        [(i, 1, p, 0, at(d), float(q), q * x, disc, x * (1 - disc), disc > 0, c, "b")
         for i, (p, d, q, x, disc, c) in enumerate(rows)], SALE)


def known_slope(spark):
    """qty = 100 x price^-2 at prices 1 to 8, all in one category."""
    return sold(spark, [(p, 0, 100.0 * p**-2, float(p), 0.0, "c") for p in range(1, 9)])


def test_current_price_and_gap(spark):
    obs = observed(spark, [(1, 0, 0, 8), (1, 0, 1, 12), (1, 1, 0, 10), (1, 2, 0, 6), (2, 0, 0, 5),
                           (3, 1, 0, 5)])
    current = price.current_price(obs)
    assert current.count() == 5
    gap = price.price_gap(current).collect()
    assert [(r["product_id"], r["own_price"], r["n_competitors"], r["gap"]) for r in gap] == [
        (1, 12.0, 2, 0.5)]


def test_gap_with_free_competitors_is_null(spark):
    assert price.price_gap(observed(spark, [(1, 0, 0, 8), (1, 1, 0, 0)])).first()["gap"] is None


def test_history_and_as_of(spark):
    history = price.price_history(observed(spark, [(1, 0, 1, 10), (1, 0, 2, 10), (1, 0, 3, 12)]))
    found = sorted((r["valid_from"], r["valid_to"], r["price"]) for r in history.collect())
    assert found == [(at(1), at(3), 10.0), (at(3), None, 12.0)]
    for day, want in ((0, []), (1, [10.0]), (2, [10.0]), (3, [12.0]), (9, [12.0])):
        assert [r["price"] for r in price.price_as_of(history, at(day)).collect()] == want


def test_history_merges_within_an_instant(spark):
    history = price.price_history(observed(
        spark, [(1, 0, 1, 10), (1, 0, 2, 99), (1, 0, 2, 10), (1, 0, 3, 10)]))
    assert [(r["price"], r["valid_to"]) for r in history.collect()] == [(10.0, None)]


def test_asof_price(spark):
    obs = observed(spark, [(1, 1, 2, 10), (1, 2, 4, 11), (1, 0, 3, 99)])
    sales = sold(spark, [(1, 1, 1, 5.0, 0.0, "c"), (1, 2, 1, 5.0, 0.0, "c"),
                         (1, 3, 1, 5.0, 0.0, "c"), (1, 5, 1, 5.0, 0.0, "c")])
    for group_rows in (1, 1000):
        found = price.asof_price(sales, obs, group_rows=group_rows).orderBy("sold_at").collect()
        assert [r["competitor_price"] for r in found] == [None, 10.0, 10.0, 11.0]


def test_moves_and_threshold(spark):
    moves = price.price_moves(observed(spark, [(1, 0, 1, 100), (1, 0, 2, 105), (1, 0, 3, 120)]))
    assert sorted(r["change"] for r in moves.collect()) == [5.0, 15.0]
    assert [r["price"] for r in price.significant_moves(moves).collect()] == [120.0]


def test_trend_frames_differ_on_gaps(spark):
    obs = observed(spark, [(1, 0, 0, 10), (1, 0, 1, 20), (1, 0, 9, 60)])
    last = {f: price.price_trend(obs, ["product_id"], "day", 2, f).orderBy("period").collect()[-1]
            for f in ("rows", "range")}
    assert (last["rows"]["moving_avg"], last["range"]["moving_avg"]) == (40.0, 60.0)
    assert last["rows"]["change"] == 40.0 and last["rows"]["pct_change"] == 2.0
    with pytest.raises(ValueError):
        price.price_trend(obs, ["product_id"], "minute")


def test_elasticity_and_demand(spark):
    sales = known_slope(spark)
    row = price.elasticity(sales).first()
    assert row["elasticity"] == pytest.approx(-2) and row["r2"] == pytest.approx(1)
    out = product.demand_forecast(sales, [0.1]).first()
    assert out["forecast_qty"] == pytest.approx(out["base_qty"] * 1.1**-2)
    assert price.elasticity(sold(spark, [(1, 0, 0, 5.0, 0.0, "c")])).count() == 0


def test_optimum_is_twice_the_cost(spark):
    base = spark.createDataFrame([("c", 5.0, 10.0, -2.0), ("d", 5.0, 10.0, None)],
                                 "category string, base_price double, base_units double, "
                                 "elasticity double")
    best = {r["category"]: r for r in optimize.optimal_price(base, 0.4, 40, cost_ratio=0.6).collect()}
    assert best["c"]["best_price"] == pytest.approx(6.0)
    assert best["d"]["best_delta"] == 0.0 or best["d"]["best_margin"] is None


def test_optimum_tie_takes_the_smallest_change(spark):
    base = spark.createDataFrame([("c", 5.0, 0.0, -2.0)], "category string, base_price double, "
                                 "base_units double, elasticity double")
    assert optimize.optimal_price(base).first()["best_delta"] == 0.0


def test_impact_and_scenarios(spark):
    base = spark.createDataFrame([("c", 10.0, 100.0, -1.0)], "category string, base_price double, "
                                 "base_units double, elasticity double")
    row = optimize.adjustment_impact(base, 0.25, 0.6).first()
    assert row["revenue_change"] == pytest.approx(0) and row["units"] == pytest.approx(80)
    assert row["margin_change"] == pytest.approx((12.5 - 6) * 80 - 400)
    table = optimize.what_if(base, {"keep": 0.0, "up": 0.25}, 0.6)
    assert {r["scenario"]: r["margin_change"] for r in table.collect()} == {
        "keep": pytest.approx(0), "up": pytest.approx(120)}


def test_recommend_votes(spark):
    gap = spark.createDataFrame([(1, 10.0, 8.0, 0.25), (2, 8.0, 10.0, -0.2), (3, 8.0, 10.0, -0.2)],
                                "product_id int, own_price double, competitor_avg double, gap double")
    listed = spark.createDataFrame([(1, "low"), (2, "up"), (3, "low")],
                                   "product_id int, category string")
    optimal = spark.createDataFrame([("low", -0.1), ("up", 0.2)], "category string, best_delta double")
    market = spark.createDataFrame([("low", 0.0), ("up", 0.0)], "category string, market_gap double")
    found = {r["product_id"]: (r["action"], r["suggested_price"])
             for r in optimize.recommend(gap, listed, optimal, market).collect()}
    assert found == {1: ("lower", 9.0), 2: ("raise", pytest.approx(9.6)), 3: ("hold", 8.0)}


def test_backtest_on_a_perfect_curve(spark):
    rows = [(p, d, 100.0 * p**-2, float(p), 0.0, "c") for d in (0, 50) for p in (2, 2, 2)]
    rows += [(p, 0, 100.0 * p**-2, float(p), 0.0, "c") for p in (1, 3)]
    row = optimize.backtest(sold(spark, rows), str(at(40))).first()
    assert row["n"] == 3 and row["mae"] == pytest.approx(abs(row["bias"]))


def test_uplift_and_roi(spark):
    sales = sold(spark, [(1, 0, 10, 10.0, 0.0, "c"), (1, 1, 15, 10.0, 0.2, "c")])
    assert promo.promo_uplift(sales).first()["uplift"] == pytest.approx(0.5)
    row = promo.promo_roi(sales, 0.5).first()
    assert row["discount_cost"] == pytest.approx(15 * 10 * 0.2)
    assert row["incremental_margin"] == pytest.approx(5 * (8 - 5))
    assert row["roi"] == pytest.approx((15 - 30) / 30)
    none = promo.promo_roi(sold(spark, [(1, 0, 10, 10.0, 0.0, "c")])).first()
    assert none["roi"] is None


def test_attribute_overlapping_promotions(spark):
    promos = spark.createDataFrame([
        ("long", "c", 0.1, at(0), at(70)), ("short", "c", 0.1, at(20), at(40)),
        ("other", "d", 0.1, at(0), at(70)), ("empty", "c", 0.1, at(5), at(5))], PROMOTION)
    sales = sold(spark, [(1, 0, 1, 1.0, 0.1, "c"), (1, 20, 1, 1.0, 0.1, "c"),
                         (1, 40, 1, 1.0, 0.1, "c"), (1, 70, 1, 1.0, 0.1, "c"),
                         (1, 30, 1, 1.0, 0.0, "c")])
    found = sorted((r["order_id"], r["promo_id"]) for r in promo.attribute(sales, promos).collect())
    assert found == [(0, "long"), (1, "long"), (1, "short"), (2, "long")]
    per = {r["promo_id"]: r["orders"] for r in promo.promo_performance(sales, promos).collect()}
    assert per == {"long": 3, "short": 1}


def test_cube_total_is_the_grand_total(spark):
    sales = sold(spark, [(1, 0, 2, 3.0, 0.1, "c"), (2, 0, 5, 7.0, 0.0, "d"), (2, 0, 1, 1.5, 0.1, "d")])
    cube = promo.promo_cube(sales)
    total = cube.filter("level = 3").first()
    assert total["revenue"] == cube.filter("level = 0").agg(F.sum("revenue")).first()[0]
    assert total["n"] == 3


def test_shares_sum_to_one(spark):
    sales = sold(spark, [(i % 7, 0, i, 1.0 + i, 0.0, "c") for i in range(1, 60)])
    table = product.product_performance(sales)
    assert table.agg(F.sum("share")).first()[0] == pytest.approx(1)
    assert table.agg(F.max("cumulative_share")).first()[0] == pytest.approx(1)
    bands = product.best_seller_share(sales, 3, [20.0, 30.0])
    assert bands.agg(F.sum("best_sellers"), F.sum("products")).first()[:] == (3, 7)


def test_bands(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,), (None,)], "p double")
    assert [r["band"] for r in product.price_band(df, "p", [2.0, 4.0]).collect()] == [0, 1, 2, None]
    assert product.quantile_edges(df, "p", 2) == [2.0]


def test_fit_demand_on_a_plane(spark):
    rows = [(p, d, 50 - 2 * p * (1 - s) + 10 * s, float(p), s, "c")
            for p in range(1, 6) for d in (0, 40, 80) for s in (0.0, 0.1, 0.2)]
    sales = sold(spark, rows)
    model = product.fit_demand(sales)
    assert list(model.stages[-1].coefficients) == pytest.approx([-2, 10, 0], abs=1e-6)
    assert product.demand_fit_by_category(sales, model).first()["rmse"] == pytest.approx(0, abs=1e-6)


def test_rfm(spark):
    sales = sold(spark, [(p, p, 1, float(p), 0.0, "c") for p in range(1, 11)])
    scored = rfm.rfm_score(rfm.rfm(sales, "2024-02-01")).orderBy("product_id").collect()
    assert [r["r_score"] for r in scored] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert [r["f_score"] for r in scored] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    later = rfm.rfm(sales, "2024-01-05")
    assert later.count() == 4


def test_reports(spark):
    sales = sold(spark, [(1, 0, 2, 3.0, 0.1, "c"), (2, 40, 5, 7.0, 0.0, "d")])
    out = serve.custom_report(sales, ["month"], ["units", "lines"], {"category": "c"})
    assert [tuple(r) for r in out.collect()] == [("2024-01", 2.0, 1)]
    with pytest.raises(ValueError, match="drop table"):
        serve.custom_report(sales, ["drop table"], ["units"])
    summary = serve.executive_summary(sales).filter("kpi = 'units'").collect()
    assert {r["period"]: r["value"] for r in summary} == {
        "2024-01": 2.0, "2024-02": 5.0, "2024": 7.0}
    kept = serve.cached(out, "report_view")
    assert spark.table("report_view").count() == 1 and kept.is_cached
    kept.unpersist()


def test_sums_below_a_join_equal_sums_above_it(spark):
    rows = spark.createDataFrame([(i % 7 or None, float(i) if i % 5 else None, i % 3) for i in range(200)],
                                 "product_id int, price double, retailer_id int")
    dimension = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (3, "c"), (4, None), (9, "d")],
                                      "product_id int, category string")
    measures = {"n": merging.counted("price"), "total": merging.summed("price"), "mean": merging.averaged("price"),
                "low": merging.least("price"), "high": merging.greatest("price")}
    odd = (F.col("retailer_id") % 2).alias("odd")
    out = merging.summed_below(rows, ["product_id"], dimension, ["category"], measures, {"odd": odd})
    want = rows.join(dimension, "product_id").groupBy("category", odd).agg(
        F.count("price"), F.sum("price"), F.avg("price"), F.min("price"), F.max("price"))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join"):]
    assert joined.index("Aggregate") < joined.index("LogicalRDD")


def test_trend_meets_products_after_its_sums(spark, tmp_path):
    obs = spark.createDataFrame([(i % 5, 0, dt.datetime(2020, 1 + i % 9, 1 + i % 20), float(i)) for i in range(300)],
                                "product_id int, retailer_id int, observed_at timestamp, price double")
    listed = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(4)], "product_id int, category string")
    below = price.price_trend(obs, ["category"], dimension=listed)
    above = price.price_trend(obs.join(listed, "product_id"), ["category"])
    key = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.na.fill(-1).collect())
    assert key(below) == key(above)
    market = price.price_trend(obs, ["product_id"]).limit(0).select(
        F.lit("a").alias("category"), F.col("period").alias("month"), F.col("avg_price").alias("market_price"))
    assert key(price.vs_market(obs, market, dimension=listed).drop("market_gap", "market_price")) == key(
        price.vs_market(obs.join(listed, "product_id"), market).drop("market_gap", "market_price"))


def test_cached_result_follows_its_sources(spark, tmp_path):
    source, root = str(tmp_path / "facts"), str(tmp_path / "cache")
    spark.range(10).write.parquet(source)
    asked = lambda session: serve.cached_result(session.read.parquet(source).agg(F.sum("id").alias("s")), root, "sum")
    first = asked(spark)
    assert first.first()["s"] == 45 and not any(f.startswith("file:" + source) for f in first.inputFiles())
    entry = [p.name for p in (tmp_path / "cache" / "sum").iterdir()]
    for session in (spark, spark.newSession()):
        assert asked(session).first()["s"] == 45
    assert [p.name for p in (tmp_path / "cache" / "sum").iterdir()] == entry and len(entry) == 1
    spark.range(1).select(F.lit(100).cast("long").alias("id")).write.mode("append").parquet(source)
    assert asked(spark).first()["s"] == 145
    assert len(list((tmp_path / "cache" / "sum").iterdir())) == 1
    other = serve.cached_result(spark.read.parquet(source).agg(F.max("id").alias("s")), root, "most")
    assert other.first()["s"] == 100 and asked(spark).first()["s"] == 145
    with pytest.raises(ValueError, match="files"):
        serve.cached_result(spark.createDataFrame([(1,)], "v int"), root, "none")


def test_interfaces_by_retailer_and_band(spark):
    rec = spark.createDataFrame([(1, "a", 12.0, 10.0, 0.2, "lower", 11.0), (2, "a", 9.0, 10.0, -0.1, "hold", 9.0)],
                                "product_id int, category string, own_price double, competitor_avg double, gap double, "
                                "action string, suggested_price double")
    means = spark.createDataFrame([("a", 10.5, 1)], "category string, avg_price double, level int")
    current = spark.createDataFrame([(1, 2, 8.0), (1, 3, 20.0), (2, 3, 9.0)], "product_id int, retailer_id int, price double")
    out = serve.price_kpis(rec, means, retailer=2, current=current).collect()
    assert [(r["product_id"], r["retailer_price"], r["retailer_gap"]) for r in out] == [(1, 8.0, 0.5)]
    performance = spark.createDataFrame([(1, 5.0), (2, 50.0), (3, None)], "product_id int, paid_price double")
    scored = spark.createDataFrame([], "product_id int, r_score int, f_score int, m_score int")
    best = spark.createDataFrame([(2, 1)], "product_id int, place int")
    shares = spark.createDataFrame([(0, 0.0), (1, 1.0), (None, 0.5)], "band int, share double")
    found = serve.product_kpis(performance, scored, best, edges=[10.0], shares=shares).orderBy("product_id").collect()
    assert [(r["band"], r["band_best_seller_share"], r["best_seller_place"]) for r in found] == [
        (0, 0.0, None), (1, 1.0, 1), (None, 0.5, None)]


def test_cached_result_of_rows_that_spark_holds(spark, tmp_path):
    source, root = str(tmp_path / "held facts"), str(tmp_path / "cache")
    spark.range(10).write.parquet(source)
    asked = lambda: spark.read.parquet(source).agg(F.sum("id").alias("s"))
    plain = serve.source_mark(asked())
    held = serve.cached(asked(), "held_view")
    try:
        assert held.first()["s"] == 45 and not asked().inputFiles()
        assert serve.source_mark(asked()) == plain
        assert serve.cached_result(asked(), root, "sum").first()["s"] == 45
    finally:
        held.unpersist()
        spark.catalog.dropTempView("held_view")
