"""The layer jobs from sources to gold, run twice."""

from pyspark.sql import functions as F

from shelfline.operators import price, quality
from shelfline.operators.audit import audit_log
from shelfline.plans import fixtures as fx, jobs
from shelfline.schemas import PRICE_QUOTE, SALE
from shelfline.session import scratch
from shelfline.sinks.layers import write_bronze
from shelfline.sources.tables import read_layer

SF_DIR = "/root/testdata/sf0.001"


def test_layers_agree_and_reruns_change_nothing(spark):
    root, seen = scratch(spark), []
    for run_id in ("monday", "monday", "tuesday"):
        jobs.load_bronze(spark, SF_DIR, root, run_id)
        counts = jobs.build_silver(spark, root, run_id)
        jobs.build_gold(spark, root, "2001-12-31")
        seen.append({name: read_layer(spark, root, "gold", name).agg(
            F.count(F.lit(1)), F.sum(F.xxhash64(column).cast("decimal(38,0)"))).first()[:]
            for name, column in (("price_analytics/price_gap", "gap"),
                                 ("price_analytics/price_history", "price"),
                                 ("promotion_analytics/performance", "revenue"),
                                 ("product_analytics/rfm", "monetary"))})
        assert counts["sales"] == {"rows_in": 6000, "rows_out": 6000, "rows_rejected": 0}
    assert seen[0] == seen[1] == seen[2]

    silver, source = jobs.silver_sales(spark, root), fx.sales(spark, SF_DIR)
    assert quality.reconcile(source, silver, ["order_id", "line_no"], ["qty", "amount"]).count() == 0
    gap = price.price_gap(price.current_price(fx.observations(spark, SF_DIR)))
    gold = read_layer(spark, root, "gold", "price_analytics/price_gap")
    assert gold.exceptAll(gap.select(*gold.columns)).count() == 0
    log = audit_log(spark, f"{root}/audit")
    assert log.filter("status = 'done' AND seconds > 0").count() == 6


def test_silver_normalises_fills_and_takes_the_last_delivery(spark):
    root = scratch(spark)
    quote = [(1, 2, "2020-01-01 00:00:00", 10.0, 1, 1, "USD", False), (1, 2, "2020-01-02 00:00:00", 5.0, 1, 2, "VND", True),
             (1, 2, "2020-01-03 00:00:00", 5.0, 1, 3, "XXX", True), (None, 2, "2020-01-03 00:00:00", 5.0, 1, 4, "VND", True)]
    sale = [(1, 1, 1, 0, "2020-01-01 00:00:00", 2.0, 8.0, None, 4.0, False, "a", "x"),
            (2, 1, 1, 0, "2020-01-02 00:00:00", 4.0, 8.0, 0.1, 4.0, True, "a", "x"),
            (3, 1, 1, 0, "2020-01-03 00:00:00", None, 9.0, 0.1, 4.0, True, "a", "x")]
    cast = lambda rows, schema, at: spark.createDataFrame(
        rows, ", ".join(f"{f.name} {'string' if f.name == at else f.dataType.simpleString()}" for f in schema)).withColumn(
        at, F.col(at).cast("timestamp"))
    write_bronze(cast(quote, PRICE_QUOTE, "observed_at"), root, "competitors", "a", "feed")
    write_bronze(cast(sale, SALE, "sold_at"), root, "internal", "a", "sales")
    later = [(1, 2, "2020-01-02 00:00:00", 6.0, 1, 2, "VND", True)]
    write_bronze(cast(later, PRICE_QUOTE, "observed_at"), root, "competitors", "b", "feed")
    counts = jobs.build_silver(spark, root, "b", {"USD": 20.0}, 0.1)
    assert counts["prices"] == {"rows_in": 7, "rows_out": 5, "rows_rejected": 2}
    prices = jobs.silver_prices(spark, root)
    assert sorted((r["retailer_id"], r["line_no"], round(r["price"], 9)) for r in prices.collect()) == [
        (0, 1, 2.0), (0, 1, 3.0), (0, 1, 4.0), (2, 1, 220.0), (2, 2, 6.0)]
    sold = sorted((r["order_id"], r["qty"], r["discount"]) for r in jobs.silver_sales(spark, root).collect())
    assert sold == [(1, 2.0, 0.0), (2, 4.0, 0.1), (3, 3.0, 0.1)]
    bad = spark.read.parquet(f"{root}/rejected/normalized/b").collect()
    assert sorted(r["failed"] for r in bad) == [["price"], ["product"]]


def test_pages_become_quotes(spark):
    html = ("<h1>Hot Anvil</h1><span class=\"price\">12.50 USD</span><h2>Red geer</h2><b class=\"price\">3,00 EUR</b>"
            "<h2>Unknown thing</h2><i class=\"price\">9 USD</i><h2>Hot xanvil</h2>")
    pages = spark.createDataFrame([(7, "https://shop.example/a", html), (8, "https://other.example/", html)],
                                  "page_id long, url string, html string")
    products = spark.createDataFrame([(1, "red gear"), (2, "anvil hot")], "product_id long, name string")
    out = jobs.page_quotes(pages, products, {"shop.example": 3}, "2024-05-01")
    assert sorted((r["product_id"], r["retailer_id"], r["price"], r["currency"], r["order_id"]) for r in out.collect()) == [
        (1, 3, 3.0, "EUR", 7), (2, 3, 12.5, "USD", 7)]
    root = scratch(spark)
    write_bronze(out, root, "competitors", "pages-1", "pages")
    assert read_layer(spark, root, "bronze", "competitors").count() == 2 and set(PRICE_QUOTE.names) <= set(
        read_layer(spark, root, "bronze", "competitors").columns)


def test_interfaces_from_gold(spark):
    root = scratch(spark)
    jobs.load_bronze(spark, SF_DIR, root, "r")
    jobs.build_silver(spark, root, "r")
    jobs.build_gold(spark, root, "2001-12-31")
    whole = jobs.price_kpis(spark, root)
    assert whole.count() == jobs.gold(spark, root, "price_analytics", "recommendations").count() > 100
    assert jobs.price_kpis(spark, root, retailer=2, limit=5).filter("retailer_price > 0").count() == 5
    assert jobs.promotion_kpis(spark, root).filter("uplift IS NOT NULL").count() > 0
    for name in ("trend", "optimum", "what_if", "category_prices"):
        assert jobs.gold(spark, root, "price_analytics", name).count() > 0
    files = whole.inputFiles()
    assert files and all("/gold/" in f or "/gold/" not in f and root not in f for f in files)


def test_repeated_runs_are_not_read_and_the_market_is_that_of_the_fixture(spark, monkeypatch):
    root = scratch(spark)
    jobs.load_bronze(spark, SF_DIR, root, "01")
    jobs.deliver_again(spark, root, "01", "2")
    landed = read_layer(spark, root, "bronze", "market_trends")
    assert landed.groupBy("_run_id").count().count() == 2
    market = {(r["category"], r["month"]): r["market_price"] for r in fx.market(spark, SF_DIR).collect()}
    again = {(r["category"], r["month"]): r["market_price"] for r in landed.filter("_run_id = 2").collect()}
    assert market.keys() == again.keys() and all(abs(market[k] - again[k]) < 1e-9 * market[k] for k in market)
    read = []
    dedup = quality.dedup
    monkeypatch.setattr(quality, "dedup", lambda df, *a: read.append(
        [r["_run_id"] for r in df.select("_run_id").distinct().collect()]) or dedup(df, *a))
    sold = jobs._landed(spark, root, "internal", SALE, "sold_at", "amount")
    assert read == [["2"]] and sold.count() == 6000
    write_bronze(fx.sales(spark, SF_DIR).limit(10).withColumn("amount", F.lit(1.0)), root, "internal", "3", "sales")
    late = jobs._landed(spark, root, "internal", SALE, "sold_at", "amount")
    assert sorted(read[1]) == ["2", "3"] and late.count() == 6000 and late.filter("amount = 1.0").count() == 10
