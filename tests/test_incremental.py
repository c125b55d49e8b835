"""Landed streams and gold kept up to date run by run."""

import datetime as dt

from pyspark.sql import functions as F

from shelfline.operators import price
from shelfline.plans import incremental
from shelfline.schemas import PRICE_OBSERVATION
from shelfline.session import scratch
from shelfline.sinks import layers
from shelfline.sources import tables
from shelfline.streaming import changes, landing, windows
from test_streaming import Feed, again, minute


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_late_events_are_landed_and_counted(spark):
    path, feed = scratch(spark), Feed(spark)
    feed.put((0, 0, 1, 10.0), (5, 90, 1, 20.0)).put((10, 91, 1, 21.0), (15, 1, 1, 99.0))
    feed.put((20, 1, 1, 98.0), (25, 200, 1, 1.0)).put((30, 130, 1, 5.0), (35, 210, 1, None))
    want = [(r["n"], r["max_price"]) for r in changes.drained(windows.agg_tumbling(feed.stream())).orderBy("start_at").collect()]
    for fold_every in (2, 2, 64):
        changes.run_available(landing.land(
            feed.stream(), f"{path}/lake", "market_trends", f"{path}/w", f"{path}/c", fold_every=fold_every))
        landed = tables.read_layer(spark, f"{path}/lake", "bronze", "market_trends")
        assert sorted(r["event_id"] for r in landed.collect()) == list(range(0, 40, 5))
        found = landing.read_windows(spark, f"{path}/w", closed_after="10 minutes").orderBy("start_at").collect()
        assert [(r["n"], r["max_price"]) for r in found] == want and len(want) == 3
        assert sum(r["n"] for r in landing.read_windows(spark, f"{path}/w").collect()) == 7
        progress = landing.read_progress(spark, f"{path}/w").first()
        assert (progress["landed"], progress["late"], progress["undated"]) == (8, 1, 0)
        again(path)


def seen(days, value, product=1, retailer=1, order=0):
    return (product, retailer, dt.datetime(2020, 1, 1) + dt.timedelta(days=days), value, order, 1)


def land(spark, root, run, *observations):
    df = spark.createDataFrame([(*o,) for o in observations], PRICE_OBSERVATION)
    layers.write_bronze(df, root, "competitors", run, "feed")


def agree(spark, tables_, root):
    """The tables equal a rebuild from all of bronze."""
    bronze = tables.read_layer(spark, root, "bronze", "competitors").select(*PRICE_OBSERVATION.names)
    whole = bronze.dropDuplicates().filter("price > 0 AND product_id IS NOT NULL")
    assert rows(tables_.prices()) == rows(whole)
    assert rows(tables_.current_price()) == rows(price.current_price(whole).select(*PRICE_OBSERVATION.names))
    assert rows(tables_.price_history()) == rows(price.price_history(whole))
    month = F.date_trunc("month", "observed_at").alias("month")
    assert rows(tables_.monthly_prices()) == rows(whole.groupBy("product_id", "retailer_id", month).agg(
        F.count("price"), F.avg("price"), F.min("price"), F.max("price")))


def test_steps_equal_a_rebuild(spark):
    root = scratch(spark)
    prices = incremental.PriceTables(spark, root)
    assert prices.step() == {"runs": 0, "rows": 0}
    land(spark, root, "a", seen(0, 10.0), seen(9, 10.0), seen(40, 12.0), seen(1, -5.0), seen(3, 7.0, 2))
    assert prices.step() == {"runs": 1, "rows": 4}
    agree(spark, prices, root)
    # Rows again, a price between two old ones, another key, an unknown product.
    land(spark, root, "b", seen(9, 10.0), seen(5, 11.0), seen(3, 7.0, 2), seen(3, 7.0, 3), (None, 1, minute(0), 5.0, 1, 1))
    land(spark, root, "c", seen(50, 12.0), seen(60, 10.0))
    assert prices.step() == {"runs": 2, "rows": 4}
    agree(spark, prices, root)
    prices.fold()
    agree(spark, prices, root)
    assert prices.step() == {"runs": 0, "rows": 0}
    land(spark, root, "d", seen(70, 10.0), seen(5, 11.0))
    assert prices.step() == {"runs": 1, "rows": 1}
    agree(spark, prices, root)
    land(spark, root, "b", seen(5, 14.0))  # delivered again with other rows: all is built anew
    assert prices.step()["runs"] == 4
    agree(spark, prices, root)


def test_a_step_reads_new_runs_only(spark, monkeypatch):
    root = scratch(spark)
    prices = incremental.PriceTables(spark, root)
    for i in range(3):
        land(spark, root, f"r{i}", *[seen(31 * i + k, float(k + 1)) for k in range(5)])
        prices.step()
    land(spark, root, "r3", *[seen(200 + k, float(k + 1)) for k in range(5)])
    plans, conform = [], incremental.quality.conform
    monkeypatch.setattr(incremental.quality, "conform", lambda df, *a: plans.append(df.inputFiles()) or conform(df, *a))
    prices.step()
    assert len(plans) == 1 and plans[0] and all("_run_id=r3" in f for f in plans[0])


def test_a_broken_step_is_run_again(spark, monkeypatch):
    root = scratch(spark)
    prices = incremental.PriceTables(spark, root)
    land(spark, root, "a", seen(0, 10.0), seen(9, 11.0))
    prices.step()
    land(spark, root, "b", seen(4, 12.0), seen(20, 13.0))
    put = prices.ledger.put
    monkeypatch.setattr(prices.ledger, "put", lambda *a: 1 / 0)
    try:
        prices.step()
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(prices.ledger, "put", put)
    prices.fold()
    assert prices.prices().count() == 2 and prices.monthly_prices().first()["n"] == 2
    land(spark, root, "c", seen(5, 14.0))
    assert prices.step() == {"runs": 2, "rows": 3}
    agree(spark, prices, root)


def test_a_run_again_with_the_same_rows_builds_nothing_anew(spark):
    root = scratch(spark)
    prices = incremental.PriceTables(spark, root)
    first = [seen(31 * k, float(k + 1)) for k in range(5)]
    land(spark, root, "01", *first)
    prices.step()
    land(spark, root, "2:x", seen(200, 3.0), seen(3, 7.0, 2))
    assert prices.step() == {"runs": 1, "rows": 2}
    silver = sorted(prices.prices().inputFiles())
    land(spark, root, "01", *reversed(first))
    land(spark, root, "2:x", seen(3, 7.0, 2), seen(200, 3.0))
    assert prices.step() == prices.step() == {"runs": 0, "rows": 0}
    assert sorted(prices.prices().inputFiles()) == silver
    agree(spark, prices, root)


def test_hot_and_many_keys_are_taken_in_alike(spark, monkeypatch):
    monkeypatch.setattr(incremental, "FEW_KEYS", 1)
    for rows_of_hot in (4, 4_000_000):
        monkeypatch.setattr(incremental.OrderedGroups.__init__, "__defaults__", (rows_of_hot,))
        root = scratch(spark)
        prices = incremental.PriceTables(spark, root)
        land(spark, root, "a", *[seen(3 * k, float(k % 3 + 1)) for k in range(40)], seen(1, 2.0, 2), seen(1, 2.0, 3))
        prices.step()
        land(spark, root, "b", *[seen(k, float(k % 2 + 1)) for k in range(50)], seen(2, 2.0, 2), seen(3, 2.5, 2, None))
        prices.step()
        agree(spark, prices, root)
        prices.fold()
        agree(spark, prices, root)


def test_history_is_written_from_the_first_new_price_on(spark):
    root = scratch(spark)
    prices = incremental.PriceTables(spark, root)
    land(spark, root, "a", *[seen(3 * k, float(k % 3 + 1)) for k in range(40)], *[seen(k, 2.0 + k, 2, None) for k in range(9)])
    prices.step()
    # In time; without a change; late, between old prices; at the instant of an old price, and a new key.
    for run, new in (("b", [seen(200, 5.0), seen(210, 6.0)]), ("c", [seen(220, 6.0), seen(30, 9.0, 2, None)]),
                     ("d", [seen(100, 3.0)]), ("e", [seen(3, 7.0, 1, 1, 5), seen(4, 7.0, 3)])):
        land(spark, root, run, *new)
        prices.step()
        agree(spark, prices, root)
    batches = {b: spark.read.parquet(f"{prices.path}/history/batches/bronze/{b}").count() for _, b in prices.history.batches()}
    # Forty and nine intervals; the last old one and the new ones; two keys from day 30 on, of which one has no change.
    assert batches[0] == 49 and batches[1] == 3 and batches[2] < 40
    prices.fold()
    agree(spark, prices, root)
    land(spark, root, "f", seen(300, 1.0), seen(310, 2.0, 3))
    prices.step()
    agree(spark, prices, root)
    prices.fold()
    agree(spark, prices, root)
    assert prices.history.read().filter("since IS NULL").count() == 0
