import datetime as dt
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfline.schemas import EVENT_FILE, schema_of
from shelfline.session import scratch
from shelfline.sources import topics
from shelfline.streaming import changes, windows

START = dt.datetime(2024, 1, 1, 12)


def minute(m):
    return START + dt.timedelta(minutes=m)


class Feed:
    """A folder of event files; each ``put`` adds one, and one file is one batch."""

    def __init__(self, spark):
        self.spark, self.folder = changes.stream_session(spark), scratch(spark)

    def put(self, *rows):
        """Rows of (event_id, minute, product, price) or with a payload as fifth value."""
        data = [(i, minute(m), p, "purchase", x, *(rest or ("{}",))) for i, m, p, x, *rest in rows]
        (self.spark.createDataFrame(data, EVENT_FILE).coalesce(1)
         .write.mode("append").parquet(self.folder))
        time.sleep(0.05)  # files are taken by modification time
        return self

    def stream(self):
        return topics.read_topic(self.spark, "price-changes", self.folder, per_trigger=1,
                                 pattern="part*")


def followed(feed, path, **more):
    return changes.run_available(changes.detect_changes(feed.stream(), f"{path}/changes", f"{path}/c", **more))


def again(path, checkpoint="c"):
    """Forget that the last batch was committed, so that it runs again."""
    commits = [p for p in Path(path, checkpoint, "commits").iterdir() if p.name.isdigit()]
    last = max(commits, key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)


def changed(spark, path):
    found = changes.read_changes(spark, f"{path}/changes").orderBy("event_time", "event_id").collect()
    return [(r["product_id"], r["old_price"], r["new_price"]) for r in found]


def test_detect_changes_over_batches(spark):
    # Event ids are multiples of 5: one retailer.
    feed = Feed(spark).put((0, 0, 1, 100.0), (5, 2, 1, 120.0), (10, 1, 1, 105.0))
    feed.put((15, 3, 1, 60.0), (20, 3, 2, 1.0)).put((25, 4, 1, 63.0))
    path = scratch(spark)
    followed(feed, path)
    found = changes.read_changes(spark, f"{path}/changes").orderBy("event_time").collect()
    assert [(r["old_price"], r["new_price"]) for r in found] == [
        (100.0, 105.0), (105.0, 120.0), (120.0, 60.0), (60.0, 63.0)]
    assert [r["pct"] for r in found] == pytest.approx([0.05, 1 / 7, -0.5, 0.05])


def test_changes_run_without_python_workers(spark):
    events = spark.createDataFrame([(1, 0, 5, minute(0), 1.0)], changes.LAST)
    plan = changes.changes_of(events, events)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("fold_every", [1, 64])
def test_a_batch_that_runs_again_changes_nothing(spark, fold_every):
    feed, path = Feed(spark).put((0, 0, 1, 10.0), (5, 1, 1, 11.0)), scratch(spark)
    feed.put((10, 2, 1, 12.0), (15, 3, 1, 15.0), (20, 3, 2, 9.0))
    more = {"threshold": 0.1, "send": changes.send_alerts(f"{path}/alerts"), "fold_every": fold_every}
    for _ in range(3):
        followed(feed, path, **more)
        assert changed(spark, path) == [(1, 10.0, 11.0), (1, 11.0, 12.0), (1, 12.0, 15.0)]
        alerts = [r["value"] for r in changes.read_alerts(spark, f"{path}/alerts").collect()]
        assert sorted('"new_price":15.0' in a for a in alerts) == [False, True]
        again(path)
    feed.put((25, 4, 1, 30.0), (30, 4, 2, 9.0))
    followed(feed, path, **more)
    assert changed(spark, path)[-2:] == [(1, 15.0, 30.0), (2, 9.0, 9.0)]


def test_changes_of_a_hot_key(spark):
    rng = random.Random(9)
    rows = [(1, 0, i, minute(rng.randint(0, 300)), float(rng.randint(0, 9))) for i in range(2000)]
    rows += [(p, r, 9000 + i, minute(i), float(i)) for i, (p, r) in enumerate([(2, 0), (2, 0), (3, 1), (None, 1), (None, 1)])]
    events = spark.createDataFrame([*rows, (1, 0, 7, minute(5), None)], changes.LAST)
    last = spark.createDataFrame([(1, 0, 1, minute(999), 50.0), (3, 1, 1, minute(0), 0.0)], changes.LAST)
    found = [sorted(map(tuple, changes.changes_of(events, last, n).collect()), key=repr) for n in (4_000_000, 50)]
    assert found[0] == found[1] and len(found[0]) == 2000 + 1 + 1 + 1
    first = min(rows[:2000], key=lambda r: (r[3], r[2]))
    assert (1, 0, first[2], first[3], 50.0, first[4], (first[4] - 50) / 50) in found[0]
    assert [r[4:] for r in found[0] if r[0] == 3] == [(0.0, 2.0, None)]


def test_alerts_reach_the_topic(spark):
    feed = Feed(spark).put((0, 0, 1, 100.0), (5, 1, 1, 105.0), (10, 2, 1, 120.0))
    path = scratch(spark)
    query = followed(feed, path, threshold=0.1, send=changes.send_alerts(f"{path}/alerts"))
    messages = changes.read_alerts(spark, f"{path}/alerts").collect()
    assert [m["key"] for m in messages] == ["1-0"]
    assert '"old_price":105.0,"new_price":120.0' in messages[0]["value"]
    assert sum(p["rows"] for p in changes.progress(query)) == 3


def test_sessions_of_a_hot_key(spark):
    rng = random.Random(2)
    rows = [(i, 1 if i % 3 else rng.randint(2, 5), minute(rng.choice([0, 700, 3000]) + rng.randint(0, 600)), float(i))
            for i in range(3000)]
    rows += [(9000 + i, None, minute(40 * i), None) for i in range(3)] + [(9010, 1, None, 1.0)]
    df = spark.createDataFrame(rows, "event_id int, product_id int, event_time timestamp, new_price double")
    for gap in ("1 minute", "30 minutes", "2 seconds"):
        found = [sorted(map(tuple, windows.agg_session(df, gap, group_rows=n).collect()), key=repr)
                 for n in (4_000_000, 20)]
        want = df.groupBy(F.session_window("event_time", gap).alias("w"), "product_id").agg(
            F.count(F.lit(1)).alias("n"), F.avg("new_price"), F.min("new_price"), F.max("new_price"))
        want = sorted(map(tuple, want.select("w.start", "w.end", "product_id", *want.columns[2:]).collect()), key=repr)
        assert [r[:4] for r in found[0]] == [r[:4] for r in want] and found[0] == found[1] and len(want) > 3
        assert [r[4] for r in found[0]] == pytest.approx([r[4] for r in want])


def test_live_table_folds_and_streams_share_it(spark):
    path, live = scratch(spark), f"{scratch(spark)}/live"
    feed = Feed(spark).put((0, 0, 1, 10.0), (5, 2, 1, 12.0)).put((10, 1, 1, 11.0), (15, 1, 2, 5.0))
    other = Feed(spark).put((20, 9, 1, 13.0)).put((25, 1, 3, 2.0))
    for checkpoint, source in (("c1", feed), ("c2", other)):  # both number their batches from 0
        changes.run_available(changes.live_prices(source.stream(), live, f"{path}/{checkpoint}"))
    table = changes._live(spark, live)
    prices = lambda: sorted((r["product_id"], r["new_price"]) for r in changes.read_live(spark, live).collect())
    want = [(1, 13.0), (2, 5.0), (3, 2.0)]
    assert prices() == want and len(table.batches()) == 4
    assert table.fold(drop=False) == 1 and prices() == want and len(table.batches()) == 4
    files = lambda: sum(1 for _ in Path(live).rglob("part-*.parquet"))
    before = files()
    assert changes.fold_live(spark, live) == 1 and prices() == want and table.batches() == [] and files() < before
    again(path, "c2")  # a folded batch that runs again
    changes.run_available(changes.live_prices(other.stream(), live, f"{path}/c2"))
    feed.put((30, 50, 2, 6.0))
    changes.run_available(changes.live_prices(feed.stream(), live, f"{path}/c1", fold_every=2))
    assert prices() == [(1, 13.0), (2, 6.0), (3, 2.0)] and changes.fold_live(spark, live) == 2
    assert prices() == [(1, 13.0), (2, 6.0), (3, 2.0)]
    assert [p.name for p in Path(live, "manifests").iterdir()] == ["2"] and len(list(Path(live, "tables").iterdir())) == 1


def test_latency_of_a_stream(spark):
    feed = Feed(spark).put((0, 0, 1, 60.0), (5, 0, 1, 540.0)).put((10, 0, 1, 30.0)).put((15, 0, 1, 299.0))
    path = scratch(spark)
    arrived = F.timestamp_seconds(F.unix_seconds("event_time") + F.col("new_price"))
    for _ in range(2):
        changes.run_available(windows.latency_stream(feed.stream(), f"{path}/s", f"{path}/c", arrived))
        row = windows.read_latency(spark, f"{path}/s").first()
        assert tuple(row) == ("price-changes", 4, 60.0, 540.0, 540.0, 0.75)
        again(path)
    rows = spark.range(200_000).select(F.lit("t").alias("topic"), F.rand(1).alias("x"), F.col("id").alias("b"),
                                       F.timestamp_seconds(F.lit(0)).alias("event_time"))
    arrived = F.timestamp_micros((F.col("x") * 1e9).cast("long"))
    parts = [windows.latency_states(rows.filter(f"b % 7 = {i}"), arrived) for i in range(7)]
    states = parts[0]
    for part in parts[1:]:
        states = states.unionByName(part)
    row = windows.merged_latency(states).first()
    assert row["n"] == 200_000 and row["p50"] == pytest.approx(500, abs=2) and row["p95"] == pytest.approx(950, abs=2)


def test_late_event_is_left_out_of_aggregates(spark):
    feed = Feed(spark).put((0, 0, 1, 10.0), (5, 90, 1, 20.0)).put((10, 91, 1, 21.0))
    feed.put((15, 1, 1, 99.0)).put((20, 200, 1, 1.0))
    out = changes.drained(windows.agg_tumbling(feed.stream())).orderBy("start_at").collect()
    assert [(r["n"], r["max_price"]) for r in out] == [(1, 10.0), (2, 21.0)]
    assert changes.drained(feed.stream()).count() == 5


def test_duplicates_across_batches(spark):
    feed = Feed(spark).put((0, 0, 1, 10.0), (0, 0, 1, 10.0)).put((0, 0, 1, 10.0), (5, 1, 1, 11.0))
    out = changes.drained(windows.dedup_stream(feed.stream()))
    assert sorted(r["event_id"] for r in out.collect()) == [0, 5]


def test_sessions_and_sliding_windows(spark):
    feed = Feed(spark).put((0, 0, 1, 1.0), (5, 20, 1, 2.0), (10, 80, 1, 3.0)).put((15, 500, 9, 1.0))
    bursts = changes.drained(windows.agg_session(feed.stream())).orderBy("start_at").collect()
    assert [(r["n"], r["end_at"]) for r in bursts] == [(2, minute(50)), (1, minute(110))]
    sliding = changes.drained(windows.agg_sliding(feed.stream(), "1 hour", "30 minutes"))
    assert sliding.filter("max_price = 3").count() == 2


def test_decode_splits_malformed(spark):
    feed = Feed(spark).put((0, 0, 1, 1.0, '{"k": 4}'), (5, 1, 1, 1.0, '{"k": '))
    good, bad = windows.decode(feed.stream(), schema_of("k int"))
    assert [(r["event_id"], r["k"]) for r in changes.drained(good).collect()] == [(0, 4)]
    assert [r["payload"] for r in changes.drained(bad).collect()] == ['{"k": ']


def test_live_prices_and_fold(spark):
    feed = Feed(spark).put((0, 0, 1, 10.0), (5, 2, 1, 12.0)).put((10, 1, 1, 11.0), (15, 1, 2, 5.0))
    path = scratch(spark)
    changes.run_available(changes.live_prices(feed.stream(), f"{path}/live", f"{path}/c"))
    live = changes.read_live(spark, f"{path}/live")
    assert sorted((r["product_id"], r["new_price"]) for r in live.collect()) == [(1, 12.0), (2, 5.0)]
    for _ in range(2):
        changes.fold_live(spark, f"{path}/live", f"{path}/table")
    assert spark.read.parquet(f"{path}/table").count() == 2


def test_enrich_keeps_unknown_products(spark):
    feed = Feed(spark).put((0, 0, 1, 10.0), (5, 1, 7, 11.0))
    product = feed.spark.createDataFrame([(1, "gear")], "product_id bigint, name string")
    retailer = feed.spark.createDataFrame([(0, "OWN")], "retailer_id bigint, retailer string")
    out = changes.drained(windows.enrich(feed.stream(), product, retailer))
    assert sorted((r["product_id"], r["name"], r["retailer"]) for r in out.collect()) == [
        (1, "gear", "OWN"), (7, None, "OWN")]


def test_promo_reaction(spark):
    rows = [(1, 1, 0, "promotion-events"), (2, 1, 59, "promotion-events"), (3, 1, 60, "price-changes"),
            (4, 1, 61, "price-changes"), (5, 2, 1, "price-changes"), (6, 1, 118, "price-changes"),
            (7, 1, 119, "price-changes"), (8, 1, -1, "price-changes")]
    events = spark.createDataFrame([(i, minute(m), t, p, 0, 1.0, "{}") for i, p, m, t in rows],
                                   "event_id bigint, event_time timestamp, topic string, "
                                   "product_id bigint, retailer_id bigint, new_price double, "
                                   "payload string")
    out = windows.promo_reaction(events.filter("topic = 'promotion-events'"),
                                 events.filter("topic = 'price-changes'"))
    assert sorted(r["event_id"] for r in out.collect()) == [3, 4, 6]


def test_latency(spark):
    df = spark.createDataFrame([(minute(0), minute(1)), (minute(0), minute(9))],
                               "event_time timestamp, seen timestamp").withColumn("topic", F.lit("t"))
    row = windows.latency(df, F.col("seen")).first()
    assert (row["n"], row["slowest"], row["within_target"]) == (2, 540.0, 0.5)
    assert windows.latency(df).first()["p95"] > 0


def test_topics(spark):
    with pytest.raises(ValueError, match="unknown input topic"):
        topics.read_topic(spark, "alerts", "/nowhere")
    a = spark.createDataFrame([(1,)], "event_id bigint")
    b = spark.createDataFrame([(2, 3.0)], "event_id bigint, new_price double")
    assert [tuple(r) for r in topics.all_events(a, b).orderBy("event_id").collect()] == [
        (1, None), (2, 3.0)]
