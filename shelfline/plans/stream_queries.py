"""Registered streaming queries.

Where a static frame gives the same result, the operator runs on the whole
table; the others run as real streams over it until all input is consumed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.plans import fixtures as fx
from shelfline.plans.registry import query, rounded, second, sql
from shelfline.plans.source_queries import broken_payloads
from shelfline.schemas import ALERT, schema_of
from shelfline.session import scratch
from shelfline.sources import tables, topics
from shelfline.streaming import changes, landing, windows


def _stream(spark, d):
    """The events file as a stream of all three topics, in a streaming session."""
    sister = changes.stream_session(spark)
    return topics.price_events(topics.read_events(sister, d, pattern=fx.EVENTS))


_STATS = """count(*) AS n, T(avg(new_price)) AS avg_price, T(min(new_price)) AS min_price,
    T(max(new_price)) AS max_price"""


def _spans(df):
    return rounded(df, "avg_price", "min_price", "max_price").withColumns(
        {c: second(c) for c in ("start_at", "end_at")})


@query("decode", """
    SELECT event_id, CASE WHEN event_type <> 'error'
                          THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
           event_type <> 'error' AS decoded FROM events""")
def decode(spark, d):
    """Payloads decoded by a stream; malformed ones go to a side table."""
    sister = changes.stream_session(spark)
    raw = broken_payloads(topics.read_events(sister, d, pattern=fx.EVENTS))
    good, bad = (changes.drained(side) for side in windows.decode(raw, schema_of("k int")))
    return good.withColumn("decoded", F.lit(True)).unionByName(
        bad.select("event_id", F.lit(None).cast("int").alias("k"), F.lit(False).alias("decoded")))


@query("agg_tumbling", sql("event", f"""
    SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS start_at,
           strftime(hour + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end_at,
           topic, retailer_id, {_STATS}
    FROM (SELECT *, date_trunc('hour', event_time) AS hour FROM event) AS e
    GROUP BY hour, topic, retailer_id"""))
def agg_tumbling(spark, d):
    return _spans(windows.agg_tumbling(fx.events(spark, d)))


@query("landed_windows", sql("event", f"""
    SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS start_at,
           strftime(hour + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end_at,
           topic, retailer_id, {_STATS}
    FROM (SELECT *, date_trunc('hour', event_time) AS hour FROM event) AS e
    GROUP BY hour, topic, retailer_id"""))
def landed_windows(spark, d):
    """Windows kept beside the events that a stream lands in bronze; those still open are there too."""
    path = scratch(spark)
    changes.run_available(landing.land(
        _stream(spark, d), f"{path}/lake", "market_trends", f"{path}/windows", f"{path}/checkpoint"))
    return _spans(landing.read_windows(spark, f"{path}/windows"))


@query("landed_events", sql("event", """
    SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, topic, product_id,
           retailer_id, new_price, payload, 'stream' AS _source FROM event"""))
def landed_events(spark, d):
    """All events of a stream as they lie in bronze."""
    path = scratch(spark)
    changes.run_available(landing.land(
        _stream(spark, d), f"{path}/lake", "market_trends", f"{path}/windows", f"{path}/checkpoint"))
    landed = tables.read_layer(spark, f"{path}/lake", "bronze", "market_trends")
    return landed.drop("_ingest_ts", "_run_id").withColumn("event_time", second("event_time"))


@query("tumbling_stream", sql("event", f"""
    SELECT strftime(hour, '%Y-%m-%d %H:%M:%S') AS start_at,
           strftime(hour + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end_at,
           topic, retailer_id, {_STATS}
    FROM (SELECT *, date_trunc('hour', event_time) AS hour FROM event) AS e
    WHERE hour + INTERVAL 1 HOUR <= (SELECT max(event_time) FROM event) - INTERVAL 10 MINUTE
    GROUP BY hour, topic, retailer_id"""))
def tumbling_stream(spark, d):
    """The same as a stream: windows come out once the watermark has passed them."""
    return _spans(changes.drained(windows.agg_tumbling(_stream(spark, d))))


@query("agg_sliding", sql("event", f"""
    SELECT strftime(start_at, '%Y-%m-%d %H:%M:%S') AS start_at,
           strftime(start_at + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS end_at,
           topic, retailer_id, {_STATS}
    FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, event_time, TIMESTAMP '1970-01-01')
                    - to_minutes(15 * unnest(range(0, 4))) AS start_at FROM event) AS e
    GROUP BY e.start_at, topic, retailer_id"""))
def agg_sliding(spark, d):
    return _spans(windows.agg_sliding(fx.events(spark, d)))


@query("agg_session", sql("event", f"""
    SELECT strftime(min(event_time), '%Y-%m-%d %H:%M:%S') AS start_at,
           strftime(max(event_time) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS end_at,
           product_id, {_STATS}
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY product_id ORDER BY event_time, event_id) AS burst
          FROM (SELECT *, CASE WHEN event_time - lag(event_time) OVER (
                    PARTITION BY product_id ORDER BY event_time, event_id) <= INTERVAL 30 MINUTE
                    THEN 0 ELSE 1 END AS fresh FROM event) AS f) AS b
    GROUP BY product_id, burst"""))
def agg_session(spark, d):
    return _spans(windows.agg_session(fx.events(spark, d)))


@query("dedup_stream", sql("event", """
    SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, topic, product_id,
           retailer_id, new_price FROM event"""))
def dedup_stream(spark, d):
    """A stream in which every event is delivered twice."""
    sister = changes.stream_session(spark)
    twice = [topics.price_events(topics.read_events(sister, d, pattern=fx.EVENTS))
             for _ in range(2)]
    once = changes.drained(windows.dedup_stream(topics.all_events(*twice)))
    return once.drop("payload").withColumn("event_time", second("event_time"))


_CHANGES = """SELECT product_id, retailer_id, event_id,
    strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, old_price, new_price,
    T((new_price - old_price) / nullif(old_price, 0)) AS pct
    FROM (SELECT *, lag(new_price) OVER (PARTITION BY product_id, retailer_id
                                         ORDER BY event_time, event_id) AS old_price
          FROM event) AS c WHERE old_price IS NOT NULL"""


@query("detect_changes", sql("event", _CHANGES))
def detect_changes(spark, d):
    """All events of the file as a stream, compared batch by batch."""
    path = scratch(spark)
    changes.run_available(changes.detect_changes(_stream(spark, d), f"{path}/changes", f"{path}/checkpoint"))
    found = changes.read_changes(spark, f"{path}/changes")
    return rounded(found, "pct").withColumn("event_time", second("event_time"))


@query("alerts", sql("event", _CHANGES + " AND abs((new_price - old_price) / nullif(old_price, 0)) >= 0.1"))
def alerts(spark, d):
    """Alerts written as JSON messages by a stream and read back."""
    path = scratch(spark)
    changes.run_available(changes.detect_changes(
        _stream(spark, d), f"{path}/changes", f"{path}/checkpoint", 0.1, changes.send_alerts(f"{path}/alerts")))
    messages = changes.read_alerts(spark, f"{path}/alerts")
    read = messages.select(F.from_json("value", ALERT).alias("a")).select("a.*")
    return rounded(read, "pct").withColumn("event_time", second("event_time"))


@query("enrich", sql("event product", """
    SELECT event_id, product_id, retailer_id, new_price, name, category,
           CASE retailer_id WHEN 0 THEN 'OWN' ELSE 'COMP_' || retailer_id END AS retailer
    FROM event LEFT JOIN product USING (product_id)"""))
def enrich(spark, d):
    """A stream joined with the static product and retailer tables."""
    stream = _stream(spark, d)
    sister = stream.sparkSession
    joined = windows.enrich(stream, fx.products(sister, d), fx.retailers(sister, d))
    return changes.drained(joined.select("event_id", "product_id", "retailer_id", "new_price",
                                         "name", "category", "retailer"))


_REACTION = """SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
    product_id, new_price FROM event AS p WHERE topic = 'price-changes' AND EXISTS (
        SELECT 1 FROM event AS m WHERE m.topic = 'promotion-events'
          AND m.product_id = p.product_id AND p.event_time >= m.event_time
          AND p.event_time < m.event_time + INTERVAL 1 HOUR)"""


def _topics(events):
    return (events.filter("topic = 'promotion-events'"), events.filter("topic = 'price-changes'"))


def _reaction_out(df):
    return df.select("event_id", second("event_time").alias("event_time"), "product_id",
                     "new_price")


@query("promo_reaction", sql("event", _REACTION))
def promo_reaction(spark, d):
    return _reaction_out(windows.promo_reaction(*_topics(fx.events(spark, d))))


@query("promo_reaction_stream", sql("event", _REACTION))
def promo_reaction_stream(spark, d):
    """The same as a join of two streams."""
    promo, _ = _topics(_stream(spark, d))
    _, price = _topics(topics.price_events(
        topics.read_events(promo.sparkSession, d, pattern=fx.EVENTS)))
    return _reaction_out(changes.drained(windows.promo_reaction(promo, price)))


@query("live_prices", sql("event", """
    SELECT product_id, retailer_id, event_id,
           strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, new_price FROM event
    QUALIFY row_number() OVER (PARTITION BY product_id, retailer_id
                               ORDER BY event_time DESC, event_id DESC) = 1"""))
def live_prices(spark, d):
    """The live table after a stream has put all events in."""
    path = scratch(spark)
    changes.run_available(changes.live_prices(_stream(spark, d), f"{path}/live",
                                              f"{path}/checkpoint"))
    return changes.read_live(spark, f"{path}/live").select(
        "product_id", "retailer_id", "event_id", second("event_time").alias("event_time"),
        "new_price")


_LATENCY = sql("event", """
    SELECT topic, count(*) AS n, T(quantile_disc(waited, 0.5)) AS p50,
           T(quantile_disc(waited, 0.95)) AS p95, T(max(waited)) AS slowest,
           T(avg(CASE WHEN waited <= 300 THEN 1e0 ELSE 0e0 END)) AS within_target
    FROM (SELECT topic, CAST(round(new_price * 1000000) AS BIGINT) / 1e6 AS waited FROM event) AS w
    GROUP BY topic""")


def _arrived():
    """Events taken to arrive as many seconds late as their value says."""
    micros = F.round(F.col("new_price") * 1_000_000).cast("bigint")
    return F.timestamp_micros(F.unix_micros("event_time") + micros)


@query("latency", _LATENCY)
def latency(spark, d):
    out = windows.latency(fx.events(spark, d), _arrived())
    return rounded(out, "p50", "p95", "slowest", "within_target")


@query("latency_stream", _LATENCY)
def latency_stream(spark, d):
    """The same report merged from the states that a stream keeps."""
    path = scratch(spark)
    changes.run_available(windows.latency_stream(_stream(spark, d), f"{path}/states", f"{path}/checkpoint", _arrived()))
    return rounded(windows.read_latency(spark, f"{path}/states"), "p50", "p95", "slowest", "within_target")


@query("two_consumers", sql("event", """
    SELECT consumer, topic, count(*) AS n FROM event,
        (SELECT unnest(['analytics', 'monitoring']) AS consumer) AS c
    WHERE topic = 'price-changes' GROUP BY consumer, topic"""))
def two_consumers(spark, d):
    """Two readers of one topic, each with its own checkpoint."""
    sister = changes.stream_session(spark)
    read = [changes.drained(topics.read_topic(sister, "price-changes", d, pattern=fx.EVENTS))
            .withColumn("consumer", F.lit(name)) for name in ("analytics", "monitoring")]
    return read[0].unionByName(read[1]).groupBy("consumer", "topic").agg(
        F.count(F.lit(1)).alias("n"))
