"""Registered queries of sources, layers, quality and normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.text import canonical_name
from shelfline.operators import normalize, price, quality
from shelfline.operators.audit import audit_log, audited
from shelfline.plans import fixtures as fx, incremental
from shelfline.plans.registry import day, query, rounded, second, sql
from shelfline.schemas import OBSERVED_ORDER, schema_of
from shelfline.session import scratch
from shelfline.sinks import layers
from shelfline.sources import pages, tables, topics

_TEXT = "x"
for _entity, _sign in reversed(pages.ENTITIES.items()):
    _TEXT = f"replace({_TEXT}, '{_entity}', '{_sign}')"
_TEXT = f"trim({_TEXT})"


def _decoded_sql(expression: str) -> str:
    return f"nullif({_TEXT.replace('(x,', f'({expression},')}, '')"


PRICE = r'class="[^"]*price[^"]*"[^>]*>\s*([0-9][0-9.,]*)\s*([A-Z]{3})'


@query("extract_pages", f"""
    SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) AS host,
           {_decoded_sql("regexp_extract(html, '<title>([^<]*)', 1)")} AS title,
           CAST(item_no AS INTEGER) AS item_no,
           {_decoded_sql("regexp_extract(parts[item_no + 2], '^([^<]*)', 1)")} AS product_name,
           TRY_CAST(regexp_extract(parts[item_no + 2], '{PRICE}', 1) AS DOUBLE) AS price,
           nullif(regexp_extract(parts[item_no + 2], '{PRICE}', 2), '') AS currency
    FROM (SELECT *, unnest(range(0, greatest(len(parts) - 1, 1))) AS item_no
          FROM (SELECT *, string_split_regex(html, '{pages.HEADING}') AS parts
                FROM pages) AS p) AS i""")
def extract_pages(spark, d):
    return pages.extract_pages(fx.load(spark, d, "pages"))


@query("extract_links", r"""
    SELECT page_id, CAST(link_no AS INTEGER) AS link_no, links[link_no + 1] AS link
    FROM (SELECT page_id, links, unnest(range(0, len(links))) AS link_no
          FROM (SELECT page_id, regexp_extract_all(html, '<a\s+href="([^"]*)"', 1) AS links
                FROM pages) AS p) AS l""")
def extract_links(spark, d):
    return pages.extract_links(fx.load(spark, d, "pages"))


@query("read_sales", sql("sale", """
    SELECT order_id, line_no, product_id, retailer_id, strftime(sold_at, '%Y-%m-%d') AS sold_on,
           qty, T(amount) AS amount, discount, T(net_price) AS net_price, is_promo, category, brand
    FROM sale"""))
def read_sales(spark, d):
    """Sales landed as JSON and read back under the sale contract."""
    path = scratch(spark)
    fx.sales(spark, d).write.json(path)
    landed = tables.read_sales(spark, path, "json")
    return rounded(landed.withColumn("sold_on", day("sold_at")).drop("sold_at"),
                   "amount", "net_price")


@query("read_market", sql("obs product market", """
    SELECT category, strftime(month, '%Y-%m-%d') AS month, T(market_price) AS market_price
    FROM market"""))
def read_market(spark, d):
    """Market trend landed as CSV and read back."""
    path = scratch(spark)
    fx.market(spark, d).write.option("header", "true").csv(path)
    landed = rounded(tables.read_market(spark, path, "csv"), "market_price")
    return landed.withColumn("month", day("month"))


@query("standardize_market", sql("obs product market", """
    SELECT category, strftime(month, '%Y-%m-%d') AS month, T(market_price) AS market_price
    FROM market"""))
def standardize_market(spark, d):
    return rounded(fx.market(spark, d), "market_price").withColumn("month", day("month"))


_TOPIC_SQL = """SELECT event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, topic,
    product_id, retailer_id, new_price, payload FROM event"""


def _topic_query(topic: str):
    name = f"topic_{topic.replace('-', '_')}"

    @query(name, sql("event", f"{_TOPIC_SQL} WHERE topic = '{topic}'"))
    def topic_events(spark, d):
        found = topics.read_topic(spark, topic, d, streaming=False, pattern=fx.EVENTS)
        return found.withColumn("event_time", second("event_time"))


for _topic in ("price-changes", "promotion-events", "market-trends"):
    _topic_query(_topic)


@query("all_events", sql("event", _TOPIC_SQL))
def all_events(spark, d):
    parts = [topics.read_topic(spark, t, d, streaming=False, pattern=fx.EVENTS)
             for t in topics.TOPIC_OF_TYPE.values()]
    return topics.all_events(*parts).withColumn("event_time", second("event_time"))


def _messages(spark, d):
    """All events as JSON messages of their topic; those of type error lost their end."""
    raw = fx.load(spark, d, "events")
    kinds = F.col("event_type")
    body = F.to_json(F.struct(
        "event_id", F.col("ts").cast("timestamp").alias("event_time"), F.lit("price-changes").alias("topic"),
        F.col("user_id").alias("product_id"), (F.col("event_id") % 5).alias("retailer_id"),
        F.col("value").alias("new_price"), F.col("props").alias("payload")),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return raw.select(F.when(kinds == "error", F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body).alias("value"))


@query("replay_json", """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, user_id AS product_id, event_id % 5 AS retailer_id,
           value AS new_price, props AS payload, false AS malformed FROM events WHERE event_type <> 'error'
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, true FROM events WHERE event_type = 'error'""")
def replay_json(spark, d):
    """A topic landed as JSON lines, replayed under the event contract; broken messages stand beside it."""
    path = scratch(spark)
    _messages(spark, d).write.text(path)
    events, malformed = topics.replay(spark, "price-changes", path, streaming=False)
    events = events.drop("topic").withColumns({"event_time": second("event_time"), "malformed": F.lit(False)})
    return events.unionByName(malformed.select(F.lit(True).alias("malformed")), allowMissingColumns=True)


@query("bronze_layer", sql("obs", """
    SELECT product_id, retailer_id, strftime(observed_at, '%Y-%m-%d') AS observed_on,
           T(price) AS price, order_id, line_no, 'feed' AS _source,
           CASE WHEN retailer_id IN (1, 2) THEN 'run-1' ELSE 'run-2' END AS _run_id
    FROM obs WHERE retailer_id <> 0"""))
def bronze_layer(spark, d):
    """Two runs appended to bronze, the second one repeated, then scanned."""
    root, obs = scratch(spark), fx.observations(spark, d)
    for run_id, ids in (("run-1", (1, 2)), ("run-2", (3, 4)), ("run-2", (3, 4))):
        layers.write_bronze(obs.filter(F.col("retailer_id").isin(*ids)), root, "competitors",
                            run_id, "feed")
    landed = tables.read_layer(spark, root, "bronze", "competitors")
    return rounded(landed, "price").withColumn("observed_on", day("observed_at")).drop(
        "observed_at", "_ingest_ts")


@query("silver_layer", sql("sale", """
    SELECT order_id, line_no, product_id, retailer_id, strftime(sold_at, '%Y-%m-%d') AS sold_on, qty,
           T(amount) AS amount, T(discount) AS discount, T(net_price) AS net_price, is_promo, category, brand
    FROM sale"""))
def silver_layer(spark, d):
    root = scratch(spark)
    layers.write_silver(fx.sales(spark, d), root, "categorized", ["category"])
    sold = tables.read_layer(spark, root, "silver", "categorized")
    return rounded(sold, "amount", "discount", "net_price").withColumn("sold_on", day("sold_at")).drop("sold_at")


@query("gold_layer", sql("gap", """
    SELECT product_id, T(own_price) AS own_price, n_competitors, T(competitor_min) AS competitor_min,
           T(competitor_avg) AS competitor_avg, T(competitor_max) AS competitor_max, T(gap) AS gap FROM gap"""))
def gold_layer(spark, d):
    root = scratch(spark)
    gap = price.price_gap(price.current_price(fx.observations(spark, d)))
    layers.write_gold(gap, root, "price_analytics", "price_gap")
    gold = tables.read_layer(spark, root, "gold", "price_analytics/price_gap")
    return rounded(gold, "own_price", "competitor_min", "competitor_avg", "competitor_max", "gap")


def _in_steps(spark, d):
    """Prices landed in three runs, one of them twice, and taken in run by run."""
    root, obs = scratch(spark), fx.observations(spark, d)
    prices = incremental.PriceTables(spark, root)
    for run_id, years in (("run-1", (1995, 1997)), ("run-2", (1996, 1999)), ("run-2", (1996, 1999)),
                          ("run-3", (1998, 2001))):
        rows = obs.filter(F.year("observed_at").between(*years))
        layers.write_bronze(rows, root, "competitors", run_id, "feed")
        prices.step()
    prices.fold()
    return prices


@query("incremental_monthly", sql("obs", """
    SELECT product_id, retailer_id, strftime(date_trunc('month', observed_at), '%Y-%m-%d') AS month, count(*) AS n,
           T(avg(price)) AS avg_price, T(min(price)) AS min_price, T(max(price)) AS max_price
    FROM obs GROUP BY product_id, retailer_id, date_trunc('month', observed_at)"""))
def incremental_monthly(spark, d):
    """Monthly prices from the states of all steps; runs overlap, so rows are delivered twice."""
    found = rounded(_in_steps(spark, d).monthly_prices(), "avg_price", "min_price", "max_price")
    return found.withColumn("month", day("month"))


@query("incremental_history", sql("history", """
    SELECT product_id, retailer_id, T(price) AS price, strftime(valid_from, '%Y-%m-%d') AS valid_from,
           strftime(valid_to, '%Y-%m-%d') AS valid_to FROM history"""))
def incremental_history(spark, d):
    """Price history with only the touched keys computed again in each step."""
    found = rounded(_in_steps(spark, d).price_history(), "price")
    return found.withColumns({c: day(c) for c in ("valid_from", "valid_to")})


@query("upsert", sql("cur", """
    SELECT product_id, retailer_id, strftime(observed_at, '%Y-%m-%d') AS observed_on,
           T(price) AS price, order_id, line_no FROM cur"""))
def upsert(spark, d):
    """A price table built up from three deliveries, one of them late and repeated."""
    path, obs = scratch(spark), fx.observations(spark, d)
    early = obs.filter("observed_at < '1998-01-01'")
    middle = obs.filter("observed_at >= '1998-01-01' AND observed_at < '2000-01-01'")
    late = obs.filter("observed_at >= '2000-01-01'")
    for delivery in (early, late, middle, middle):
        layers.upsert(path, delivery, ["product_id", "retailer_id"], OBSERVED_ORDER,
                      ["retailer_id"])
    table = spark.read.parquet(path).withColumn("retailer_id", F.col("retailer_id").cast("bigint"))
    return rounded(table, "price").withColumn("observed_on", day("observed_at")).drop(
        "observed_at")


@query("publish", sql("elas", """
    SELECT category, T(elasticity) AS elasticity, CAST(n AS BIGINT) AS n FROM elas"""))
def publish(spark, d):
    """A table of the catalog that lasts, published twice."""
    for _ in range(2):
        layers.publish(price.elasticity(fx.sales(spark, d)), "gold_elasticity", path=scratch(spark))
    return rounded(spark.table("gold_elasticity").select("category", "elasticity", "n"),
                   "elasticity")


@query("export_report", sql("obs product", """
    SELECT category, count(*) AS n, T(avg(price)) AS avg_price, day AS report_date
    FROM obs JOIN product USING (product_id),
         (SELECT unnest(['2001-12-30', '2001-12-31']) AS day) AS days
    WHERE observed_at < CAST(day AS DATE) GROUP BY category, day"""))
def export_report(spark, d):
    """Two dated CSV reports, the second exported twice."""
    path = scratch(spark)
    prices = fx.observations(spark, d).join(
        fx.products(spark, d).select("product_id", "category"), "product_id")
    for date in ("2001-12-30", "2001-12-31", "2001-12-31"):
        report = prices.filter(F.col("observed_at") < F.lit(date).cast("timestamp")).groupBy(
            "category").agg(F.count(F.lit(1)).alias("n"), F.avg("price").alias("avg_price"))
        layers.export_report(report, path, "csv", date)
    files = spark.read.option("header", "true").schema(
        "category string, n bigint, avg_price double, report_date string").csv(path)
    return rounded(files, "avg_price")


_RAW_LINE = schema_of("l_orderkey bigint, l_linenumber int, l_quantity double, l_discount double, "
                    "l_returnflag int, l_shipdate timestamp")


@query("conform", """
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
           TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag,
           strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate, l_linestatus FROM lineitem""")
def conform(spark, d):
    """Lines landed as text; a letter does not fit the whole-number flag."""
    text = fx.load(spark, d, "lineitem")
    text = text.select(*[F.col(c).cast("string").alias(c) for c in text.columns
                         if c in _RAW_LINE.names or c == "l_linestatus"])
    return quality.conform(text, _RAW_LINE, allow_new=True).withColumn(
        "l_shipdate", day("l_shipdate"))


@query("handle_nulls", """
    WITH lines AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no, p_type AS category,
                          nullif(l_tax, 0) AS tax, nullif(l_discount, 0) AS discount,
                          CASE WHEN l_quantity > 1 THEN l_quantity END AS qty
                   FROM lineitem JOIN part ON l_partkey = p_partkey),
    kept AS (SELECT * FROM lines WHERE qty IS NOT NULL),
    medians AS (SELECT category, quantile_cont(tax, 0.5) AS median FROM kept GROUP BY category)
    SELECT order_id, line_no, category, qty, coalesce(tax, median) AS tax,
           coalesce(discount, 0) AS discount FROM kept JOIN medians USING (category)""")
def handle_nulls(spark, d):
    """Zero tax and discount count as unknown, single pieces as a missing quantity."""
    lines = fx.load(spark, d, "lineitem").join(
        fx.products(spark, d).select(F.col("product_id").alias("l_partkey"), "category"),
        "l_partkey").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"), "category",
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.when(F.col("l_quantity") > 1, F.col("l_quantity")).alias("qty"))
    return quality.handle_nulls(lines, ["qty"], {"discount": 0.0}, {"tax": "category"})


@query("dedup", sql("obs", """
    SELECT order_id, line_no, product_id, retailer_id, T(price) AS price FROM obs
    QUALIFY row_number() OVER (PARTITION BY order_id, line_no ORDER BY observed_at DESC,
        product_id DESC, retailer_id DESC, price DESC) = 1"""))
def dedup(spark, d):
    latest = quality.dedup(fx.observations(spark, d), ["order_id", "line_no"],
                           ["observed_at", "product_id", "retailer_id", "price"])
    return rounded(latest, "price").drop("observed_at")


_RULES = {"price_floor": "price >= 100", "price_ceiling": "price <= 50000"}


# A line in six points at a product that does not exist.
_POINTED = """pointed AS (SELECT * REPLACE (CASE WHEN line_no = 6 THEN -product_id ELSE product_id END AS product_id)
    FROM obs)"""


def _checked(spark, d):
    lines = fx.observations(spark, d).withColumn(
        "product_id", F.when(F.col("line_no") == 6, -F.col("product_id")).otherwise(F.col("product_id")))
    return quality.validate(lines, {n: F.expr(r) for n, r in _RULES.items()}, {"product_id": fx.products(spark, d)})


@query("validate", sql("obs", f""", {_POINTED}
    SELECT order_id, line_no, product_id, retailer_id, T(price) AS price,
           array_to_string(list_filter([CASE WHEN NOT price >= 100 THEN 'price_floor' END,
               CASE WHEN NOT price <= 50000 THEN 'price_ceiling' END,
               CASE WHEN product_id NOT IN (SELECT p_partkey FROM part)
                    THEN 'product_id_known' END], lambda x: x IS NOT NULL), ',') AS failed
    FROM pointed WHERE NOT price >= 100 OR NOT price <= 50000
       OR product_id NOT IN (SELECT p_partkey FROM part)"""))
def validate(spark, d):
    _, bad = _checked(spark, d)
    return rounded(bad, "price").withColumn("failed", F.array_join("failed", ",")).drop(
        "observed_at")


@query("validate_good", sql("obs", f""", {_POINTED}
    SELECT order_id, line_no, product_id, retailer_id, T(price) AS price
    FROM pointed WHERE price >= 100 AND price <= 50000
      AND product_id IN (SELECT p_partkey FROM part)"""))
def validate_good(spark, d):
    good, _ = _checked(spark, d)
    return rounded(good, "price").drop("observed_at")


_PROFILED = ("product_id", "retailer_id", "observed_at", "price", "order_id", "line_no")


@query("profile", sql("obs", """
    SELECT 'rows' AS metric, '*' AS "column", CAST(count(*) AS DOUBLE) AS value FROM obs
    UNION ALL SELECT 'duplicate_rate', '*', T(1 - count(DISTINCT (order_id, line_no)) / count(*))
    FROM obs""" + "".join(f"""
    UNION ALL SELECT 'null_rate', '{c}', T(1 - count({c}) / count(*)) FROM obs
    UNION ALL SELECT 'distinct_rate', '{c}', T(count(DISTINCT {c}) / count(*)) FROM obs"""
                          for c in _PROFILED) + """
    UNION ALL SELECT 'out_of_range_rate', 'price',
        T(avg(CASE WHEN price BETWEEN 100 AND 50000 THEN 0.0 ELSE 1.0 END)) FROM obs"""))
def profile(spark, d):
    out = quality.profile(fx.observations(spark, d), ["order_id", "line_no"],
                          {"price": (100, 50000)}, exact=True)
    return rounded(out, "value")


# The other layer has all sales too: some under another product, some with a unit more.
_OTHER_SALES = """b AS (SELECT CASE WHEN sold_at < TIMESTAMP '1995-06-01' THEN -product_id ELSE product_id END AS product_id,
    qty + CASE WHEN discount > 0.09 THEN 1 ELSE 0 END AS qty FROM sale)"""


@query("reconcile", sql("sale", f"""
, {_OTHER_SALES},
    x AS (SELECT product_id, count(*) AS n, sum(qty) AS qty FROM sale GROUP BY product_id),
    y AS (SELECT product_id, count(*) AS n, sum(qty) AS qty FROM b GROUP BY product_id)
    SELECT product_id, x.n AS rows_a, y.n AS rows_b, T(y.qty - x.qty) AS qty_diff,
           CASE WHEN x.n IS NULL THEN 'missing_left' WHEN y.n IS NULL THEN 'missing_right'
                ELSE 'differs' END AS status
    FROM x FULL JOIN y USING (product_id)
    WHERE x.n IS DISTINCT FROM y.n OR x.qty IS DISTINCT FROM y.qty"""))
def reconcile(spark, d):
    sold = fx.sales(spark, d)
    other = sold.withColumns({
        "product_id": F.when(F.col("sold_at") < "1995-06-01", -F.col("product_id")).otherwise(F.col("product_id")),
        "qty": F.col("qty") + F.when(F.col("discount") > 0.09, 1).otherwise(0)})
    return rounded(quality.reconcile(sold, other, ["product_id"], ["qty"]), "qty_diff")


@query("changed_rows", sql("obs", """
, b AS (SELECT * REPLACE (CASE WHEN line_no = 3 THEN retailer_id + 1 ELSE retailer_id END AS retailer_id) FROM obs)
    SELECT product_id, retailer_id, strftime(observed_at, '%Y-%m-%d') AS observed_on, T(price) AS price,
           order_id, line_no, side FROM (
        SELECT *, 'a' AS side FROM (SELECT * FROM obs EXCEPT ALL SELECT * FROM b) AS x
        UNION ALL SELECT *, 'b' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM obs) AS y) AS z"""))
def changed_rows(spark, d):
    """All lines against a copy in which one line number went to another retailer."""
    obs = fx.observations(spark, d)
    other = obs.withColumn("retailer_id", F.when(
        F.col("line_no") == 3, F.col("retailer_id") + 1).otherwise(F.col("retailer_id")))
    found = rounded(quality.changed_rows(obs, other.select(*obs.columns)), "price")
    return found.withColumn("observed_on", day("observed_at")).drop("observed_at")


def broken_payloads(events):
    """Events whose error rows lost the end of their payload."""
    cut = F.expr("substring(props, 1, length(props) - 1)")
    return events.select("event_id", F.when(F.col("event_type") == "error", cut)
                         .otherwise(F.col("props")).alias("payload"))


_PAYLOAD = schema_of("k int")


@query("split_corrupt", """
    SELECT event_id, CASE WHEN event_type <> 'error'
                          THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
           event_type = 'error' AS corrupt FROM events""")
def split_corrupt(spark, d):
    good, bad = quality.split_corrupt(broken_payloads(fx.load(spark, d, "events")), "payload",
                                      _PAYLOAD)
    return good.withColumn("corrupt", F.lit(False)).unionByName(
        bad.select("event_id", F.lit(None).cast("int").alias("k"), F.lit(True).alias("corrupt")))


@query("audit", sql("obs", """
    SELECT 'validate' AS step, 'done' AS status, count(*) AS rows_in,
           count(*) FILTER (price >= 100 AND price <= 50000) AS rows_out,
           count(*) FILTER (NOT (price >= 100 AND price <= 50000)) AS rows_rejected FROM obs"""))
def audit(spark, d):
    root = scratch(spark)
    rules = {n: F.expr(r) for n, r in _RULES.items()}
    audited(spark, f"{root}/audit", "run-1", "validate", fx.observations(spark, d),
            lambda df: quality.checked(df, rules),
            lambda df: layers.write_silver(df, root, "normalized"),
            lambda df: df.write.mode("overwrite").parquet(f"{root}/rejected"))
    return audit_log(spark, f"{root}/audit").select(
        "step", "status", *[F.col("counts")[c].alias(c)
                            for c in ("rows_in", "rows_out", "rows_rejected")])


# Example rates to the base currency, one per currency.
RATES = {"VND": 1.0, "USD": 25000.0, "EUR": 27000.0, "THB": 700.0}


@query("normalize_price", sql("obs product", """
    SELECT order_id, line_no, product_id, retailer_id, currency, T(norm_price) AS norm_price,
           T(norm_price / pack_size) AS unit_price
    FROM (SELECT *, price * CASE WHEN retailer_id IN (0, 2, 4) THEN 1.0 ELSE 1.1 END
                 * CASE currency WHEN 'VND' THEN 1.0 WHEN 'USD' THEN 25000.0
                        WHEN 'EUR' THEN 27000.0 END AS norm_price
          FROM (SELECT *, ['VND', 'USD', 'EUR', 'VND', 'XXX'][retailer_id + 1] AS currency
                FROM obs JOIN product USING (product_id)) AS c) AS n"""))
def normalize_price(spark, d):
    """Retailer 4 quotes in a currency without a rate."""
    money = F.array(*[F.lit(c) for c in ("VND", "USD", "EUR", "VND", "XXX")])
    quotes = fx.observations(spark, d).join(
        fx.products(spark, d).select("product_id", F.col("pack_size").alias("content")),
        "product_id").withColumns({
            "currency": F.element_at(money, (F.col("retailer_id") + 1).cast("int")),
            "tax_included": F.col("retailer_id").isin(0, 2, 4)})
    rates = spark.createDataFrame(list(RATES.items()), "currency string, rate double")
    out = normalize.normalize_price(quotes, rates)
    return rounded(out, "norm_price", "unit_price").select(
        "order_id", "line_no", "product_id", "retailer_id", "currency", "norm_price", "unit_price")


@query("parse_pack", """
    SELECT p_partkey AS product_id,
           CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN p_size
                WHEN p_type IN ('LARGE', 'ECONOMY') THEN 1 END AS pack_count,
           CASE WHEN p_type = 'SMALL' THEN 330e0 WHEN p_type = 'MEDIUM' THEN 1.5e0
                WHEN p_type IN ('LARGE', 'ECONOMY') THEN CAST(p_size AS DOUBLE) END AS unit_size,
           CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'ml' WHEN p_type = 'LARGE' THEN 'g'
                WHEN p_type = 'ECONOMY' THEN 'piece' END AS unit,
           CASE WHEN p_type = 'SMALL' THEN p_size * 330e0 WHEN p_type = 'MEDIUM' THEN p_size * 1500e0
                WHEN p_type = 'LARGE' THEN p_size * 1000e0
                WHEN p_type = 'ECONOMY' THEN CAST(p_size AS DOUBLE) END AS content
    FROM part""")
def parse_pack(spark, d):
    """Names with a size in the style of each category; two have none."""
    size = F.col("pack_size").cast("string")
    named = fx.products(spark, d).select("product_id", F.concat_ws(
        " ", "name", F.when(F.col("category") == "SMALL", F.concat(size, F.lit(" x 330ml")))
        .when(F.col("category") == "MEDIUM", F.concat(size, F.lit("x1,5 L")))
        .when(F.col("category") == "LARGE", F.concat(size, F.lit(" KG bag")))
        .when(F.col("category") == "ECONOMY", F.concat(size, F.lit("pcs")))).alias("name"))
    return normalize.add_pack(named, "name").drop("name")


@query("price_index", sql("cur", """
    SELECT product_id, retailer_id, T(price) AS price, T(price / mean) AS "index",
           T((price - mean) / nullif(sd, 0)) AS z_score
    FROM cur JOIN (SELECT product_id, avg(price) AS mean, stddev_samp(price) AS sd
                   FROM cur GROUP BY product_id) AS s USING (product_id)"""))
def price_index(spark, d):
    out = normalize.price_index(price.current_price(fx.observations(spark, d)))
    return rounded(out, "price", "index", "z_score").select(
        "product_id", "retailer_id", "price", "index", "z_score")


CATEGORY_RULES = [("gear|rod", "drive"), ("bolt|ring", "fasteners"),
                  ("plate|anvil", "metalwork"), ("hot", "heated")]


@query("categorize", """
    SELECT p_partkey AS product_id, p_name AS name,
           CASE WHEN p_name LIKE '%gear%' OR p_name LIKE '%rod%' THEN 'drive'
                WHEN p_name LIKE '%bolt%' OR p_name LIKE '%ring%' THEN 'fasteners'
                WHEN p_name LIKE '%plate%' OR p_name LIKE '%anvil%' THEN 'metalwork'
                WHEN p_name LIKE '%hot%' THEN 'heated' ELSE 'other' END AS rule_category
    FROM part""")
def categorize(spark, d):
    return normalize.categorize(fx.products(spark, d).select("product_id", "name"), CATEGORY_RULES)


@query("canonical_name", """
    SELECT page_id, array_to_string(list_sort(string_split(trim(regexp_replace(
        strip_accents(lower(regexp_extract(html, '<title>([^<]*)', 1))), '[^a-z0-9]+', ' ', 'g')),
        ' ')), ' ') AS title FROM pages""")
def names(spark, d):
    return fx.load(spark, d, "pages").select("page_id", canonical_name(
        F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title"))


@query("match_products", """
    WITH a AS (SELECT p_partkey AS product_id, p_brand AS brand, list_sort(string_split(p_name, ' ')) AS t FROM part),
    b AS (SELECT product_id, brand, list_sort(string_split(name, ' ')) AS t
          FROM (SELECT p_partkey AS product_id, p_brand AS brand,
                       CASE WHEN p_type IN ('SMALL', 'LARGE') THEN replace(p_name, 'a', '')
                            WHEN p_type = 'PROMO' THEN 'x' || p_name
                            WHEN p_type = 'MEDIUM' THEN p_name || 'xyz' ELSE p_name END AS name FROM part) AS n),
    odd_a AS (SELECT product_id, brand, t[:i - 1] || t[i + 1:] AS rest, t[i] AS odd
              FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM a) AS e),
    odd_b AS (SELECT product_id, brand, t[:i - 1] || t[i + 1:] AS rest, t[i] AS odd
              FROM (SELECT *, unnest(range(1, len(t) + 1)) AS i FROM b) AS e),
    near AS (SELECT a.product_id, b.product_id AS match_id,
                    levenshtein(array_to_string(a.t, ' '), array_to_string(b.t, ' ')) AS distance
             FROM a JOIN b ON a.brand = b.brand
                AND levenshtein(array_to_string(a.t, ' '), array_to_string(b.t, ' ')) <= 1
        UNION ALL SELECT x.product_id, y.product_id, levenshtein(x.odd, y.odd)
             FROM odd_a AS x JOIN odd_b AS y ON x.brand = y.brand AND x.rest = y.rest AND levenshtein(x.odd, y.odd) <= 1)
    SELECT a.product_id, a.brand, match_id, CAST(distance AS INTEGER) AS distance
    FROM a LEFT JOIN near ON a.product_id = near.product_id
    QUALIFY row_number() OVER (PARTITION BY a.product_id ORDER BY distance, match_id) = 1""")
def match_products(spark, d):
    """The own range against a competitor range with misspelt names, some of which sort otherwise."""
    own = fx.products(spark, d).select("product_id", "brand", "name")
    kind = F.col("category")
    other = fx.products(spark, d).select(
        "product_id", "brand", F.when(kind.isin("SMALL", "LARGE"), F.replace("name", F.lit("a"), F.lit("")))
        .when(kind == "PROMO", F.concat(F.lit("x"), "name")).when(kind == "MEDIUM", F.concat("name", F.lit("xyz")))
        .otherwise(F.col("name")).alias("name"))
    return normalize.match_products(own, other, "brand", 1)
