"""Registered price and product-value queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.operators import price, rfm
from shelfline.plans import fixtures as fx
from shelfline.plans.registry import day, query, rounded, sql


@query("current_price", sql("cur", """
    SELECT product_id, retailer_id, strftime(observed_at, '%Y-%m-%d') AS observed_on,
           T(price) AS price, order_id, line_no FROM cur"""))
def current_price(spark, d):
    cur = price.current_price(fx.observations(spark, d))
    return rounded(cur, "price").select("product_id", "retailer_id",
                                        day("observed_at").alias("observed_on"), "price",
                                        "order_id", "line_no")


@query("price_gap", sql("gap", """
    SELECT product_id, n_competitors, T(own_price) AS own_price,
           T(competitor_min) AS competitor_min, T(competitor_avg) AS competitor_avg,
           T(competitor_max) AS competitor_max, T(gap) AS gap FROM gap"""))
def price_gap(spark, d):
    gap = price.price_gap(price.current_price(fx.observations(spark, d)), fx.OWN)
    return rounded(gap, "own_price", "competitor_min", "competitor_avg", "competitor_max", "gap")


@query("price_rank", sql("cur", """
    SELECT product_id, T(price) AS price, price_rank, dense_price_rank,
           T(price_percent_rank) AS price_percent_rank
    FROM (SELECT product_id, retailer_id, price,
                 CAST(rank() OVER w AS INTEGER) AS price_rank,
                 CAST(dense_rank() OVER w AS INTEGER) AS dense_price_rank,
                 percent_rank() OVER w AS price_percent_rank
          FROM cur WINDOW w AS (PARTITION BY product_id ORDER BY price)) AS r
    WHERE retailer_id = 0"""))
def price_rank(spark, d):
    ranked = price.price_rank(price.current_price(fx.observations(spark, d)), fx.OWN)
    return rounded(ranked, "price", "price_percent_rank").drop("retailer_id")


@query("price_matrix", sql("cur", """
    SELECT product_id, """ + ", ".join(
        f"T(max(price) FILTER (retailer_id = {r})) AS retailer_{r}" for r in range(5)) + """
    FROM cur GROUP BY product_id"""))
def price_matrix(spark, d):
    retailers = [fx.OWN, *fx.COMPETITORS]
    wide = price.price_matrix(price.current_price(fx.observations(spark, d)), retailers)
    return rounded(wide, *[f"retailer_{r}" for r in retailers])


@query("category_prices", sql("obs product", """
    SELECT category, brand, CAST(grouping(category, brand) AS INTEGER) AS level, count(price) AS n,
           T(avg(price)) AS avg_price, T(min(price)) AS min_price, T(max(price)) AS max_price
    FROM obs JOIN product USING (product_id) GROUP BY ROLLUP (category, brand)"""))
def category_prices(spark, d):
    out = price.category_prices(fx.observations(spark, d), fx.products(spark, d))
    return rounded(out, "avg_price", "min_price", "max_price")


def _trend_sql(grain: str, moving: str) -> str:
    return sql("obs product", f"""
    SELECT category, strftime(period, '%Y-%m-%d') AS period, n, T(avg_price) AS avg_price,
           T(avg_price - lag(avg_price) OVER w) AS change,
           T((avg_price - lag(avg_price) OVER w) / lag(avg_price) OVER w) AS pct_change,
           T({moving}) AS moving_avg
    FROM (SELECT category, date_trunc('{grain}', observed_at) AS period, count(price) AS n,
                 avg(price) AS avg_price FROM obs JOIN product USING (product_id)
          GROUP BY ALL) AS p
    WINDOW w AS (PARTITION BY category ORDER BY period)""")


def _trend(spark, d, grain, k, frame):
    out = price.price_trend(fx.observations(spark, d), ["category"], grain, k, frame, fx.products(spark, d))
    out = rounded(out, "avg_price", "change", "pct_change", "moving_avg")
    return out.withColumn("period", day("period"))


@query("price_trend_monthly", _trend_sql("month", """avg(avg_price) OVER (
    PARTITION BY category ORDER BY period ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""))
def price_trend_monthly(spark, d):
    return _trend(spark, d, "month", 3, "rows")


@query("price_trend_weekly", _trend_sql("week", """avg(avg_price) OVER (
    PARTITION BY category ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"""))
def price_trend_weekly(spark, d):
    return _trend(spark, d, "week", 4, "rows")


@query("price_trend_daily", _trend_sql("day", """avg(avg_price) OVER (
    PARTITION BY category ORDER BY period
    RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"""))
def price_trend_daily(spark, d):
    return _trend(spark, d, "day", 7, "range")


_MOVE_COLUMNS = """SELECT product_id, retailer_id, order_id, line_no,
    strftime(observed_at, '%Y-%m-%d') AS observed_on, strftime(old_at, '%Y-%m-%d') AS old_on,
    T(old_price) AS old_price, T(price) AS price, T(price - old_price) AS change,
    T((price - old_price) / old_price) AS pct,
    CAST(sign(price - old_price) AS INTEGER) AS direction FROM moves"""


def _moves_out(moves):
    return rounded(moves, "old_price", "price", "change", "pct").select(
        "product_id", "retailer_id", "order_id", "line_no",
        day("observed_at").alias("observed_on"), day("old_at").alias("old_on"),
        "old_price", "price", "change", "pct", "direction")


@query("price_moves", sql("moves", _MOVE_COLUMNS))
def price_moves(spark, d):
    return _moves_out(price.price_moves(fx.observations(spark, d)))


@query("significant_moves", sql(
    "moves", _MOVE_COLUMNS + " WHERE abs((price - old_price) / old_price) >= 0.5"))
def significant_moves(spark, d):
    return _moves_out(price.significant_moves(
        price.price_moves(fx.observations(spark, d)), 0.5))


@query("price_history", sql("history", """
    SELECT product_id, retailer_id, T(price) AS price,
           strftime(valid_from, '%Y-%m-%d') AS valid_from,
           strftime(valid_to, '%Y-%m-%d') AS valid_to FROM history"""))
def price_history(spark, d):
    out = rounded(price.price_history(fx.observations(spark, d)), "price")
    return out.withColumns({c: day(c) for c in ("valid_from", "valid_to")})


@query("price_as_of", sql("history", """
    SELECT product_id, retailer_id, T(price) AS price,
           strftime(valid_from, '%Y-%m-%d') AS valid_from FROM history
    WHERE valid_from <= TIMESTAMP '1998-07-01'
      AND (valid_to IS NULL OR TIMESTAMP '1998-07-01' < valid_to)"""))
def price_as_of(spark, d):
    then = price.price_as_of(price.price_history(fx.observations(spark, d)), "1998-07-01")
    return rounded(then, "price").withColumn("valid_from", day("valid_from"))


@query("asof_price", sql("obs sale", """
    SELECT s.order_id, s.line_no, s.product_id, strftime(s.sold_at, '%Y-%m-%d') AS sold_on,
           T(s.net_price) AS net_price, T(c.price) AS competitor_price,
           c.retailer_id AS competitor_id, strftime(c.observed_at, '%Y-%m-%d') AS competitor_on
    FROM (SELECT * FROM sale WHERE retailer_id = 0) AS s
    ASOF LEFT JOIN (SELECT * FROM obs WHERE retailer_id <> 0 QUALIFY row_number() OVER (
        PARTITION BY product_id, observed_at
        ORDER BY order_id DESC, line_no DESC, price DESC) = 1) AS c
    ON s.product_id = c.product_id AND s.sold_at >= c.observed_at"""))
def asof_price(spark, d):
    found = price.asof_price(fx.sales(spark, d), fx.observations(spark, d), fx.OWN)
    return rounded(found, "net_price", "competitor_price").select(
        "order_id", "line_no", "product_id", day("sold_at").alias("sold_on"), "net_price",
        "competitor_price", "competitor_id", day("competitor_at").alias("competitor_on"))


@query("elasticity", sql("elas", """
    SELECT category, T(elasticity) AS elasticity, T(r2) AS r2, CAST(n AS BIGINT) AS n FROM elas"""))
def elasticity(spark, d):
    return rounded(price.elasticity(fx.sales(spark, d)), "elasticity", "r2")


@query("vs_market", sql("obs product market", """
    SELECT category, strftime(month, '%Y-%m-%d') AS month, n, T(own_price) AS own_price,
           T(market_price) AS market_price,
           T((own_price - market_price) / market_price) AS market_gap
    FROM (SELECT category, date_trunc('month', observed_at) AS month, avg(price) AS own_price,
                 count(price) AS n FROM obs JOIN product USING (product_id)
          WHERE retailer_id = 0 GROUP BY ALL) AS mine
    LEFT JOIN market USING (category, month)"""))
def vs_market(spark, d):
    out = price.vs_market(fx.observations(spark, d), fx.market(spark, d), fx.OWN, fx.products(spark, d))
    return rounded(out, "own_price", "market_price", "market_gap").withColumn("month", day("month"))


AS_OF = "2001-12-31"


@query("rfm", sql("rfm", """
    SELECT product_id, CAST(recency AS INTEGER) AS recency, frequency, T(monetary) AS monetary
    FROM rfm"""))
def rfm_values(spark, d):
    return rounded(rfm.rfm(fx.sale_lines(spark, d), AS_OF), "monetary")


@query("rfm_score", sql("scored", """
    SELECT product_id, CAST(recency AS INTEGER) AS recency, frequency, T(monetary) AS monetary,
           r_score, f_score, m_score FROM scored"""))
def rfm_score(spark, d):
    return rounded(rfm.rfm_score(rfm.rfm(fx.sale_lines(spark, d), AS_OF)), "monetary")


@query("rfm_segment", sql("scored", """
    SELECT segment, count(*) AS products,
           T(CAST(sum(CAST(monetary AS DECIMAL(18,2))) AS DOUBLE)) AS monetary
    FROM (SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'star'
                         WHEN f_score >= 4 AND r_score <= 2 THEN 'fading'
                         WHEN r_score >= 4 AND f_score <= 2 THEN 'rising'
                         WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'dormant'
                         ELSE 'steady' END AS segment FROM scored) AS s
    GROUP BY segment"""))
def rfm_segment(spark, d):
    scored = rfm.rfm_score(rfm.rfm(fx.sale_lines(spark, d), AS_OF))
    return rounded(rfm.segment_sizes(rfm.rfm_segment(scored)), "monetary")
