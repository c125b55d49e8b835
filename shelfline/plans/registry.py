"""Registry of queries and, where SQL can say the same, their oracle SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.functions.numbers import tidy
from shelfline.session import settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Shared CTEs of the oracle SQL, the same mapping as plans.fixtures.
CTES = {
    "obs": """SELECT l_partkey AS product_id, l_suppkey % 5 AS retailer_id,
        l_shipdate AS observed_at, l_extendedprice / l_quantity AS price,
        l_orderkey AS order_id, l_linenumber AS line_no FROM lineitem""",
    "product": """SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand,
        p_type AS category, p_retailprice AS list_price, p_size AS pack_size FROM part""",
    "sale": """SELECT l_orderkey AS order_id, l_linenumber AS line_no,
        l_partkey AS product_id, l_suppkey % 5 AS retailer_id, l_shipdate AS sold_at,
        l_quantity AS qty, l_extendedprice AS amount, l_discount AS discount,
        p_retailprice * (1 - l_discount) AS net_price, l_discount > 0 AS is_promo,
        p_type AS category, p_brand AS brand FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "cur": """SELECT * FROM obs QUALIFY row_number() OVER (
        PARTITION BY product_id, retailer_id
        ORDER BY observed_at DESC, order_id DESC, line_no DESC, price DESC) = 1""",
    "market": """SELECT category, date_trunc('month', observed_at) AS month,
        avg(price) AS market_price FROM obs JOIN product USING (product_id)
        WHERE retailer_id <> 0 GROUP BY ALL""",
    "gap": """SELECT product_id, max(price) FILTER (retailer_id = 0) AS own_price,
        count(price) FILTER (retailer_id <> 0) AS n_competitors,
        min(price) FILTER (retailer_id <> 0) AS competitor_min,
        avg(price) FILTER (retailer_id <> 0) AS competitor_avg,
        max(price) FILTER (retailer_id <> 0) AS competitor_max,
        (max(price) FILTER (retailer_id = 0) - avg(price) FILTER (retailer_id <> 0))
            / avg(price) FILTER (retailer_id <> 0) AS gap
        FROM cur GROUP BY product_id
        HAVING own_price IS NOT NULL AND n_competitors > 0""",
    "moves": """SELECT * FROM (SELECT *,
        lag(price) OVER w AS old_price, lag(observed_at) OVER w AS old_at FROM obs
        WINDOW w AS (PARTITION BY product_id, retailer_id
                     ORDER BY observed_at, order_id, line_no, price)) AS m
        WHERE old_price IS NOT NULL""",
    "history": """SELECT product_id, retailer_id, price, observed_at AS valid_from,
        lead(observed_at) OVER (PARTITION BY product_id, retailer_id ORDER BY observed_at) AS valid_to
        FROM (SELECT *, lag(price) OVER (PARTITION BY product_id, retailer_id
                                         ORDER BY observed_at) AS old
              FROM (SELECT * FROM obs QUALIFY row_number() OVER (
                        PARTITION BY product_id, retailer_id, observed_at
                        ORDER BY order_id DESC, line_no DESC, price DESC) = 1) AS ends) AS steps
        WHERE old IS NULL OR old <> price""",
    "totals": """SELECT product_id, category, sum(qty) AS units,
        CAST(sum(CAST(qty * net_price AS DECIMAL(20,6))) AS DOUBLE) AS revenue,
        CAST(sum(CAST(qty * net_price AS DECIMAL(20,6))) AS DOUBLE) / sum(qty) AS paid_price
        FROM sale GROUP BY product_id, category""",
    "elas": """SELECT category, regr_slope(ln(qty), ln(net_price)) AS elasticity,
        regr_r2(ln(qty), ln(net_price)) AS r2, regr_count(ln(qty), ln(net_price)) AS n
        FROM sale WHERE qty > 0 AND net_price > 0 GROUP BY category""",
    "base": """SELECT category, avg(net_price) AS base_price, sum(qty) AS base_units,
        any_value(elasticity) AS elasticity FROM sale JOIN elas USING (category)
        GROUP BY category""",
    "rfm": """SELECT product_id, date_diff('day', max(sold_at), DATE '2001-12-31') AS recency,
        count(DISTINCT order_id) AS frequency,
        CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS monetary
        FROM sale GROUP BY product_id""",
    "scored": """SELECT *, CAST(ntile(5) OVER (ORDER BY recency DESC, product_id) AS INTEGER) AS r_score,
        CAST(ntile(5) OVER (ORDER BY frequency, product_id) AS INTEGER) AS f_score,
        CAST(ntile(5) OVER (ORDER BY monetary, product_id) AS INTEGER) AS m_score FROM rfm""",
    "promo": """SELECT category || '-' || strftime(date_trunc('month', sold_at), '%Y%m') AS promo_id,
        category, floor(avg(discount) * 10000 + 0.50001) / 10000 AS depth,
        date_trunc('month', sold_at) AS start_at,
        date_trunc('month', sold_at) + INTERVAL 1 MONTH AS end_at
        FROM sale WHERE is_promo GROUP BY category, date_trunc('month', sold_at)""",
    "event": """SELECT event_id, ts AS event_time,
        CASE event_type WHEN 'purchase' THEN 'price-changes' WHEN 'click' THEN 'promotion-events'
             ELSE 'market-trends' END AS topic,
        user_id AS product_id, event_id % 5 AS retailer_id, value AS new_price, props AS payload
        FROM events WHERE event_type IN ('purchase', 'click', 'view')""",
}
_NEEDS = {
    "cur": ["obs"], "market": ["obs", "product"], "gap": ["obs", "cur"], "moves": ["obs"],
    "history": ["obs"], "totals": ["sale"], "elas": ["sale"], "base": ["sale", "elas"],
    "rfm": ["sale"], "scored": ["sale", "rfm"], "promo": ["sale"],
}


def sql(needs: str, body: str) -> str:
    """Oracle SQL: the named CTEs with those they need, then the body.

    ``T(expr)`` is written for the rounding of ``tidy`` and replaced here.
    """
    names: list[str] = []
    for name in needs.split():
        for part in [*_NEEDS.get(name, []), name]:
            if part not in names:
                names.append(part)
    ctes = ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    return f"WITH {ctes}\n{_rounded(body)}" if names else _rounded(body)


def _rounded(body: str) -> str:
    """Replace each T(expr) by the tie-free rounding to four digits."""
    while mark := re.search(r"\bT\(", body):
        start, end = mark.span()
        depth = 1
        while depth:
            depth += {"(": 1, ")": -1}.get(body[end], 0)
            end += 1
        inner = body[start + 2:end - 1]
        body = f"{body[:start]}floor(({inner}) * 10000 + 0.50001) / 10000{body[end:]}"
    return body


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``; the session is settled before it runs."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(settle(spark), sf_dir)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Output form: the named columns rounded by ``tidy``."""
    return df.withColumns({c: tidy(F.col(c)) for c in columns})


def day(column: str | Column) -> Column:
    """A date as text, so both engines print it alike."""
    return F.date_format(column, "yyyy-MM-dd")


def second(column: str | Column) -> Column:
    """A time as text to the second."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
