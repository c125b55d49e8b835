"""Registered promotion, product, optimisation and serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.numbers import tidy
from shelfline.operators import optimize, price, product, promo, rfm, serve
from shelfline.plans import fixtures as fx, jobs
from shelfline.plans.price_queries import AS_OF
from shelfline.plans.registry import day, query, rounded, sql
from shelfline.session import scratch

_REVENUE = "CAST(sum(CAST(qty * net_price AS DECIMAL(20,6))) AS DOUBLE)"


@query("promotions", sql("promo", """
    SELECT promo_id, category, depth, strftime(start_at, '%Y-%m-%d') AS start_on,
           strftime(end_at, '%Y-%m-%d') AS end_on FROM promo"""))
def promotions(spark, d):
    found = fx.promotions(fx.sales(spark, d))
    return found.select("promo_id", "category", "depth", day("start_at").alias("start_on"),
                        day("end_at").alias("end_on"))


# Campaigns of ten weeks that start each quarter, so neighbours overlap in no month
# but each spans three of them.
_CAMPAIGN_SQL = """campaign AS (SELECT category || '-Q' || strftime(start_at, '%Y%m') AS promo_id,
        category, 0.05 AS depth, start_at + INTERVAL 10 DAY AS start_at,
        start_at + INTERVAL 80 DAY AS end_at
        FROM (SELECT DISTINCT category, date_trunc('quarter', sold_at) AS start_at FROM sale) AS q)
    """


def _campaigns(sold):
    quarter = F.date_trunc("quarter", "sold_at")
    return (sold.select("category", quarter.alias("q")).distinct()
            .select(F.concat(F.col("category"), F.lit("-Q"), F.date_format("q", "yyyyMM"))
                    .alias("promo_id"), "category", F.lit(0.05).alias("depth"),
                    (F.col("q") + F.expr("INTERVAL 10 DAY")).alias("start_at"),
                    (F.col("q") + F.expr("INTERVAL 80 DAY")).alias("end_at")))


@query("attribute", sql("sale", f""", {_CAMPAIGN_SQL}
    SELECT order_id, line_no, product_id, category, promo_id, T(amount) AS amount
    FROM sale JOIN campaign USING (category)
    WHERE is_promo AND sold_at >= start_at AND sold_at < end_at"""))
def attribute(spark, d):
    sold = fx.sales(spark, d)
    return rounded(promo.attribute(sold, _campaigns(sold)), "amount").select(
        "order_id", "line_no", "product_id", "category", "promo_id", "amount")


@query("promo_performance", sql("promo", f"""
    SELECT promo_id, category, count(*) AS n_lines, sum(qty) AS units, T({_REVENUE}) AS revenue,
           count(DISTINCT order_id) AS orders
    FROM sale JOIN promo USING (category)
    WHERE is_promo AND sold_at >= start_at AND sold_at < end_at GROUP BY promo_id, category"""))
def promo_performance(spark, d):
    sold = fx.sales(spark, d)
    return rounded(promo.promo_performance(sold, fx.promotions(sold)), "revenue")


_UPLIFT = """SELECT category, count(*) FILTER (is_promo) AS n_promo,
    count(*) FILTER (NOT is_promo) AS n_base, avg(qty) FILTER (is_promo) AS promo_qty,
    avg(qty) FILTER (NOT is_promo) AS base_qty,
    avg(qty) FILTER (is_promo) / avg(qty) FILTER (NOT is_promo) - 1 AS uplift
    FROM sale GROUP BY category"""


@query("promo_uplift", sql("sale", f"""
    SELECT category, n_promo, n_base, T(promo_qty) AS promo_qty, T(base_qty) AS base_qty,
           T(uplift) AS uplift FROM ({_UPLIFT}) AS u"""))
def promo_uplift(spark, d):
    return rounded(promo.promo_uplift(fx.sales(spark, d)), "promo_qty", "base_qty", "uplift")


_ROI = """SELECT category, base_qty, earned - base_qty * per_unit AS incremental_margin,
    discount_cost, (earned - base_qty * per_unit - discount_cost) / discount_cost AS roi
    FROM (SELECT category, avg(qty) FILTER (NOT is_promo) AS base_qty,
                 sum(qty * (net_price - 0.7e0 * listed)) FILTER (is_promo) AS earned,
                 sum(net_price - 0.7e0 * listed) FILTER (is_promo) AS per_unit,
                 sum(qty * listed * discount) FILTER (is_promo) AS discount_cost
          FROM (SELECT *, net_price / (1 - discount) AS listed FROM sale) AS l
          GROUP BY category) AS s"""


@query("promo_roi", sql("sale", f"""
    SELECT category, T(base_qty) AS base_qty,
           floor(incremental_margin * 100 + 0.50001) / 100 AS incremental_margin,
           floor(discount_cost * 100 + 0.50001) / 100 AS discount_cost, T(roi) AS roi
    FROM ({_ROI}) AS r"""))
def promo_roi(spark, d):
    out = rounded(promo.promo_roi(fx.sales(spark, d)), "base_qty", "roi")
    return out.withColumns({c: tidy(F.col(c), 2) for c in ("incremental_margin", "discount_cost")})


@query("promo_forecast", sql("sale", """
    SELECT category, depth, T(slope) AS slope, T(intercept) AS intercept, CAST(n AS BIGINT) AS n,
           T(intercept + slope * depth) AS predicted_qty
    FROM (SELECT category, regr_slope(qty, discount) AS slope,
                 regr_intercept(qty, discount) AS intercept, regr_count(qty, discount) AS n
          FROM sale GROUP BY category) AS f,
         (SELECT unnest([0.05e0, 0.15e0, 0.25e0]) AS depth) AS p"""))
def promo_forecast(spark, d):
    plan = fx.products(spark, d).select("category").distinct().withColumn(
        "depth", F.explode(F.array(F.lit(0.05), F.lit(0.15), F.lit(0.25))))
    return rounded(promo.promo_forecast(fx.sales(spark, d), plan),
                   "slope", "intercept", "predicted_qty")


@query("promo_cube", sql("sale", f"""
    SELECT category, discount AS depth, CAST(grouping(category, discount) AS INTEGER) AS level,
           count(*) AS n, sum(qty) AS units, T({_REVENUE}) AS revenue
    FROM sale GROUP BY CUBE (category, discount)"""))
def promo_cube(spark, d):
    return rounded(promo.promo_cube(fx.sales(spark, d)), "revenue")


EDGES = (870.0, 890.0, 910.0, 930.0, 950.0)


def _band_sql(column: str, edges=EDGES) -> str:
    return " + ".join(f"CAST({column} >= {e}e0 AS INTEGER)" for e in edges)


@query("price_band", f"""
    SELECT p_partkey AS product_id, p_retailprice AS list_price,
           {_band_sql("p_retailprice")} AS band FROM part""")
def price_band(spark, d):
    return product.price_band(fx.products(spark, d).select("product_id", "list_price"),
                              "list_price", EDGES)


@query("price_band_quantiles", sql("obs", """
    SELECT order_id, line_no, product_id, T(price) AS price,
           CAST(price >= e[1] AS INTEGER) + CAST(price >= e[2] AS INTEGER)
           + CAST(price >= e[3] AS INTEGER) AS band
    FROM obs, (SELECT quantile_cont(price, [0.25, 0.5, 0.75]) AS e FROM obs) AS q"""))
def price_band_quantiles(spark, d):
    obs = fx.observations(spark, d).select("order_id", "line_no", "product_id", "price")
    edges = product.quantile_edges(obs, "price", 4)
    return rounded(product.price_band(obs, "price", edges), "price")


_TOTAL = "units, T(revenue) AS revenue, T(paid_price) AS paid_price"


@query("best_sellers", sql("totals", f"""
    SELECT product_id, category, {_TOTAL}, CAST(place AS INTEGER) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY category
                                       ORDER BY units DESC, product_id) AS place FROM totals) AS t
    WHERE place <= 10"""))
def best_sellers(spark, d):
    return rounded(product.best_sellers(fx.sales(spark, d), 10), "revenue", "paid_price")


@query("top_products", sql("totals", f"""
    SELECT product_id, category, {_TOTAL} FROM totals ORDER BY units DESC, product_id LIMIT 20"""))
def top_products(spark, d):
    """A top-k report: the limit is the feature."""
    return rounded(product.top_products(fx.sales(spark, d), 20), "revenue", "paid_price")


@query("best_seller_share", sql("totals", f"""
    SELECT band, count(*) AS products, count(*) FILTER (place <= 20) AS best_sellers,
           T(count(*) FILTER (place <= 20) / count(*)) AS share
    FROM (SELECT *, {_band_sql("paid_price")} AS band,
                 row_number() OVER (PARTITION BY category ORDER BY units DESC, product_id) AS place
          FROM totals) AS t GROUP BY band"""))
def best_seller_share(spark, d):
    return rounded(product.best_seller_share(fx.sales(spark, d), 20, EDGES), "share")


@query("product_performance", sql("totals", f"""
    SELECT product_id, category, {_TOTAL}, CAST(place AS BIGINT) AS place, T(share) AS share,
           T(cumulative_share) AS cumulative_share
    FROM (SELECT *, row_number() OVER w AS place,
                 revenue / sum(CAST(revenue AS DECIMAL(28,6))) OVER () AS share,
                 CAST(sum(CAST(revenue AS DECIMAL(28,6))) OVER w AS DOUBLE)
                 / CAST(sum(CAST(revenue AS DECIMAL(28,6))) OVER () AS DOUBLE) AS cumulative_share
          FROM totals WINDOW w AS (ORDER BY revenue DESC, product_id)) AS t"""))
def product_performance(spark, d):
    return rounded(product.product_performance(fx.sales(spark, d)),
                   "revenue", "paid_price", "share", "cumulative_share")


@query("price_demand_corr", sql("sale", """
    SELECT category, count(*) AS n, T(corr(net_price, qty)) AS corr,
           T(covar_samp(net_price, qty)) AS covar FROM sale GROUP BY category"""))
def price_demand_corr(spark, d):
    return rounded(product.price_demand_corr(fx.sales(spark, d)), "corr", "covar")


@query("demand_forecast", sql("elas", """
    SELECT category, T(base_qty) AS base_qty, T(elasticity) AS elasticity, delta,
           T(base_qty * pow(1 + delta, elasticity)) AS forecast_qty
    FROM (SELECT category, avg(qty) AS base_qty FROM sale GROUP BY category) AS b
    JOIN elas USING (category), (SELECT unnest([-0.1e0, -0.05e0, 0.05e0, 0.1e0]) AS delta) AS x"""))
def demand_forecast(spark, d):
    out = product.demand_forecast(fx.sales(spark, d), [-0.1, -0.05, 0.05, 0.1])
    return rounded(out, "base_qty", "elasticity", "forecast_qty")


# Normal equations of qty on (net_price, discount, month), centred, solved by Cramer's rule.
_DEMAND_SQL = """, x AS (SELECT *, CAST(month(sold_at) AS DOUBLE) AS m FROM sale),
    c AS (SELECT avg(qty) AS my, avg(net_price) AS m1, avg(discount) AS m2, avg(m) AS m3,
        var_pop(net_price) AS s11, var_pop(discount) AS s22, var_pop(m) AS s33,
        covar_pop(net_price, discount) AS s12, covar_pop(net_price, m) AS s13,
        covar_pop(discount, m) AS s23, covar_pop(net_price, qty) AS s1,
        covar_pop(discount, qty) AS s2, covar_pop(m, qty) AS s3 FROM x),
    det AS (SELECT *, s11 * (s22 * s33 - s23 * s23) - s12 * (s12 * s33 - s23 * s13)
                      + s13 * (s12 * s23 - s22 * s13) AS det FROM c),
    fit AS (SELECT *, (s1 * (s22 * s33 - s23 * s23) - s12 * (s2 * s33 - s23 * s3)
                       + s13 * (s2 * s23 - s22 * s3)) / det AS b1,
        (s11 * (s2 * s33 - s23 * s3) - s1 * (s12 * s33 - s23 * s13)
         + s13 * (s12 * s3 - s2 * s13)) / det AS b2,
        (s11 * (s22 * s3 - s2 * s23) - s12 * (s12 * s3 - s2 * s13)
         + s1 * (s12 * s23 - s22 * s13)) / det AS b3 FROM det),
    p AS (SELECT category, qty, my + b1 * (net_price - m1) + b2 * (discount - m2) + b3 * (m - m3)
                 AS prediction FROM x, fit)"""


@query("demand_model", sql("sale", _DEMAND_SQL + """
    SELECT category, count(*) AS n, T(avg(qty)) AS avg_qty, T(avg(prediction)) AS avg_prediction,
           T(sqrt(avg((prediction - qty) * (prediction - qty)))) AS rmse FROM p GROUP BY category"""))
def demand_model(spark, d):
    sold = fx.sales(spark, d)
    out = product.demand_fit_by_category(sold, product.fit_demand(sold))
    return rounded(out, "avg_qty", "avg_prediction", "rmse")


def _impact_sql(delta: str) -> str:
    """Adjustment columns from a row of ``base``."""
    units = f"base_units * pow(1 + {delta}, elasticity)"
    new = f"base_price * (1 + {delta})"
    two = lambda x, name: f"floor(({x}) * 100 + 0.50001) / 100 AS {name}"
    return ", ".join([
        "T(base_price) AS base_price", "base_units", "T(elasticity) AS elasticity",
        f"T({new}) AS new_price", two(units, "units"), two(f"{new} * {units}", "revenue"),
        two(f"({new} - 0.7e0 * base_price) * {units}", "margin"),
        two(f"{units} - base_units", "units_change"),
        two(f"{new} * {units} - base_price * base_units", "revenue_change"),
        two(f"({new} - 0.7e0 * base_price) * {units} - 0.3e0 * base_price * base_units",
            "margin_change")])


def _impact_out(df):
    out = rounded(df, "base_price", "elasticity", "new_price")
    return out.withColumns({c: tidy(F.col(c), 2) for c in (
        "units", "revenue", "margin", "units_change", "revenue_change", "margin_change")})


@query("adjustment_impact", sql("base", f"SELECT category, {_impact_sql('0.05e0')} FROM base"))
def adjustment_impact(spark, d):
    return _impact_out(optimize.adjustment_impact(optimize.price_base(fx.sales(spark, d)), 0.05))


SCENARIOS = {"cut": -0.1, "trim": -0.05, "keep": 0.0, "lift": 0.05}


@query("what_if", sql("base", f"""
    SELECT category, scenario, delta, {_impact_sql('delta')}
    FROM base, (SELECT * FROM (VALUES ('cut', -0.1e0), ('trim', -0.05e0), ('keep', 0e0),
                                      ('lift', 0.05e0)) AS v (scenario, delta)) AS s"""))
def what_if(spark, d):
    return _impact_out(optimize.what_if(optimize.price_base(fx.sales(spark, d)), SCENARIOS))


_OPTIMAL = """SELECT category, base_price, best.delta AS best_delta,
    base_price * (1 + best.delta) AS best_price, best.margin AS best_margin
    FROM (SELECT category, base_price, max({'margin': (base_price * (1 + i * 0.01e0)
                 - 0.7e0 * base_price) * base_units * pow(1 + i * 0.01e0, elasticity),
                 'closeness': -abs(i), 'delta': i * 0.01e0}) AS best
          FROM base, (SELECT unnest(range(-20, 21)) AS i) AS g GROUP BY category, base_price) AS o"""


@query("optimal_price", sql("base", f"""
    SELECT category, T(base_price) AS base_price, T(best_delta) AS best_delta,
           T(best_price) AS best_price, floor(best_margin * 100 + 0.50001) / 100 AS best_margin
    FROM ({_OPTIMAL}) AS b"""))
def optimal_price(spark, d):
    out = optimize.optimal_price(optimize.price_base(fx.sales(spark, d)))
    return rounded(out, "base_price", "best_delta", "best_price").withColumn(
        "best_margin", tidy(F.col("best_margin"), 2)).drop("base_units", "elasticity")


_RECOMMEND = f"""opt AS ({_OPTIMAL}),
    pos AS (SELECT category, sum(own * n) / sum(market_price * n) - 1 AS market_gap
            FROM (SELECT category, date_trunc('month', observed_at) AS month, avg(price) AS own,
                         count(price) AS n FROM obs JOIN product USING (product_id)
                  WHERE retailer_id = 0 GROUP BY ALL) AS mine
            JOIN market USING (category, month) GROUP BY category),
    votes AS (SELECT g.*, category, best_delta,
        CASE WHEN gap > 0.05e0 THEN -1 WHEN gap < -0.05e0 THEN 1 ELSE 0 END
        + CASE WHEN market_gap > 0.05e0 THEN -1 WHEN market_gap < -0.05e0 THEN 1 ELSE 0 END
        + CAST(coalesce(sign(best_delta), 0) AS INTEGER) AS votes
        FROM gap AS g JOIN product USING (product_id) JOIN opt USING (category)
        JOIN pos USING (category)),
    rec AS (SELECT *, CASE way WHEN 1 THEN 'raise' WHEN -1 THEN 'lower' ELSE 'hold' END AS action,
        own_price * (1 + way * CASE WHEN sign(best_delta) = way THEN abs(best_delta)
                                    ELSE 0.05e0 END) AS suggested_price
        FROM (SELECT *, CASE WHEN votes >= 2 THEN 1 WHEN votes <= -2 THEN -1 ELSE 0 END AS way
              FROM votes) AS v)"""


def _recommended(spark, d):
    obs, listed = fx.observations(spark, d), fx.products(spark, d)
    by_month = price.vs_market(obs, fx.market(spark, d), fx.OWN, listed)
    return optimize.recommend(
        price.price_gap(price.current_price(obs), fx.OWN), listed,
        optimize.optimal_price(optimize.price_base(fx.sales(spark, d))),
        optimize.market_position(by_month))


@query("recommend", sql("gap product market base", f""", {_RECOMMEND}
    SELECT product_id, category, T(own_price) AS own_price, T(gap) AS gap,
           CAST(votes AS INTEGER) AS votes, action, T(suggested_price) AS suggested_price
    FROM rec"""))
def recommend(spark, d):
    return rounded(_recommended(spark, d), "own_price", "gap", "suggested_price").select(
        "product_id", "category", "own_price", "gap", "votes", "action", "suggested_price")


@query("backtest", sql("sale", """, train AS (SELECT category, avg(net_price) AS p, avg(qty) AS q,
        regr_slope(ln(qty), ln(net_price)) AS e FROM sale
        WHERE sold_at < TIMESTAMP '2000-01-01' GROUP BY category),
    scored AS (SELECT category, qty, q * pow(net_price / p, e) - qty AS error
        FROM sale JOIN train USING (category) WHERE sold_at >= TIMESTAMP '2000-01-01')
    SELECT category, count(*) AS n, T(avg(abs(error))) AS mae, T(avg(abs(error) / qty)) AS mape,
           T(avg(error)) AS bias FROM scored GROUP BY category"""))
def backtest(spark, d):
    return rounded(optimize.backtest(fx.sales(spark, d), "2000-01-01"), "mae", "mape", "bias")


@query("price_kpis", sql("gap product market base", f""", {_RECOMMEND}
    SELECT product_id, category, T(own_price) AS own_price, T(competitor_avg) AS competitor_avg,
           T(gap) AS gap, T(category_avg) AS category_avg, action,
           T(suggested_price) AS suggested_price
    FROM rec JOIN (SELECT category, avg(price) AS category_avg FROM obs
                   JOIN product USING (product_id) GROUP BY category) AS c USING (category)
    WHERE category = 'ECONOMY' AND abs(gap) >= 0.1 ORDER BY rec.gap DESC, product_id LIMIT 50"""))
def price_kpis(spark, d):
    """The price interface's result: filtered, sorted and limited as its caller asks."""
    levels = price.category_prices(fx.observations(spark, d), fx.products(spark, d))
    out = serve.price_kpis(_recommended(spark, d), levels, category="ECONOMY", min_gap=0.1,
                           limit=50)
    return rounded(out, "own_price", "competitor_avg", "gap", "category_avg", "suggested_price")


@query("promotion_kpis", sql("promo", f""", u AS ({_UPLIFT}), r AS ({_ROI})
    SELECT promo_id, category, n_lines, units, T(revenue) AS revenue, orders, T(uplift) AS uplift,
           n_base, T(roi) AS roi
    FROM (SELECT promo_id, category, count(*) AS n_lines, sum(qty) AS units,
                 {_REVENUE} AS revenue, count(DISTINCT order_id) AS orders
          FROM sale JOIN promo USING (category)
          WHERE is_promo AND sold_at >= start_at AND sold_at < end_at
          GROUP BY promo_id, category) AS p JOIN u USING (category) JOIN r USING (category)"""))
def promotion_kpis(spark, d):
    sold = fx.sales(spark, d)
    out = serve.promotion_kpis(promo.promo_performance(sold, fx.promotions(sold)),
                               promo.promo_uplift(sold), promo.promo_roi(sold))
    return rounded(out, "revenue", "uplift", "roi")


@query("product_kpis", sql("totals scored", """
    SELECT product_id, category, units, T(revenue) AS revenue, T(paid_price) AS paid_price,
           CAST(place AS BIGINT) AS place, T(share) AS share,
           T(cumulative_share) AS cumulative_share, r_score, f_score, m_score,
           CAST(CASE WHEN best <= 10 THEN best END AS INTEGER) AS best_seller_place
    FROM (SELECT *, row_number() OVER w AS place,
                 revenue / sum(CAST(revenue AS DECIMAL(28,6))) OVER () AS share,
                 CAST(sum(CAST(revenue AS DECIMAL(28,6))) OVER w AS DOUBLE)
                 / CAST(sum(CAST(revenue AS DECIMAL(28,6))) OVER () AS DOUBLE) AS cumulative_share,
                 row_number() OVER (PARTITION BY category ORDER BY units DESC, product_id) AS best
          FROM totals WINDOW w AS (ORDER BY revenue DESC, product_id)) AS t
    JOIN scored USING (product_id)"""))
def product_kpis(spark, d):
    sold = fx.sales(spark, d)
    out = serve.product_kpis(product.product_performance(sold),
                             rfm.rfm_score(rfm.rfm(fx.sale_lines(spark, d), AS_OF)), product.best_sellers(sold, 10))
    return rounded(out, "revenue", "paid_price", "share", "cumulative_share")


@query("executive_summary", sql("sale", "SELECT kpi, period, T(value) AS value FROM (" + " UNION ALL ".join(
    f"""SELECT unnest(['lines', 'units', 'amount', 'average_paid_price', 'promo_share']) AS kpi, period,
    unnest([CAST(n AS DOUBLE), units, amount, paid, promo]) AS value
    FROM (SELECT strftime(sold_at, '{form}') AS period, count(*) AS n, sum(qty) AS units,
          CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount, avg(net_price) AS paid,
          avg(CASE WHEN is_promo THEN 1e0 ELSE 0e0 END) AS promo FROM sale GROUP BY period) AS g"""
    for form in ("%Y-%m", "%Y")) + ") AS x"))
def executive_summary(spark, d):
    return rounded(serve.executive_summary(fx.sales(spark, d)), "value")


@query("custom_report", sql("sale", """
    SELECT category, strftime(sold_at, '%Y-%m') AS month, count(*) AS lines, sum(qty) AS units,
           T(CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)) AS amount,
           count(DISTINCT order_id) AS orders,
           T(avg(CASE WHEN is_promo THEN 1e0 ELSE 0e0 END)) AS promo_share
    FROM sale WHERE sold_at >= TIMESTAMP '1998-01-01' AND sold_at < TIMESTAMP '2000-01-01'
      AND retailer_id IN (0, 1) GROUP BY category, month"""))
def custom_report(spark, d):
    out = serve.custom_report(fx.sales(spark, d), ["category", "month"],
                              ["lines", "units", "amount", "orders", "promo_share"],
                              {"retailer_id": [0, 1]}, "1998-01-01", "2000-01-01")
    return rounded(out, "amount", "promo_share")


def _lake(spark, d):
    """Bronze, silver and gold built by the jobs, bronze in two runs that deliver the same rows."""
    root = scratch(spark)
    jobs.load_bronze(spark, d, root, "run-1")
    jobs.deliver_again(spark, root, "run-1", "run-2")
    jobs.build_silver(spark, root, "run-2")
    jobs.build_gold(spark, root, AS_OF)
    return root


@query("silver_prices", sql("obs", """
    SELECT product_id, retailer_id, strftime(observed_at, '%Y-%m-%d') AS observed_on, T(price) AS price,
           order_id, line_no FROM obs"""))
def silver_prices(spark, d):
    """Prices of all retailers as the jobs bring them to silver."""
    root = scratch(spark)
    jobs.load_bronze(spark, d, root, "run-1")
    jobs.deliver_again(spark, root, "run-1", "run-2")
    jobs.build_silver(spark, root, "run-2")
    found = rounded(jobs.silver_prices(spark, root), "price")
    return found.withColumn("observed_on", day("observed_at")).drop("observed_at")


@query("gold_recommendations", sql("gap product market base", f""", {_RECOMMEND}
    SELECT product_id, category, T(own_price) AS own_price, T(gap) AS gap,
           CAST(votes AS INTEGER) AS votes, action, T(suggested_price) AS suggested_price
    FROM rec"""))
def gold_recommendations(spark, d):
    """Recommendations as they lie in gold after the jobs have run."""
    found = jobs.gold(spark, _lake(spark, d), "price_analytics", "recommendations")
    return rounded(found, "own_price", "gap", "suggested_price").select(
        "product_id", "category", "own_price", "gap", "votes", "action", "suggested_price")


@query("kpis_from_gold", sql("gap product market base", f""", {_RECOMMEND}
    SELECT product_id, category, T(own_price) AS own_price, T(competitor_avg) AS competitor_avg,
           T(gap) AS gap, T(category_avg) AS category_avg, action,
           T(suggested_price) AS suggested_price
    FROM rec JOIN (SELECT category, avg(price) AS category_avg FROM obs
                   JOIN product USING (product_id) GROUP BY category) AS c USING (category)"""))
def kpis_from_gold(spark, d):
    """The price interface answered from gold tables alone."""
    out = jobs.price_kpis(spark, _lake(spark, d))
    return rounded(out, "own_price", "competitor_avg", "gap", "category_avg", "suggested_price")


@query("cached_result", sql("elas", """
    SELECT category, T(elasticity) AS elasticity, CAST(n AS BIGINT) AS n FROM elas"""))
def cached_result(spark, d):
    """The same result set asked for twice; the second time it is read from the cache."""
    root = scratch(spark)
    for _ in range(2):
        found = serve.cached_result(price.elasticity(fx.sales(spark, d)).select("category", "elasticity", "n"),
                                    root, "elasticity")
    return rounded(found, "elasticity")


@query("price_kpis_retailer", sql("gap product market base cur", f""", {_RECOMMEND}
    SELECT product_id, category, T(own_price) AS own_price, T(competitor_avg) AS competitor_avg,
           T(gap) AS gap, T(category_avg) AS category_avg, action, T(suggested_price) AS suggested_price,
           T(price) AS retailer_price, T((own_price - price) / price) AS retailer_gap
    FROM rec JOIN (SELECT category, avg(price) AS category_avg FROM obs
                   JOIN product USING (product_id) GROUP BY category) AS c USING (category)
         JOIN (SELECT product_id, price FROM cur WHERE retailer_id = 2) AS r USING (product_id)"""))
def price_kpis_retailer(spark, d):
    """The price interface's result against one competitor."""
    obs = fx.observations(spark, d)
    out = serve.price_kpis(_recommended(spark, d), price.category_prices(obs, fx.products(spark, d)),
                           retailer=2, current=price.current_price(obs))
    return rounded(out, "own_price", "competitor_avg", "gap", "category_avg", "suggested_price",
                   "retailer_price", "retailer_gap")


@query("product_kpis_banded", sql("totals", f"""
    , placed AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY units DESC, product_id) AS best,
                 {_band_sql("paid_price")} AS band FROM totals)
    SELECT product_id, category, units, T(revenue) AS revenue, CAST(band AS INTEGER) AS band,
           T(avg(CASE WHEN best <= 10 THEN 1e0 ELSE 0e0 END) OVER (PARTITION BY band)) AS band_best_seller_share
    FROM placed"""))
def product_kpis_banded(spark, d):
    """The product interface's result with price bands and how many of a band sell best."""
    sold = fx.sales(spark, d)
    out = serve.product_kpis(product.product_performance(sold),
                             rfm.rfm_score(rfm.rfm(fx.sale_lines(spark, d), AS_OF)), product.best_sellers(sold, 10),
                             edges=EDGES, shares=product.best_seller_share(sold, 10, EDGES))
    return rounded(out, "revenue", "band_best_seller_share").select(
        "product_id", "category", "units", "revenue", "band", "band_best_seller_share")


@query("cached", sql("elas", """
    SELECT category, T(elasticity) AS elasticity, CAST(n AS BIGINT) AS n FROM elas"""))
def cached(spark, d):
    serve.cached(price.elasticity(fx.sales(spark, d)).select("category", "elasticity", "n"),
                 "cached_elasticity")
    return rounded(spark.table("cached_elasticity"), "elasticity")
