import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfline.functions.numbers import money_sum, tidy
from shelfline.functions.text import canonical_name, near_keys
from shelfline.operators import normalize
from shelfline.sources import pages


def page(spark, html, url="https://shop.example.org/a?b=1"):
    return spark.createDataFrame([(1, url, html)], "page_id bigint, url string, html string")


def test_extract_one_product(spark):
    html = ('<title>Drinks &amp; more</title><h1>Cola 6 x 330ml</h1>'
            '<span class="price">12.50 USD</span>')
    row = pages.extract_pages(page(spark, html)).first()
    assert (row["host"], row["title"]) == ("shop.example.org", "Drinks & more")
    assert (row["product_name"], row["price"], row["currency"]) == ("Cola 6 x 330ml", 12.5, "USD")
    pack = normalize.add_pack(spark.createDataFrame([(row["product_name"],)], "n string"), "n").first()
    assert (pack["pack_count"], pack["unit_size"], pack["unit"], pack["content"]) == (
        6, 330.0, "ml", 1980.0)


def test_extract_list_of_products(spark):
    html = ('<h2 class="x">Tea</h2><b class="sale price big"> 25.000 VND</b>'
            '<h2>Rice 1,5 kg</h2><i>no tag</i><h2>Oil</h2><p class="price">1,234.50 EUR</p>')
    found = pages.extract_pages(page(spark, html, "not a url")).orderBy("item_no").collect()
    assert [(r["product_name"], r["price"], r["currency"]) for r in found] == [
        ("Tea", 25000.0, "VND"), ("Rice 1,5 kg", None, None), ("Oil", 1234.5, "EUR")]
    assert found[0]["host"] is None


def test_page_without_product_or_price(spark):
    row = pages.extract_pages(page(spark, "<p>hello</p>")).first()
    assert row["product_name"] is None and row["price"] is None and row["item_no"] == 0


@pytest.mark.parametrize("block,want", [
    ('<b class="price">25.000₫</b>', (25000.0, "VND")), ('<b class="price">25.000đ</b>', (25000.0, "VND")),
    ('<b class="price">$12</b>', (12.0, "USD")), ('<b class="price">€ 1.234,50 now</b>', (1234.5, "EUR")),
    ('<b class="old-price">9.00 USD</b><b class="price">7.50 USD</b>', (7.5, "USD")),
    ('<del class="price">9.00 USD</del><b class="price">7.50 USD</b>', (7.5, "USD")),
    ('<b class="price was">9.00 USD</b>', (9.0, "USD")), ('<b class="price">ask us</b>', (None, None))])
def test_prices_as_shops_write_them(spark, block, want):
    row = pages.extract_pages(page(spark, f"<h1><a href='/x'>Name</a></h1>{block}")).first()
    assert (row["product_name"], row["price"], row["currency"]) == ("Name", *want)


def test_links(spark):
    found = pages.extract_links(page(spark, '<a href="/x">x</a> <a  href="/y">y</a>')).collect()
    assert [(r["link_no"], r["link"]) for r in found] == [(0, "/x"), (1, "/y")]


@pytest.mark.parametrize("text,want", [
    ("12.50", 12.5), ("1,234.50", 1234.5), ("1.234,50", 1234.5), ("25.000", 25000.0),
    ("25,000", 25000.0), ("7", 7.0), ("12.5", 12.5), (None, None)])
def test_amount(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(pages.amount(F.col("t"))).first()[0] == want


@pytest.mark.parametrize("name,want", [
    ("Cola 6 x 330ml", (6, 330.0, "ml", 1980.0)), ("Milk 1,5 L", (1, 1.5, "ml", 1500.0)),
    ("Rice 5KG", (1, 5.0, "g", 5000.0)), ("Eggs 10pcs", (1, 10.0, "piece", 10.0)),
    ("Wine 75 cl", (1, 75.0, "ml", 750.0)), ("red gear", (None, None, None, None))])
def test_parse_pack(spark, name, want):
    df = normalize.add_pack(spark.createDataFrame([(name,)], "n string"), "n")
    assert tuple(df.first())[1:] == want


def test_canonical_name(spark):
    df = spark.createDataFrame([("Red  GEAR!",), ("gear red",), ("Sữa Đậu nành",), (None,)], "n string")
    assert [r[0] for r in df.select(canonical_name(F.col("n"))).collect()] == [
        "gear red", "gear red", "dau nanh sua", None]


def test_normalize_price(spark):
    df = spark.createDataFrame(
        [(10.0, "USD", False, 2.0), (275000.0, "VND", True, 2.0), (1.0, "XXX", True, 0.0)],
        "price double, currency string, tax_included boolean, content double")
    rates = spark.createDataFrame([("USD", 25000.0), ("VND", 1.0)], "currency string, rate double")
    found = {r["currency"]: (r["norm_price"], r["unit_price"])
             for r in normalize.normalize_price(df, rates, 0.1).collect()}
    assert found["USD"] == pytest.approx(found["VND"])
    assert found["XXX"] == (None, None)


def test_categorize_first_rule_wins(spark):
    df = spark.createDataFrame([("Red Gear",), ("gear plate",), ("zzz",), (None,)], "name string")
    out = normalize.categorize(df, [("plate", "metal"), ("gear", "drive")])
    assert [r["rule_category"] for r in out.collect()] == ["drive", "metal", "other", "other"]


def test_price_index_of_equal_prices(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 1.0), (2, 3.0)], "product_id int, price double")
    out = {(r["product_id"], r["price"]): (r["index"], r["z_score"])
           for r in normalize.price_index(df).collect()}
    assert out[1, 5.0] == (1.0, None)
    assert out[2, 3.0] == pytest.approx((1.5, 2 ** -0.5))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("max_dist", [0, 1, 2])
def test_match_products_equals_brute_force(spark, max_dist):
    pick = random.Random(max_dist)
    word = lambda: "".join(pick.choice("abc") for _ in range(pick.randint(1, 6)))
    side = lambda n: [(i, word(), pick.choice("xy")) for i in range(n)]
    a, b = side(40), side(40)
    schema = "product_id int, name string, block string"
    found = normalize.match_products(spark.createDataFrame(a, schema),
                                     spark.createDataFrame(b, schema), "block", max_dist)
    want = {}
    for i, name, block in a:
        near = [(distance(name, other), j) for j, other, where in b if where == block
                and distance(name, other) <= max_dist]
        want[i] = min(near)[::-1] if near else (None, None)
    assert {r["product_id"]: (r["match_id"], r["distance"]) for r in found.collect()} == want


def far(a, b):
    """Edit distance of sorted tokens, or of the odd tokens of names that have all others in common."""
    a, b = sorted(a.split()), sorted(b.split())
    ways = [distance(" ".join(a), " ".join(b))]
    for i, x in enumerate(a):
        ways += [distance(x, y) for j, y in enumerate(b) if len(a) > 1 and a[:i] + a[i + 1:] == b[:j] + b[j + 1:]]
    return min(ways)


@pytest.mark.parametrize("max_dist", [1, 2])
def test_match_products_by_all_tokens_but_one(spark, max_dist):
    pick = random.Random(10 + max_dist)
    word = lambda: "".join(pick.choice("abc") for _ in range(pick.randint(1, 4)))
    side = lambda n: [(i, " ".join(word() for _ in range(pick.randint(1, 3))), pick.choice("xy")) for i in range(n)]
    a, b = side(60), side(60)
    a += [(100, "hot anvil", "x")]
    b += [(100, "hot xanvil", "x")]
    schema = "product_id int, name string, block string"
    found = normalize.match_products(spark.createDataFrame(a, schema),
                                     spark.createDataFrame(b, schema), "block", max_dist)
    found = {r["product_id"]: (r["match_id"], r["distance"]) for r in found.collect()}
    for i, name, block in a:
        near = [(far(name, other), j) for j, other, where in b if where == block and far(name, other) <= max_dist]
        assert found[i] == (min(near)[::-1] if near else (None, None)), name
    assert found[100] == (100, 1) and distance("anvil hot", "hot xanvil") > 2


def test_match_products_with_many_copies(spark):
    a = spark.range(300).select(F.col("id").alias("product_id"), F.lit("red gear").alias("name"),
                                F.lit("x").alias("block"))
    out = normalize.match_products(a, a.withColumn("name", F.lit("red geer")), "block", 1)
    assert out.count() == 300
    assert {(r["match_id"], r["distance"]) for r in out.collect()} == {(0, 1)}


def test_near_keys(spark):
    df = spark.createDataFrame([("abc",), ("",)], "t string")
    keys = [set(r[0]) for r in df.select(near_keys(F.col("t"), 2)).collect()]
    assert keys[0] == {"abc", *map("".join, itertools.combinations("abc", 2)), "a", "b", "c"}
    assert keys[1] == {""}


def test_tidy_and_money(spark):
    df = spark.createDataFrame([(0.12345,), (-0.12345,), (2.0,), (None,)], "x double")
    assert [r[0] for r in df.select(tidy(F.col("x"))).collect()] == [0.1235, -0.1234, 2.0, None]
    cents = spark.createDataFrame([(0.1,)] * 10, "x double")
    assert cents.select(money_sum(F.col("x"))).first()[0] == 1.0
