"""Product and price extraction from landed competitor pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# HTML entities decoded in names and titles.
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " "}

HEADING = r"<h[12][^>]*>"
# Elements of a price class: tag, class, text. Those struck out or named after an older price come last.
ELEMENT = r'<(\w+)[^>]*class="([^"]*price[^"]*)"[^>]*>\s*([^<]*)'
OLD_TAG, OLD_CLASS = r"(?i)^(?:del|s|strike)$", r"(?i)(?<![a-z])(?:old|was|before|struck|strike|crossed)"
NUMBER = r"([0-9](?:[0-9.,]*[0-9])?)"
# Currency signs and their codes.
SIGNS = {"$": "USD", "€": "EUR", "£": "GBP", "₫": "VND", "đ": "VND"}


def _decoded(text: Column) -> Column:
    for entity, sign in reversed(ENTITIES.items()):
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.trim(text)


def amount(text: Column) -> Column:
    """Number from "1,234.50", "1.234,50", "25.000" or "12.5".

    The right-most mark followed by one or two digits is the decimal mark; all
    other marks group thousands.
    """
    decimals = F.regexp_extract(text, r"[.,](\d{1,2})$", 1)
    whole = F.regexp_replace(F.regexp_replace(text, r"[.,]\d{1,2}$", ""), "[.,]", "")
    return F.concat(whole, F.lit("."), decimals, F.lit("0")).try_cast("double")


def _price(block: Column) -> Column:
    """Struct (price, currency) of a block: the first current price, else the first older one.

    The currency stands behind the number as a code or sign, or before it as a sign.
    """
    codes = F.create_map(*[F.lit(x) for pair in SIGNS.items() for x in pair])
    sign = f"[{''.join(SIGNS)}]"
    tags, names, texts = (F.regexp_extract_all(block, F.lit(ELEMENT), F.lit(i)) for i in (1, 2, 3))

    def read(text: Column) -> Column:
        behind = F.regexp_extract(text, rf"^{NUMBER}\s*([A-Z]{{3}}|{sign})", 2)
        before = F.regexp_extract(text, rf"^({sign})\s*{NUMBER}", 1)
        mark = F.when(behind != "", behind).otherwise(before)
        number = F.regexp_extract(text, rf"^{sign}?\s*{NUMBER}", 1)
        return F.struct(F.when(mark != "", amount(number)).alias("price"),
                        F.coalesce(F.try_element_at(codes, mark), F.nullif(mark, F.lit(""))).alias("currency"))

    older = F.zip_with(tags, names, lambda t, n: t.rlike(OLD_TAG) | n.rlike(OLD_CLASS))
    found = F.filter(F.zip_with(F.transform(texts, read), older, lambda r, o: F.struct(
        r["price"].alias("price"), r["currency"].alias("currency"), o.alias("older"))), lambda p: p["price"].isNotNull())
    return F.coalesce(F.get(F.filter(found, lambda p: ~p["older"]), F.lit(0)), F.get(found, F.lit(0)))


def extract_pages(pages: DataFrame) -> DataFrame:
    """One row per product heading (h1 or h2) of each page.

    The price of a product is the first element with a price class between its
    heading and the next one; an older price counts only if there is no other. The name may stand in
    elements within the heading. Pages without a heading give one row with null
    product. Columns: page_id, host, title, item_no, product_name, price, currency.
    """
    parts = F.split("html", HEADING)
    items = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    rows = pages.select(
        "page_id",
        F.try_parse_url("url", F.lit("HOST")).alias("host"),
        _decoded(F.regexp_extract("html", r"<title>([^<]*)", 1)).alias("title"),
        F.posexplode_outer(items).alias("item_no", "block"),
    )
    return rows.withColumn("found", _price(F.col("block"))).select(
        "page_id", "host", F.nullif("title", F.lit("")).alias("title"),
        F.coalesce("item_no", F.lit(0)).alias("item_no"),
        F.nullif(_decoded(F.regexp_extract("block", r"(?i)^(?:\s*<[a-z][^>]*>)*([^<]*)", 1)), F.lit(""))
        .alias("product_name"),
        F.col("found.price").alias("price"), F.col("found.currency").alias("currency"),
    )


def extract_links(pages: DataFrame) -> DataFrame:
    """Link targets of each page in page order: page_id, link_no, link."""
    links = F.regexp_extract_all("html", F.lit(r'<a\s+href="([^"]*)"'), 1)
    return pages.select("page_id", F.posexplode(links).alias("link_no", "link"))
