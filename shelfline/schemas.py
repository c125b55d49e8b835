"""Column contracts of the canonical tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampNTZType,
    TimestampType,
)

_TYPES = {
    "bigint": LongType(), "int": IntegerType(), "double": DoubleType(), "string": StringType(),
    "boolean": BooleanType(), "timestamp": TimestampType(), "timestamp_ntz": TimestampNTZType(),
}


def schema_of(columns: str) -> StructType:
    """Schema from "name type, ..."; works before any session exists."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


PRICE_OBSERVATION = schema_of(
    "product_id bigint, retailer_id bigint, observed_at timestamp, price double, "
    "order_id bigint, line_no int")
# A price as a competitor shows it; observations are in the base currency, tax included.
PRICE_QUOTE = schema_of(
    "product_id bigint, retailer_id bigint, observed_at timestamp, price double, "
    "order_id bigint, line_no int, currency string, tax_included boolean")
PRODUCT = schema_of(
    "product_id bigint, name string, brand string, category string, "
    "list_price double, pack_size int")
SALE = schema_of(
    "order_id bigint, line_no int, product_id bigint, retailer_id bigint, "
    "sold_at timestamp, qty double, amount double, discount double, net_price double, "
    "is_promo boolean, category string, brand string")
PROMOTION = schema_of(
    "promo_id string, category string, depth double, start_at timestamp, end_at timestamp")
MARKET_TREND = schema_of("category string, month timestamp, market_price double")
PRICE_EVENT = schema_of(
    "event_id bigint, event_time timestamp, topic string, product_id bigint, "
    "retailer_id bigint, new_price double, payload string")
# Landed event files carry the raw columns of the event table.
EVENT_FILE = schema_of(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string")
ALERT = schema_of(
    "product_id bigint, retailer_id bigint, event_id bigint, event_time timestamp, "
    "old_price double, new_price double, pct double")

# Newest-last order of observations; the later columns only break ties.
OBSERVED_ORDER = ("observed_at", "order_id", "line_no", "price")

# Topic names of the event hub.
TOPICS = ("price-changes", "promotion-events", "market-trends", "alerts")

# Datasets of each lake layer.
LAYERS = {
    "bronze": ("competitors", "internal", "market_trends"),
    "silver": ("normalized", "categorized"),
    "gold": ("price_analytics", "promotion_analytics", "product_analytics"),
}
