"""All registered queries."""

from shelfline.plans import (  # noqa: F401
    price_queries, sales_queries, source_queries, stream_queries,
)
from shelfline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
