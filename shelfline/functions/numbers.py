"""Rounding, safe ratios and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def tidy(value: Column, digits: int = 4) -> Column:
    """Round half up with a small nudge, so that values which should sit on a
    half-way point do not depend on the last bit of a double. A value too large to
    have such digits stays as it is."""
    scale = 10**digits
    scaled = value.cast("double") * scale
    return F.when(F.abs(scaled) < F.lit(2.0**53), F.floor(scaled + F.lit(0.50001)) / F.lit(scale)).otherwise(
        value.cast("double"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, null where whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def money_sum(value: Column) -> Column:
    """Exact sum of amounts in whole cents, independent of the order of rows.

    Counted in a BIGINT, which holds 9e16 of the currency; more raises an error.
    """
    return F.sum(F.rint(value * 100).cast("bigint")) / F.lit(100)


def fine_sum(value: Column) -> Column:
    """Exact sum in ten-thousandths as DECIMAL(30,0), for products of price and quantity."""
    return F.sum(F.rint(value * 10_000).cast("bigint").cast("decimal(20,0)"))


def from_fine(total: Column) -> Column:
    """A ``fine_sum`` as a double in units."""
    return total.cast("double") / F.lit(10_000)


def share_of(condition: Column) -> Column:
    """Share of rows that meet a condition."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))
