"""Sums taken below a dimension join.

A fact table that is joined to a dimension only to be grouped by the dimension's columns need not be
joined row by row: measures are first summed per join key and period, which shrinks each task's
rows before anything is shuffled, then the few sums meet the dimension and are merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.numbers import ratio


class Measure(NamedTuple):
    """A measure as mergeable states: aggregates of rows, how each is merged, and the value of merged states."""

    states: tuple[Column, ...]
    merges: tuple
    value: object  # of the merged columns


def counted(column: str) -> Measure:
    return Measure((F.count(column),), (F.sum,), lambda n: n)


def summed(column: str) -> Measure:
    return Measure((F.sum(column),), (F.sum,), lambda total: total)


def averaged(column: str) -> Measure:
    """The mean of the values that are not null."""
    return Measure((F.sum(column), F.count(column)), (F.sum, F.sum), ratio)


def least(column: str) -> Measure:
    return Measure((F.min(column),), (F.min,), lambda low: low)


def greatest(column: str) -> Measure:
    return Measure((F.max(column),), (F.max,), lambda high: high)


def summed_below(rows: DataFrame, on: Sequence[str], dimension: DataFrame, by: Sequence[str],
                 measures: dict[str, Measure], extra: dict[str, Column] | None = None) -> DataFrame:
    """``rows`` joined (inner) to ``dimension`` and grouped by its columns ``by`` and the ``extra`` ones of the rows.

    Equal to joining first, whatever rows the dimension has for a key: each of them gets the key's sums.
    """
    extra = extra or {}
    names = {name: [f"_{name}_{i}" for i in range(len(m.states))] for name, m in measures.items()}
    partial = rows.groupBy(*on, *[c.alias(n) for n, c in extra.items()]).agg(
        *[state.alias(n) for name, m in measures.items() for n, state in zip(names[name], m.states)])
    joined = partial.join(dimension.select(*on, *by), list(on))
    merged = joined.groupBy(*by, *extra).agg(
        *[merge(n).alias(n) for name, m in measures.items() for n, merge in zip(names[name], m.merges)])
    return merged.select(*by, *extra, *[m.value(*map(F.col, names[name])).alias(name) for name, m in measures.items()])
