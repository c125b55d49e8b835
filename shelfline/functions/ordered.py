"""Ordered-group operations that never put a whole hot group into one task.

``lag``, ``lead``, "last value so far", row numbers and running totals are
plain window functions as long as every group is small. A window sends each
group to one task, so a key with a third of all rows would stall a cluster. The
helpers here cut such groups along their order into slices:

* Slice edges are approximate quantiles of the order columns. They come to the
  driver as at most 2,048 values per order column and enter the plan as
  literals, so every branch and every retried task sees the same slices. Edges
  only balance the work; results are exact whatever the edges are.
* A row strictly between two edges shares its slice with about 1/width of the
  rows. A row *on* an edge (a hot value) is cut further by the next order column.
* Each slice is handled by a window on (key, slice). What crosses a slice border
  (the neighbouring row, the running total) comes from one summary row per
  slice.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal
from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from shelfline.session import kept, width

# A group of up to this many rows is left to a plain window.
GROUP_ROWS = 4_000_000
# Cells that keys are hashed to when hot ones are sought.
_CELLS = 65_536
# Rows looked at per edge when edges are sought.
_LOOK = 2_000
# Most edges per order column.
_MOST = 2_048


def _value(df: DataFrame, name: str) -> Column:
    """The column as it is compared with edges; times as microseconds, free of time zones."""
    if isinstance(df.schema[name].dataType, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name)


def _edges(df: DataFrame, order: Sequence[str], n: int, rows: int) -> list[list]:
    """Distinct approximate quantiles that cut each order column into ``n`` parts.

    Found in one aggregate over about ``_LOOK`` x ``n`` of the ``rows``, so that the sketches
    of all tasks together stay small. Edges never decide a result.
    """
    if rows > _LOOK * n:
        df = df.sample(_LOOK * n / rows, seed=7)
    probs = [i / n for i in range(1, n)]
    found = df.agg(*[F.percentile_approx(_value(df, c), probs, max(1_000, 8 * n)).alias(f"e{i}")
                     for i, c in enumerate(order)]).first()
    return [sorted(set(marks or [])) for marks in found]


def _points(marks: list) -> Column:
    """Array of edges, given as one SQL text: much faster to build than many literals."""
    def text(mark) -> str:
        if isinstance(mark, float):
            return f"double('{mark!r}')"
        if isinstance(mark, Decimal):
            return f"{mark:f}BD"
        return f"DATE '{mark}'" if isinstance(mark, date) else f"{mark}L"

    return F.expr(f"array({', '.join(map(text, marks))})")


def _below(value: Column, marks: list) -> Column:
    """Number of edges below the value: first among every k-th edge, then between two."""
    if not marks:
        return F.lit(0)
    points, step = _points(marks), max(1, isqrt(len(marks)))
    coarse = _points(marks[::step])
    start = F.greatest(F.size(F.filter(coarse, lambda e: e < value)) - 1, F.lit(0)) * step
    # The one-element transform names the start, so that it is found once.
    return F.transform(F.array(start), lambda s: s + F.size(
        F.filter(F.slice(points, s + 1, step), lambda e: e < value)))[0]


def with_slice(df: DataFrame, order: Sequence[str], edges: list[list],
               descending: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Add ``_slice``, a number that rises along the order; -1 where ``where`` does not hold.

    One order column gives #edges below + #edges up to the value: even numbers
    lie between edges, odd ones on an edge. The next column counts only for rows on an
    edge. Each place is a column of its own, so none is worked out twice.
    """
    names, live, code = df.columns, where, F.lit(0).cast("bigint")
    values = [_value(df, name) for name in order]
    for i, (name, value, marks) in enumerate(zip(order, values, edges)):
        below = _below(value, marks)
        df = df.withColumn(f"_b{i}", below if live is None else F.when(live, below))
        place, live = 2 * F.col(f"_b{i}"), F.lit(False)
        if marks:
            live = F.coalesce(
                F.try_element_at(_points(marks), F.col(f"_b{i}") + 1) == value, F.lit(False))
            place = place + F.when(live, 1).otherwise(0)
        if name in descending:
            place = F.lit(2 * len(marks)) - place
        code = code * (2 * len(marks) + 1) + F.coalesce(place, F.lit(0))
    if where is not None:
        code = F.when(where, code).otherwise(F.lit(-1).cast("bigint"))
    return df.select(*names, code.alias("_slice"))


def _levels(n: int, columns: int) -> int:
    """Edges per column such that the slice number fits a BIGINT."""
    return max(2, min(n, int((2**62) ** (1 / columns) / 2) - 1, _MOST))


class OrderedGroups:
    """Neighbour and carry operations over ``keys`` in ``order``.

    ``order`` must be a total order within a key up to exact copies, of numbers, dates
    or times without nulls. ``df`` is only measured: rows are counted by a hash of their key, in few cells, and keys
    by themselves only within cells that could hide one of more than max(``group_rows``, rows / width) rows. There are fewer
    than ``width`` of those, so their list is bounded. With none (the usual
    case) each operation is one window; all operations then share one shuffle
    and sort.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 group_rows: int = GROUP_ROWS):
        self.keys, self.order = list(keys), list(order)
        for name in self.order:
            kind = df.schema[name].dataType
            if not isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
                raise TypeError(f"order column {name!r} is {kind.simpleString()}; it must be a number, date or time")
        n = width(df.sparkSession)
        cells = df.groupBy(F.pmod(F.xxhash64(*self.keys), F.lit(_CELLS)).alias("_cell")).agg(F.count(F.lit(1)).alias("_rows"))
        top = cells.agg(F.sum("_rows").alias("rows"), F.collect_list(
            F.when(F.col("_rows") > group_rows, F.struct("_cell", "_rows"))).alias("full")).first()
        bound = max(group_rows, (top["rows"] or 0) // n)
        full = [cell["_cell"] for cell in top["full"] if cell["_rows"] > bound]
        self.hot: Column | None = None
        found = full and (df.filter(F.pmod(F.xxhash64(*self.keys), F.lit(_CELLS)).isin(full)).groupBy(*self.keys)
                          .agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > bound).collect())
        if found:
            kinds = {k: df.schema[k].dataType for k in self.keys}
            self.hot = F.struct(*self.keys).isin(*[
                F.struct(*[F.lit(r[k]).cast(kinds[k]).alias(k) for k in self.keys])
                for r in found])
            n = _levels(n, len(self.order))
            marks = _edges(df.filter(self.hot), self.order, n, sum(r["_rows"] for r in found))
            self.slice = lambda df: with_slice(df, self.order, marks, where=self.hot)

    def _sliced(self, df: DataFrame) -> DataFrame:
        return kept(self.slice(df))

    def _carried(self, df: DataFrame, summary: Column, carry) -> DataFrame:
        """Join to each row what the other slices of its hot key hand over."""
        along = Window.partitionBy(*self.keys).orderBy("_slice")
        handed = (df.filter(self.hot).groupBy(*self.keys, "_slice")
                  .agg(summary.alias("_edge"))
                  .select(*self.keys, "_slice", carry(F.col("_edge"), along).alias("_carry")))
        on = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*self.keys, "_slice"]]
        return (df.alias("r").join(handed.alias("c"), on, "left")
                .select("r.*", "c._carry"))

    def shift(self, df: DataFrame, columns: dict[str, str], forward: bool = False) -> DataFrame:
        """Add for each new name the column's value in the previous (or with
        ``forward`` the next) row of the key; null at the ends."""
        packed = F.struct(*[F.col(c).alias(name) for name, c in columns.items()])
        step = F.lead if forward else F.lag
        if self.hot is None:
            within = Window.partitionBy(*self.keys).orderBy(*self.order)
            return df.select("*", *[step(c).over(within).alias(name)
                                    for name, c in columns.items()])
        df = self._sliced(df)
        within = Window.partitionBy(*self.keys, "_slice").orderBy(*self.order)
        at = F.struct(*self.order)
        border = F.min_by(packed, at) if forward else F.max_by(packed, at)
        out = self._carried(df, border, lambda edge, along: step(edge).over(along))
        out = out.withColumn("_near", F.coalesce(step(packed).over(within), F.col("_carry")))
        return out.select(*[c for c in df.columns if c != "_slice"],
                          *[F.col(f"_near.{name}").alias(name) for name in columns])

    def last_known(self, df: DataFrame, columns: dict[str, str], when: str) -> DataFrame:
        """Add for each new name the column's value in the last row, up to and
        including this one, where the boolean column ``when`` holds."""
        packed = F.when(F.col(when), F.struct(*[F.col(c).alias(name)
                                                for name, c in columns.items()]))
        so_far = (Window.unboundedPreceding, Window.currentRow)
        if self.hot is None:
            within = Window.partitionBy(*self.keys).orderBy(*self.order).rowsBetween(*so_far)
            out, names = df.withColumn("_near", F.last(packed, True).over(within)), df.columns
        else:
            names = df.columns
            df = self._sliced(df)
            within = Window.partitionBy(*self.keys, "_slice").orderBy(*self.order)
            out = self._carried(
                df, F.max_by(packed, F.when(F.col(when), F.struct(*self.order))),
                lambda edge, along: F.last(edge, True).over(
                    along.rowsBetween(Window.unboundedPreceding, -1)))
            out = out.withColumn("_near", F.coalesce(
                F.last(packed, True).over(within.rowsBetween(*so_far)), F.col("_carry")))
        return out.select(*names, *[F.col(f"_near.{name}").alias(name) for name in columns])


def number_rows(df: DataFrame, orders: dict[str, tuple[str, bool]], tie: str,
                keys: Sequence[str] = (), running: dict[str, str] | None = None,
                totals: dict[str, Column] | None = None) -> DataFrame:
    """Exact row numbers along global (or per-key) orders, cut into slices.

    ``orders`` maps a new column to (value column, ascending); ties are broken
    by ``tie`` ascending, which must be unique. ``running`` maps new columns to
    measures summed so far along the first order, ``totals`` new columns to aggregates
    over all rows. The input is written once and read by every step; slice summaries
    are the only thing a single window sees.
    """
    keys, running, totals = list(keys), dict(running or {}), dict(totals or {})
    base = kept(df)
    n = _levels(width(df.sparkSession), 2)
    values = [value for value, _ in orders.values()]
    *whole, rows = base.agg(*[t.alias(name) for name, t in totals.items()],
                            F.count(F.lit(1)).alias("_rows")).first()
    marks = _edges(base, [*values, tie], n, rows)
    out = base.select("*", *[F.lit(t).alias(name) for name, t in zip(totals, whole)])
    names = out.columns
    for i, (name, (value, ascending)) in enumerate(orders.items()):
        cut = ([value, tie], [marks[i], marks[-1]], () if ascending else (value,))
        extra = running if i == 0 else {}
        before = (Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice")
                  .rowsBetween(Window.unboundedPreceding, -1))
        sums = {"_n": F.count(F.lit(1)),
                **{f"_s{j}": F.sum(m) for j, m in enumerate(extra.values())}}
        offsets = (with_slice(base, *cut).groupBy(*keys, "_slice")
                   .agg(*[agg.alias(t) for t, agg in sums.items()])
                   .select(*keys, "_slice",
                           *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(t) for t in sums]))
        within = (Window.partitionBy(*keys, "_slice")
                  .orderBy(F.col(value) if ascending else F.col(value).desc(), F.col(tie)))
        so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        on = [*[F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys],
              F.col("r._slice") == F.col("o._slice")]
        sums = offsets.select(*keys, "_slice", *sums).alias("o")
        out = (with_slice(out, *cut).alias("r").join(sums, on).drop(*[F.col(f"o.{k}") for k in [*keys, "_slice"]])
               .select(*names, (F.col("_n") + F.row_number().over(within)).alias(name),
                       *[(F.col(f"_s{j}") + F.sum(m).over(so_far)).alias(target)
                         for j, (target, m) in enumerate(extra.items())]))
        names = out.columns
    return out


def tile(position: Column, rows: Column, tiles: int) -> Column:
    """The ``ntile`` number of a row number among ``rows`` rows: the first
    rows % tiles tiles hold one row more than the others."""
    small = F.floor(rows / tiles)
    longer = rows % tiles
    head = longer * (small + 1)
    return F.when(position <= head, F.floor((position - 1) / (small + 1)) + 1).otherwise(
        longer + F.floor((position - head - 1) / F.greatest(small, F.lit(1))) + 1).cast("int")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float]) -> DataFrame:
    """Interpolated quantiles per key as one array column ``quantiles``.

    Values are counted before anything else, so copies cost nothing, and no task
    holds all values of a key (the built-in ``percentile`` would).
    """
    keys = list(keys)
    counted = kept(df.filter(F.col(value).isNotNull()).groupBy(*keys, value)
                   .agg(F.count(F.lit(1)).alias("_copies")))
    n = _levels(width(df.sparkSession), 1)
    counted = with_slice(counted, [value], [_edges(counted, [value], n, counted.count())[0]])
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_slice")
    offsets = (counted.groupBy(*keys, "_slice").agg(F.sum("_copies").alias("_n"))
               .select(*keys, "_slice",
                       (F.sum("_n").over(along) - F.col("_n")).alias("_before"),
                       F.sum("_n").over(Window.partitionBy(*(keys or [F.lit(0)]))).alias("_rows")))
    on = [*[F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys],
          F.col("r._slice") == F.col("o._slice")]
    placed = (counted.alias("r").join(offsets.alias("o"), on)
              .select("r.*", "o._before", "o._rows")
              .withColumn("_last", F.col("_before") + F.sum("_copies").over(
                  Window.partitionBy(*keys, "_slice").orderBy(value)))
              .withColumn("_first", F.col("_last") - F.col("_copies")))

    def at(position: Column) -> Column:
        """Value at a zero-based position of the sorted rows."""
        return F.max(F.when((F.col("_first") <= position) & (position < F.col("_last")),
                            F.col(value)))

    picks = []
    for i, p in enumerate(probs):
        spot = (F.col("_rows") - 1) * F.lit(float(p))
        picks += [at(F.floor(spot)).alias(f"_lo{i}"), at(F.ceil(spot)).alias(f"_hi{i}"),
                  F.max(spot - F.floor(spot)).alias(f"_f{i}")]
    lines = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}"))
             .cast("double") for i in range(len(probs))]
    return placed.groupBy(*keys).agg(*picks).select(*keys, F.array(*lines).alias("quantiles"))
