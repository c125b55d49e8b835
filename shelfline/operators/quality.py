"""Contracts, null handling, duplicates, rules, profiles and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (
    ArrayType, DataType, IntegralType, MapType, NumericType, StringType, StructField, StructType,
)

from shelfline.functions.ordered import exact_quantiles
from shelfline.session import kept

CORRUPT = "_corrupt_record"


def _castable(have: DataType, want: DataType) -> bool:
    nested = (ArrayType, MapType, StructType)
    return have == want or not (isinstance(have, nested) or isinstance(want, nested))


def _cast(have: DataType, want: StructField) -> Column:
    """The column as its contract type, null where the value does not fit.

    A failing cast to a whole number costs an exception per row, so text that is
    none is sorted out by its look first.
    """
    value = F.col(want.name)
    if have == want.dataType:
        return value
    cast = value.try_cast(want.dataType)
    if isinstance(have, StringType) and isinstance(want.dataType, IntegralType):
        return F.when(value.rlike(r"^\s*[+-]?\d+\s*$"), cast)
    return cast


def conform(df: DataFrame, schema: StructType, allow_new: bool = False) -> DataFrame:
    """Columns of the contract in order, cast to its types.

    A missing column, or a nested column of another type, fails. A value that
    cannot be cast becomes null (rules then catch it). Columns outside the
    contract are kept only with ``allow_new``.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {', '.join(missing)}")
    wrong = [f.name for f in schema if not _castable(df.schema[f.name].dataType, f.dataType)]
    if wrong:
        raise ValueError(f"columns of another nested type: {', '.join(wrong)}")
    fixed = [_cast(df.schema[f.name].dataType, f).alias(f.name) for f in schema]
    extra = [c for c in df.columns if c not in schema.names] if allow_new else []
    return df.select(*fixed, *extra)


def handle_nulls(df: DataFrame, required: Sequence[str], defaults: dict | None = None,
                 impute: dict[str, str] | None = None) -> DataFrame:
    """Drop rows with a null in ``required``, then fill the rest.

    ``defaults`` maps columns to constants, ``impute`` maps a measure to the
    column within whose groups the exact median stands in for a null.
    """
    df = df.na.drop(subset=list(required))
    for measure, group in (impute or {}).items():
        medians = kept(exact_quantiles(df, [group], measure, [0.5]).select(
            F.col(group).alias("_group"), F.col("quantiles")[0].alias("_median")))
        df = (df.join(medians, F.col(group).eqNullSafe(F.col("_group")), "left")
              .withColumn(measure, F.coalesce(measure, "_median"))
              .drop("_group", "_median"))
    return df.na.fill(defaults) if defaults else df


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row of each key by a descending total order.

    Spark cuts each map task to one row per key before the shuffle, so copies
    of one key never meet in one task.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("_rank", F.row_number().over(latest))
            .filter("_rank = 1").drop("_rank"))


def failed_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row fails; a null result counts as failed."""
    checks = [F.when(F.coalesce(rule, F.lit(False)), None).otherwise(F.lit(name))
              for name, rule in rules.items()]
    return F.filter(F.array(*checks), lambda name: name.isNotNull())


def checked(df: DataFrame, rules: dict[str, Column],
            references: dict[str, DataFrame] | None = None) -> DataFrame:
    """All rows with the names of the rules they fail in ``failed``.

    ``references`` maps a key column to a frame that must hold its values; the
    rule is then named "<column>_known".
    """
    out, rules = df, dict(rules)
    for column, known in (references or {}).items():
        flag = f"_{column}_known"
        known = known.select(F.col(column).alias(f"{flag}_key")).distinct()
        out = (out.join(known, F.col(column) == F.col(f"{flag}_key"), "left")
               .withColumn(flag, F.col(f"{flag}_key").isNotNull()).drop(f"{flag}_key"))
        rules[f"{column}_known"] = F.col(flag)
    return out.withColumn("failed", failed_rules(rules)).select(*df.columns, "failed")


def validate(df: DataFrame, rules: dict[str, Column],
             references: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) of ``checked``: bad rows carry the failed rule names in ``failed``."""
    rows = checked(df, rules, references)
    return rows.filter(F.size("failed") == 0).drop("failed"), rows.filter(F.size("failed") > 0)


# Copies of a row that are made at once.
COPIES = 4_096
# 2^PRECISION cells of a distinct-count sketch: a standard error of about 1.04 / sqrt(2^PRECISION), 0.8%.
PRECISION = 14


def profile_state(df: DataFrame, ranges: dict[str, tuple] | None = None) -> DataFrame:
    """What ``profile`` adds up, one row per column and one ("*") for the whole, from one scan.

    ``rows``, ``nulls``, ``outside`` (rows out of the column's range; null without one) and ``sketch``, a mergeable
    distinct count. States of parts, days or runs can be stacked and given to ``profile_of``.
    """
    rows, ranges = F.count(F.lit(1)), ranges or {}
    found = [("*", F.lit(None), F.lit(None), F.lit(None))]
    for c in df.columns:
        # A sketch takes few types, a hash of 64 bits of any; null is no value.
        value = F.when(F.col(c).isNotNull(), F.xxhash64(c))
        outside = F.count_if(~F.col(c).between(*ranges[c])) if c in ranges else F.lit(None)
        found.append((c, F.count_if(F.col(c).isNull()), outside, F.hll_sketch_agg(value, F.lit(PRECISION))))
    wide = df.agg(rows.alias("rows"), *[part.alias(f"{name}{i}") for i, (_, *parts) in enumerate(found)
                                        for name, part in zip(("nulls", "outside", "sketch"), parts)])
    entries = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col("rows"), F.col(f"nulls{i}").cast("long").alias("nulls"),
        F.col(f"outside{i}").cast("long").alias("outside"), F.col(f"sketch{i}").cast("binary").alias("sketch"))
        for i, (c, *_) in enumerate(found)])
    return wide.select(F.inline(entries))


def profile_of(states: DataFrame) -> DataFrame:
    """(metric, column, value) of stacked states: rows, and per column null_rate, distinct_rate and out_of_range_rate."""
    total = states.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.sum("outside").alias("outside"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))
    share = lambda part: F.col(part) / F.nullif("rows", F.lit(0))
    wide = total.select("column", *[v.cast("double").alias(m) for m, v in {
        "rows": F.when(F.col("column") == "*", F.col("rows")), "null_rate": share("nulls"),
        "distinct_rate": F.least(share("distinct"), F.lit(1.0)), "out_of_range_rate": share("outside")}.items()])
    wanted = (F.col("metric") == "rows") == (F.col("column") == "*")
    found = wide.unpivot(["column"], ["rows", "null_rate", "distinct_rate", "out_of_range_rate"], "metric", "value")
    whole = total.filter("outside IS NOT NULL").select("column").withColumn("ranged", F.lit(True))
    found = found.filter(wanted).join(whole, "column", "left").filter("metric <> 'out_of_range_rate' OR ranged")
    return found.select("metric", "column", "value")


def profile(df: DataFrame, keys: Sequence[str], ranges: dict[str, tuple] | None = None,
            exact: bool = False) -> DataFrame:
    """Long table (metric, column, value) of a dataset's quality.

    rows, duplicate_rate (rows beyond the first of a key), and per column null_rate,
    distinct_rate and, for columns in ``ranges``, out_of_range_rate. Distinct
    counts are sketches unless ``exact``: then the frame is written once, and each column is read and counted by
    value by itself, copies combined before the shuffle. Duplicates are always exact.
    """
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.lit("duplicate_rate").alias("metric"), F.lit("*").alias("column"),
        (F.sum(F.col("n") - 1) / F.nullif(F.sum("n"), F.lit(0))).cast("double").alias("value"))
    if not exact:
        return profile_of(profile_state(df, ranges)).unionByName(copies)
    base = kept(df)
    out = base.agg(F.lit("rows").alias("metric"), F.lit("*").alias("column"),
                   F.count(F.lit(1)).cast("double").alias("value")).unionByName(copies)
    for c in df.columns:
        value, n = F.col("value"), F.sum("n")
        rates = {"null_rate": F.sum(F.when(value.isNull(), F.col("n")).otherwise(0)), "distinct_rate": F.count(value)}
        if c in (ranges or {}):
            rates["out_of_range_rate"] = F.sum(F.when(~value.between(*ranges[c]), F.col("n")).otherwise(0))
        counts = base.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
        wide = counts.agg(*[(rate / F.nullif(n, F.lit(0))).cast("double").alias(m) for m, rate in rates.items()])
        out = out.unionByName(wide.select(F.inline(F.array(*[
            F.struct(F.lit(m).alias("metric"), F.lit(c).alias("column"), F.col(m).alias("value")) for m in rates]))))
    return out


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str],
              measures: Sequence[str]) -> DataFrame:
    """Keys whose rows or measure totals differ between two layers.

    Each side is summed per key first, so repeated keys cannot multiply in the
    full outer join. ``status`` is missing_left, missing_right or differs.
    """
    def total(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias(f"rows_{side}"),
            *[F.sum(F.col(m).cast("decimal(28,6)")).alias(f"{m}_{side}") for m in measures])

    left, right = total(a, "a").alias("a"), total(b, "b").alias("b")
    both = left.join(right, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys],
                     "full_outer")
    same = reduce(lambda x, y: x & y, [
        F.col(f"{m}_a").eqNullSafe(F.col(f"{m}_b")) for m in ["rows", *measures]])
    status = (F.when(F.col("rows_a").isNull(), "missing_left")
              .when(F.col("rows_b").isNull(), "missing_right")
              .when(~same, "differs"))
    return both.select(
        *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in keys],
        "rows_a", "rows_b",
        *[(F.col(f"{m}_b") - F.col(f"{m}_a")).cast("double").alias(f"{m}_diff")
          for m in measures],
        status.alias("status")).filter(F.col("status").isNotNull())


def changed_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Whole rows found on one side only, copies counted, tagged by ``side``.

    Copies count plus one on side a and minus one on side b, so each side is read once. A row that is to come out many
    times is dealt out in blocks of COPIES, which Spark may spread over tasks, so that no long list is built.
    """
    names = a.columns
    both = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    rest = both.groupBy(*names).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.abs("_n") - 1) / COPIES).cast("bigint")))
    dealt = rest.select(*names, "_n", blocks.alias("_block"))
    many = F.least(F.abs("_n") - F.col("_block") * COPIES, F.lit(COPIES)).cast("int")
    return dealt.select(*names, F.when(F.col("_n") > 0, "a").otherwise("b").alias("side"),
                        F.explode(F.array_repeat(F.lit(0), many)).alias("_copy")).drop("_copy")


def split_corrupt(df: DataFrame, column: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(parsed, corrupt) of a JSON text column.

    Parsed rows hold the fields of ``schema`` in place of the text. Bad syntax
    and wrong types go to the corrupt side with their whole text.
    """
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = df.withColumn("_json", F.from_json(column, wide, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col(f"_json.{CORRUPT}").isNotNull()
    good = (parsed.filter(~F.coalesce(bad, F.lit(False)))
            .select(*[c for c in df.columns if c != column],
                    *[F.col(f"_json.{f.name}").alias(f.name) for f in schema]))
    return good, parsed.filter(bad).select(*df.columns)


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, the natural measures of ``reconcile``."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
