import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfline.operators import audit, quality
from shelfline.schemas import schema_of
from shelfline.session import scratch
from shelfline.sinks import layers
from shelfline.sources import tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_conform(spark):
    df = spark.createDataFrame([("1", "2.5", "x"), ("b", "zz", "y")], "id string, p string, more string")
    want = schema_of("id bigint, p double")
    assert rows(quality.conform(df, want)) == [(1, 2.5), (None, None)]
    assert quality.conform(df, want, allow_new=True).columns == ["id", "p", "more"]
    with pytest.raises(ValueError, match="missing.*q"):
        quality.conform(df, schema_of("id bigint, q int"))
    with pytest.raises(ValueError, match="nested"):
        quality.conform(df.withColumn("p", F.array("p")), want)


def test_conform_whole_numbers_from_text(spark):
    df = spark.createDataFrame([(" 7",), ("-3",), ("4.5",), ("99999999999",), ("",)], "n string")
    assert rows(quality.conform(df, schema_of("n int"))) == [(-3,), (7,), (None,), (None,), (None,)]


def test_handle_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0, None), (2, "a", 4.0, 0.5), (3, "a", None, 0.1), (None, "a", 9.0, 0.1),
         (4, "b", None, 0.2)], "id int, cat string, price double, disc double")
    out = quality.handle_nulls(df, ["id"], {"disc": 0.0}, {"price": "cat"})
    assert rows(out, "id", "price", "disc") == [
        (1, 1.0, 0.0), (2, 4.0, 0.5), (3, 2.5, 0.1), (4, None, 0.2)]


def test_dedup_copies_and_ties(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, 5), (1, 2, 3), (1, 2, 4), (2, 1, 1)],
                               "k int, at int, v int")
    assert rows(quality.dedup(df, ["k"], ["at", "v"])) == [(1, 2, 4), (2, 1, 1)]


def test_validate(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None), (None, 2.0), (9, -4.0)],
                               "product_id int, price double")
    known = spark.createDataFrame([(1,), (2,), (3,), (1,)], "product_id int")
    good, bad = quality.validate(df, {"positive": F.col("price") > 0}, {"product_id": known})
    assert rows(good) == [(1, 5.0)]
    assert {(r["product_id"], tuple(r["failed"])) for r in bad.collect()} == {
        (2, ("positive",)), (3, ("positive",)), (None, ("product_id_known",)),
        (9, ("positive", "product_id_known"))}
    assert good.count() + bad.count() == df.count()


def test_profile(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 50.0), (3, 1.0)], "id int, p double")
    for exact in (True, False):
        found = {(r["metric"], r["column"]): r["value"]
                 for r in quality.profile(df, ["id"], {"p": (0, 10)}, exact).collect()}
        assert found["rows", "*"] == 4 and found["duplicate_rate", "*"] == 0.25
        assert found["null_rate", "p"] == 0.25 and found["distinct_rate", "id"] == 0.75
        assert found["out_of_range_rate", "p"] == 0.25


def test_profile_sketches_merge_and_keep_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 100_000).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") / 7).alias("b"),
                                     F.lit("x").alias("c"), F.timestamp_seconds("id").alias("d"))
    parts = [quality.profile_state(df.filter(f"a % 5 = {i}"), {"b": (0, 10)}) for i in range(5)]
    states = parts[0]
    for part in parts[1:]:
        states = states.unionByName(part)
    merged = {(r["metric"], r["column"]): r["value"] for r in quality.profile_of(states).collect()}
    exact = {(r["metric"], r["column"]): r["value"] for r in quality.profile(df, ["a"], {"b": (0, 10)}, True).collect()}
    assert merged.keys() | {("duplicate_rate", "*")} == exact.keys()
    for key, value in merged.items():
        assert value == pytest.approx(exact[key], rel=0.03 if key[0] == "distinct_rate" else 1e-12)
    assert exact["distinct_rate", "a"] == 0.5 and exact["null_rate", "b"] == 0.25 and exact["duplicate_rate", "*"] == 0.5


def test_exact_profile_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    plan = quality.profile(df, ["a"], exact=True)._jdf.queryExecution().toString()
    assert "Expand" not in plan and "partial_count" in plan


def test_profile_of_nothing(spark):
    out = quality.profile(spark.createDataFrame([], "id int"), ["id"])
    assert {r["metric"]: r["value"] for r in out.collect()}["rows"] == 0


def test_reconcile_with_repeated_and_null_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 5.0), (None, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, 3.0), (3, 1.0), (None, 1.0)], "k int, v double")
    assert rows(quality.reconcile(a, b, ["k"], ["v"]), "k", "rows_a", "rows_b", "status") == [
        (1, 2, 1, "differs"), (2, 1, None, "missing_right"), (3, None, 1, "missing_left")]
    assert quality.reconcile(a, a, ["k"], ["v"]).count() == 0


def test_changed_rows_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (3,)], "v int")
    assert rows(quality.changed_rows(a, b)) == [(1, "a"), (2, "a"), (3, "b")]


def test_split_corrupt(spark):
    df = spark.createDataFrame([(1, '{"price": 10}'), (2, "{bad"), (3, "{}"), (4, None),
                                (5, '{"price": "x"}')], "id int, body string")
    schema = schema_of("price int")
    good, bad = quality.split_corrupt(df, "body", schema)
    assert rows(good) == [(1, 10), (3, None), (4, None)]
    assert rows(bad) == [(2, "{bad"), (5, '{"price": "x"}')]
    assert schema.names == ["price"]


def test_audit(spark):
    path = scratch(spark)
    df = spark.createDataFrame([(1,), (-2,), (3,)], "v int")
    work = lambda x: quality.checked(x, {"positive": F.col("v") > 0})
    put = lambda name: lambda x: x.write.mode("overwrite").parquet(f"{path}/{name}")
    counts = audit.audited(spark, f"{path}/audit", "r1", "check", df, work, put("good"), put("bad"))
    assert counts == {"rows_in": 3, "rows_out": 2, "rows_rejected": 1}
    assert rows(spark.read.parquet(f"{path}/good")) == [(1,), (3,)]
    assert [tuple(r) for r in spark.read.parquet(f"{path}/bad").collect()] == [(-2, ["positive"])]
    with pytest.raises(ZeroDivisionError):
        audit.audited(spark, f"{path}/audit", "r1", "broken", df, lambda x: 1 / 0, None, None)
    assert rows(audit.audit_log(spark, f"{path}/audit"), "step", "status") == [
        ("broken", "failed"), ("check", "done")]


def test_audit_reads_its_source_once(spark):
    path = scratch(spark)
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    df = spark.range(50).mapInArrow(count, "id long")
    put = lambda name: lambda x: x.write.mode("overwrite").parquet(f"{path}/{name}")
    counts = audit.audited(spark, f"{path}/audit", "r1", "once", df,
                           lambda x: quality.checked(x, {"small": F.col("id") < 30}), put("good"), put("bad"))
    assert counts == {"rows_in": 50, "rows_out": 30, "rows_rejected": 20} and reads.value == 50
    assert spark.read.parquet(f"{path}/good").count() == 30 and spark.read.parquet(f"{path}/bad").count() == 20


def test_bronze_rerun_replaces_its_run(spark):
    root = scratch(spark)
    df = spark.createDataFrame([(1, 2.0)], "product_id int, price double")
    for run_id in ("a", "b", "b"):
        layers.write_bronze(df, root, "internal", run_id, "erp")
    table = tables.read_layer(spark, root, "bronze", "internal")
    assert rows(table, "product_id", "_run_id", "_source") == [(1, "a", "erp"), (1, "b", "erp")]
    with pytest.raises(ValueError, match="no dataset"):
        tables.read_layer(spark, root, "bronze", "normalized")


def test_silver_overwrites_only_written_partitions(spark):
    root = scratch(spark)
    schema = "category string, v int"
    layers.write_silver(spark.createDataFrame([("a", 1), ("b", 1)], schema), root, "categorized",
                        ["category"])
    layers.write_silver(spark.createDataFrame([("b", 2)], schema), root, "categorized", ["category"])
    assert rows(tables.read_layer(spark, root, "silver", "categorized"), "category", "v") == [
        ("a", 1), ("b", 2)]


def test_upsert_is_idempotent(spark):
    path, schema = scratch(spark), "part string, k int, at int, v string"
    first = spark.createDataFrame([("x", 1, 1, "a"), ("x", 2, 1, "b"), ("y", 3, 1, "c")], schema)
    second = spark.createDataFrame([("x", 1, 2, "new"), ("x", 2, 0, "late"), ("x", 4, 1, "d")], schema)
    for updates in (first, second, second):
        layers.upsert(path, updates, ["part", "k"], ["at", "v"], ["part"])
    assert rows(spark.read.parquet(path), "part", "k", "at", "v") == [
        ("x", 1, 2, "new"), ("x", 2, 1, "b"), ("x", 4, 1, "d"), ("y", 3, 1, "c")]
    with pytest.raises(ValueError, match="belong to the key"):
        layers.upsert(path, first, ["k"], ["at"], ["part"])


def test_publish_and_bucketed_tables(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, v double")
    layers.publish(df, "gold_small")
    layers.save_bucketed(df, "gold_bucketed", ["k"], 4)
    assert spark.table("gold_small").count() == 1
    plan = spark.table("gold_bucketed").groupBy("k").count()._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]


def test_reports_keep_other_dates(spark):
    path = scratch(spark)
    df = spark.createDataFrame([("a", 1)], "name string, n int")
    for day in (dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 2)):
        layers.export_report(df, path, "json", day)
    assert spark.read.json(path).count() == 2
    with pytest.raises(ValueError):
        layers.export_report(df, path, "xls", "2024-01-01")
