"""Bronze, silver and gold writers, upsert, publishing and reports.

All file writers overwrite only the partitions they write (dynamic partition
overwrite), so a rerun of a step gives the same table. This is idempotent, but not a
transaction: readers may see a partition half replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfline.operators.quality import dedup
from shelfline.session import CODEC, kept
from shelfline.sources.tables import layer_path


def _write(df: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet",
           whole: bool = False, few: bool = False, **options) -> None:
    """Overwrite the partitions present in ``df``, or with ``whole`` all the table has.

    The rebalance hint lets Spark split a hot partition over several tasks and
    join small ones, so files come out in even sizes. With ``few``, for partition columns of a handful of values, rows
    are not moved: each task writes a file per value.
    """
    if partitions and not few:
        df = df.hint("rebalance", *partitions)
    if fmt == "parquet":
        options = {"compression": CODEC, **options}
    (df.write.mode("overwrite").format(fmt).options(**options)
     .option("partitionOverwriteMode", "static" if whole else "dynamic")
     .partitionBy(*partitions).save(path))


def write_bronze(df: DataFrame, root: str, dataset: str, run_id: str, source: str) -> None:
    """Add the raw rows of one run with ingest time, source and run id.

    Each run has its own partition: other runs are never touched and repeating a
    run replaces its rows instead of doubling them.
    """
    stamped = (df.withColumn("_ingest_ts", F.current_timestamp())
               .withColumn("_source", F.lit(source)).withColumn("_run_id", F.lit(run_id)))
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", CODEC)
     .partitionBy("_run_id").parquet(layer_path(root, "bronze", dataset)))


def write_silver(df: DataFrame, root: str, dataset: str, partitions: Sequence[str] = (),
                 whole: bool = False, few: bool = False) -> None:
    """Replace the written partitions of a silver table; all of it if it was rebuilt as a whole. ``few`` as in ``_write``."""
    _write(df, layer_path(root, "silver", dataset), partitions, whole=whole, few=few)


def write_gold(df: DataFrame, root: str, mart: str, name: str,
               partitions: Sequence[str] = (), whole: bool = False, few: bool = False) -> None:
    """Replace the written partitions of a gold result table; all of it if it was rebuilt as a whole."""
    _write(df, layer_path(root, "gold", f"{mart}/{name}"), partitions, whole=whole, few=few)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Catalog table bucketed and sorted by ``keys``: later joins and aggregates
    on them need no shuffle."""
    (df.write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))


def _existing(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table under its own types: a partition value 01 of a text column stays 01."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def upsert(path: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str],
           partitions: Sequence[str] = ()) -> None:
    """Put ``updates`` into a Parquet table, latest row of each key by ``order`` wins.

    Partition columns must be part of the key, so that a key never moves between
    partitions. Only touched partitions are read and rewritten, from a copy in the
    scratch folder, since a plan must not overwrite what it reads. Running it
    again with the same updates changes nothing.
    """
    if not set(partitions) <= set(keys):
        raise ValueError("partition columns must belong to the key")
    merged = updates = kept(dedup(updates, keys, order))
    target = _existing(updates.sparkSession, path, updates.schema)
    if target is not None:
        if partitions:
            # A join, as an update may touch any number of folders.
            touched = updates.select(*partitions).distinct().alias("u")
            same = [F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}")) for c in partitions]
            target = target.alias("t").join(touched, same, "left_semi")
        merged = kept(dedup(target.select(*updates.columns).unionByName(updates), keys, order))
    _write(merged, path, partitions)


def merge_table(table: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> None:
    """The same upsert by MERGE, for a catalog table whose format supports it."""
    view = f"_merge_updates_{uuid4().hex}"
    dedup(updates, keys, order).createTempView(view)
    match = " AND ".join(f"t.`{k}` <=> u.`{k}`" for k in keys)
    t, u = (f"struct({', '.join(f'{a}.`{c}`' for c in order)})" for a in "tu")
    try:
        updates.sparkSession.sql(
            f"MERGE INTO {table} t USING {view} u ON {match} "
            f"WHEN MATCHED AND {u} >= {t} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
    finally:
        updates.sparkSession.catalog.dropTempView(view)


def publish(df: DataFrame, table: str, url: str | None = None, as_view: bool = False,
            path: str | None = None, **options) -> None:
    """Publish a gold table to the warehouse: JDBC with ``url``, else a table of the catalog, whose files lie in its
    warehouse or at ``path``; publishing again replaces it. ``as_view`` only names the frame for this session."""
    if url:
        df.write.mode("overwrite").option("truncate", "true").jdbc(url, table, properties=options)
    elif as_view:
        df.createOrReplaceTempView(table)
    else:
        writer = df.write.mode("overwrite")
        (writer.option("path", path) if path else writer).saveAsTable(table)


def export_report(df: DataFrame, path: str, fmt: str, report_date: date | str) -> None:
    """Report files of one date as csv or json; other dates stay as they are."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"unknown report format {fmt!r}")
    dated = df.withColumn("report_date", F.lit(str(report_date)))
    options = {"header": "true"} if fmt == "csv" else {}
    _write(dated, path, ["report_date"], fmt, **options)
