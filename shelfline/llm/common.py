"""Helpers the corpus operators share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path
from zipfile import ZipFile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.session import settle

# Words are runs of anything but the space and the five ASCII controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"

# Python workers get batches of at most this many rows and about so many bytes.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of the corpus operators: a query's shuffle files go when it has ended, as texts are large."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return settle(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table of a folder, in a settled session."""
    prepare(spark)
    return settle(spark).read.parquet(f"{sf_dir}/documents.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as they may not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with ZipFile(archive, "w") as out:
            for path in package.rglob("*.py"):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def by_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
               schema: str) -> DataFrame:
    """``mapInArrow`` in small batches, so that long texts do not pile up in a worker."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(work, schema)


def with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    """The batch with one more column; a column of that name is replaced."""
    names = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [column], [*names, name])


def widened(df: DataFrame, *added: str) -> str:
    """DDL of a frame with columns added; those of the same name give way."""
    names = {a.split()[0].strip("`") for a in added}
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in names]
    return ", ".join([*kept, *added])


def n_words(text: str):
    """Number of words of a text column; null counts as empty."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
