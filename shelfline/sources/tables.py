"""Batch readers. Every reader takes an explicit schema; none infers one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfline.operators.quality import CORRUPT
from shelfline.schemas import LAYERS, MARKET_TREND, SALE
from shelfline.session import kept


def read_files(spark: SparkSession, path: str, schema: StructType,
               fmt: str = "parquet", **options) -> DataFrame:
    """Files under a fixed schema; ``fmt`` is parquet, json, csv or orc."""
    if fmt == "csv":
        options = {"header": "true", **options}
    return spark.read.format(fmt).options(**options).schema(schema).load(path)


def read_checked(spark: SparkSession, path: str, schema: StructType,
                 fmt: str, **options) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed) of csv or json files; the second has the whole text of each bad ``record``.

    The files are parsed once, into the scratch folder, as both frames come from the same pass.
    """
    wide = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    parsed = kept(read_files(spark, path, wide, fmt, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options))
    bad = F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad).select(F.col(CORRUPT).alias("record"))


def read_jdbc(spark: SparkSession, url: str, table: str, key: str,
              lower: int, upper: int, partitions: int, **options) -> DataFrame:
    """A database table read in parallel key ranges."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=options)


def read_sales(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Internal sales."""
    return read_files(spark, path, SALE, fmt, **options)


def read_market(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Market price trends by category and month."""
    return read_files(spark, path, MARKET_TREND, fmt, **options)


def layer_path(root: str, layer: str, dataset: str) -> str:
    """Folder of a dataset; unknown names are refused."""
    if dataset.split("/")[0] not in LAYERS.get(layer, ()):
        raise ValueError(f"no dataset {dataset!r} in layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{dataset}"


def read_layer(spark: SparkSession, root: str, layer: str, dataset: str,
               schema: StructType | None = None) -> DataFrame:
    """A layer table; filters on its partition columns prune folders."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(layer_path(root, layer, dataset))
