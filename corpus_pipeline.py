"""A pipeline from raw documents to token ids; each stage works on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import bpe, mixing, quality, secrets, simhash
from shelfline.session import kept, settle

# Columns of documents, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near enough to their language's reference.

    A verdict depends on text and language alone, so the document's id finds it; ids that stand for
    several rows keep those whose own text and language passed. Null ids and languages are values like any other, null and
    empty texts fail, an empty table stays empty, and columns that documents do not have are left out.
    """
    key = F.xxhash64("doc_id", "text", "lang").alias("_key")
    verdicts = quality.measured(docs.select(F.struct("doc_id", key).alias("at"), "text", "lang"), id="at")
    passed = verdicts.filter("kept").select("at.*").distinct()
    keyed = docs.select(*COLUMNS, key).alias("d")
    on = F.col("d._key").eqNullSafe(F.col("p._key")) & F.col("d.doc_id").eqNullSafe(F.col("p.doc_id"))
    return keyed.join(passed.alias("p").hint("shuffle_hash"), on, "left_semi").select(*COLUMNS)


def _with_rows(docs: DataFrame) -> DataFrame:
    """The documents, written once, with a number ``row`` of their own; ids may be null or repeat."""
    return kept(docs.select(*COLUMNS, F.xxhash64(*COLUMNS).alias("key"), F.monotonically_increasing_id().alias("row")))


def _one_of_each(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """One row per ``node`` of ``found`` (row, node): of the least id, null last, then the least hash of the row."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "row"))["row"]
    chosen = kept(found.join(keyed.select("row", "doc_id", "key"), "row").groupBy("node").agg(least.alias("row")))
    return keyed.join(chosen.hint("shuffle_hash"), "row", "left_semi").select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: exactly one row, of the least id.

    Components are those of the SimHash operator with the shingles and bits of its contract. Null ids come last, repeated
    ids and rows are rows of their own here, null and empty texts are one component, an empty table stays empty.
    """
    keyed = _with_rows(docs)
    found = simhash.near_duplicates(keyed.select("row", "text"), id="row")
    return _one_of_each(keyed, found.select("row", F.col("component_id").alias("node")))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and n_chars counted anew.

    Null ids, repeated rows and an empty table stay as they are; a null text stays null, and so does its n_chars; other
    columns are left out.
    """
    found = secrets.find_secrets(docs.select(*COLUMNS))
    return (found.withColumn("text", secrets.redacted("text", "spans"))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Null and empty texts have no words and are taken like any other at no cost; a null source is a source, rows that
    repeat draw alike, an empty table stays empty, other columns are left out.
    """
    taken = mixing.mix(docs, keep=COLUMNS[1:])
    copies = F.explode(F.sequence(F.lit(1), F.col("epochs")))
    return taken.filter("epochs > 0").withColumn("copy", copies).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix.

    A null text has no tokens, null ids and sources stay null, a row that repeats has its tokens each time, and an empty
    table has no rows.
    """
    out = bpe.bpe_encode(docs.select("doc_id", "source", "text"))
    return out.select("doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [("quality rules", quality_rules), ("near copies", near_copies), ("secrets", without_secrets),
          ("mix", mixed), ("tokens", tokens)]
# SQL cannot express byte-pair encoding or SimHash; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = settle(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
