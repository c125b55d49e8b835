"""Silver and gold brought up to date from new bronze runs only.

Bronze is landed run by run. A step here takes the runs that it has not seen and writes

* an *increment* of silver: the checked rows of these runs that no earlier increment has.
* the increment's *states* in gold: sums, counts, extremes and latest rows, which merge with those of
  earlier increments, and the history of the keys that the increment touches, computed again from all their rows and
  written from the interval in which its first price falls.

New rows and earlier ones of the touched keys are shuffled once, by key; all of these tables are written from that one
placing of the rows. A ledger says which runs are in, each with a mark of its files and one of its rows. A run that was
delivered again with the same rows in other files is only marked anew; one with other rows cannot be taken out of sums, so then
everything is built anew. A step that broke off is run again under its old number and replaces what it wrote.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfline.functions.ordered import OrderedGroups
from shelfline.operators import price, quality
from shelfline.schemas import OBSERVED_ORDER, PRICE_OBSERVATION, schema_of
from shelfline.session import CODEC, dropped, kept, scratch_scope
from shelfline.sources.tables import layer_path, read_layer
from shelfline.streaming.generations import BatchTable, added_up, listed, newest, replaced

KEYS = ["product_id", "retailer_id"]
_STREAM = "bronze"
# Up to so many touched keys are looked up in the earlier rows before those are shuffled.
FEW_KEYS = 1_000_000
# The mark of a run without rows, and how many keys it has.
_NONE = ("0", 0)
_LEDGER = schema_of("run string, mark string, content string")
_SILVER = schema_of("product_id bigint, retailer_id bigint, observed_at timestamp, price double, "
                    "order_id bigint, line_no int, step int")
_MONTHLY = schema_of("product_id bigint, retailer_id bigint, month timestamp, n bigint, total double, "
                     "min_price double, max_price double")
_HISTORY = schema_of("product_id bigint, retailer_id bigint, price double, valid_from timestamp, valid_to timestamp, "
                     "since timestamp")


def landed_runs(spark: SparkSession, root: str, dataset: str) -> dict[str, str]:
    """A mark of the files of each run of a bronze dataset, by the name of the run's folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{layer_path(root, 'bronze', dataset)}/_run_id=*/*.parquet")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    files: dict[str, list[str]] = {}
    for status in found or []:
        path = str(status.getPath())
        files.setdefault(path.rsplit("/", 2)[1], []).append(f"{path.rsplit('/', 1)[1]}:{status.getLen()}")
    return {run: hashlib.md5("\n".join(sorted(names)).encode()).hexdigest() for run, names in files.items()}


def _contents(rows: DataFrame) -> dict[str, tuple[str, int]]:
    """By run a mark of its rows, whatever their order and files, and about how many keys they have."""
    names = PRICE_OBSERVATION.names
    sums = [F.sum(F.xxhash64(F.lit(seed), *names).cast("decimal(38,0)")) for seed in (0, 1)]
    found = rows.groupBy("_run_id").agg(
        F.concat_ws(":", F.count(F.lit(1)), *sums).alias("content"),
        F.approx_count_distinct(F.xxhash64(*KEYS)).alias("keys")).collect()
    return {r["_run_id"]: (r["content"], r["keys"]) for r in found}


def _run_id(folder: str) -> str:
    """The id of a run by its folder, in whose name Spark writes special characters as %XX."""
    return unquote(folder.split("=", 1)[1])


class PriceTables:
    """Silver and gold of the prices in one bronze dataset, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, dataset: str = "competitors"):
        self.spark, self.root, self.dataset = spark, root, dataset
        self.path = f"{root}/incremental/{dataset}"
        table = lambda name, schema, keys, merge, *zone: BatchTable(
            spark, f"{self.path}/{name}", schema, keys, merge, *zone)
        self.ledger = table("ledger", _LEDGER, ["run"], newest(["run"], [], by_batch=True))
        self.current = table("current", PRICE_OBSERVATION, KEYS, newest(KEYS, OBSERVED_ORDER))
        monthly = [*KEYS, "month"]
        # Extremes are kept where there is more than one price; that of one price is the total.
        extreme = lambda pick: lambda c: F.when(F.sum("n") > 1, pick(F.coalesce(F.col(c), F.col("total"))))
        self.monthly = table("monthly", _MONTHLY, monthly, added_up(
            monthly, {"n": F.sum, "total": F.sum, "min_price": extreme(F.min), "max_price": extreme(F.max)}), "month")
        self.history = table("history", _HISTORY, KEYS, replaced(KEYS, "valid_to", "since"))
        self.tables = (self.current, self.monthly, self.history)

    def _increments(self, first: int, end: int) -> DataFrame:
        """The silver rows of the steps from ``first`` on, before ``end``."""
        if not any(first <= n < end for n in self._written()):
            return self.spark.createDataFrame([], _SILVER)
        rows = self.spark.read.schema(_SILVER).parquet(f"{self.path}/silver")
        return rows.filter((F.col("step") >= first) & (F.col("step") < end))

    def _written(self) -> list[int]:
        """Numbers of the steps that have silver rows on disk."""
        return [int(n) for n in listed(self.spark, f"{self.path}/silver/step=*", "=")]

    def _steps(self) -> tuple[dict[str, tuple[str, str]], int]:
        """Marks of the files and the rows of the runs that are in, and the number of the next step."""
        done = [n for _, n in self.ledger.batches()]
        return {r["run"]: (r["mark"], r["content"]) for r in self.ledger.read().collect()}, max(done, default=-1) + 1

    def _landed_rows(self, runs: list[str]) -> DataFrame:
        """The rows of runs in bronze, with the run's id as the text it is."""
        base = layer_path(self.root, "bronze", self.dataset)
        paths = [f"{base}/{run}" for run in runs]
        schema = StructType([*self.spark.read.parquet(*paths).schema, StructField("_run_id", StringType())])
        return quality.conform(self.spark.read.schema(schema).option("basePath", base).parquet(*paths), PRICE_OBSERVATION, True)

    def _touched(self, rows: DataFrame, new: DataFrame) -> DataFrame:
        """The rows whose key is among those of ``new``."""
        keys = kept(new.select(*KEYS).distinct())
        on = [F.col(f"s.{k}").eqNullSafe(F.col(f"k.{k}")) for k in KEYS]
        return rows.alias("s").join(keys.alias("k"), on, "left_semi")

    def step(self) -> dict[str, int]:
        """Take the new runs in; returns their number and the rows that silver got."""
        spark, landed = self.spark, landed_runs(self.spark, self.root, self.dataset)
        known, number = self._steps()
        again = [run for run, (mark, _) in known.items() if landed.get(run) != mark]
        same = set(again) <= set(landed)
        if again and same:
            found = _contents(self._landed_rows(again))
            same = all(found.get(_run_id(run), _NONE)[0] == known[run][1] for run in again)
        if not same:
            dropped(spark, self.path)
            known, number, again = {}, 0, []
        new = sorted(set(landed) - set(known))
        entries = [(run, landed[run], known[run][1]) for run in again]
        if not new:
            if entries:
                self.ledger.put(spark.createDataFrame(entries, _LEDGER), _STREAM, number)
            return {"runs": 0, "rows": 0}
        with scratch_scope(spark):
            rows = self._landed_rows(new)
            contents = _contents(rows)
            names = PRICE_OBSERVATION.names
            good = rows.filter("product_id IS NOT NULL AND observed_at IS NOT NULL AND price > 0").select(
                *names, F.lit(1).alias("_new"))
            old = self._increments(0, number).select(*names, F.lit(0).alias("_new"))
            few = sum(keys for _, keys in contents.values()) <= FEW_KEYS
            if few:
                old = self._touched(old, good)
            both = old.unionByName(good)
            hot = OrderedGroups(both, KEYS, OBSERVED_ORDER).hot is not None
            if hot and not few:
                both = self._touched(old, good).unionByName(good)
            # Placed by key, which all that follows keeps to; a hot key stays spread.
            placed = both if hot else both.repartition(*KEYS)
            # Copies are one row, new if no earlier increment has it.
            single = placed.groupBy(*names).agg(F.min("_new").alias("_new")).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                added = single.filter("_new = 1").select(*names)
                added.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.path}/silver/step={number}")
                self.current.put(added, _STREAM, number)
                month = F.date_trunc("month", "observed_at")
                self.monthly.put(added.withColumn("month", month).groupBy(*KEYS, "month").agg(
                    F.count(F.lit(1)).alias("n"), F.sum("price").alias("total"), F.min("price").alias("min_price"),
                    F.max("price").alias("max_price")), _STREAM, number)
                # A key whose rows all came before is not touched.
                any_new = F.max("_new").over(Window.partitionBy(*KEYS))
                whole = self._touched(single, added) if hot or few else single.withColumn("_any", any_new).filter("_any = 1")
                # Intervals that end before the first new price are as they were.
                since = added.agg(F.min(F.unix_micros("observed_at"))).first()[0]
                changed = price.price_history(whole.select(*names)).withColumn("since", F.timestamp_micros(F.lit(since).cast("bigint")))
                self.history.put(changed.filter("valid_to IS NULL OR valid_to >= since"), _STREAM, number)
            finally:
                single.unpersist()
            entries += [(run, landed[run], contents.get(_run_id(run), _NONE)[0]) for run in new]
            self.ledger.put(spark.createDataFrame(entries, _LEDGER), _STREAM, number)
            return {"runs": len(new), "rows": self._increments(number, number + 1).count()}

    def fold(self) -> None:
        """Fold the states of all steps that the ledger has; those of a broken step stay out."""
        _, number = self._steps()
        for table in self.tables:
            table.fold((_STREAM, number))

    def prices(self) -> DataFrame:
        """All silver rows."""
        _, number = self._steps()
        return self._increments(0, number).select(*PRICE_OBSERVATION.names)

    def _done(self, table: BatchTable) -> DataFrame:
        return table.read((_STREAM, self._steps()[1]))

    def current_price(self) -> DataFrame:
        """The current price of each product and retailer."""
        return self._done(self.current)

    def monthly_prices(self) -> DataFrame:
        """Count, mean and extremes of the prices of each product, retailer and month."""
        return self._done(self.monthly).select(
            *KEYS, "month", "n", (F.col("total") / F.col("n")).alias("avg_price"),
            *[F.coalesce(c, "total").alias(c) for c in ("min_price", "max_price")])

    def price_history(self) -> DataFrame:
        """Validity intervals of each price."""
        return self._done(self.history).drop("since")
