"""Price changes, alerts and the live price table of streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from shelfline.functions.ordered import GROUP_ROWS, OrderedGroups
from shelfline.schemas import ALERT, schema_of
from shelfline.session import kept, scratch, scratch_scope, settle
from shelfline.streaming.generations import BatchTable, newest, stream_id

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ["product_id", "retailer_id"]
LAST = schema_of("product_id bigint, retailer_id bigint, event_id bigint, event_time timestamp, new_price double")


def stream_session(spark: SparkSession) -> SparkSession:
    """A sister session for streaming queries, with RocksDB state.

    The number of state partitions is fixed for the life of a checkpoint: ``spark.shelfline.stream.partitions``, or
    the width of shuffles if that is not set. Sessions are merged where their events are read, before the
    shuffle, so that a busy key sends one row a burst and task.
    """
    sister = settle(spark.newSession())
    parts = spark.conf.get("spark.shelfline.stream.partitions", None) or spark.conf.get("spark.sql.shuffle.partitions")
    sister.conf.set("spark.sql.shuffle.partitions", parts)
    sister.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    sister.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return sister


def changes_of(events: DataFrame, last: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Every price that follows another one of its product and retailer, in a batch of events.

    Events are taken by (event_time, event_id); ``last`` (product_id, retailer_id, new_price) has the price
    before the batch, which comes first whatever its time. Null prices are left out; a change
    from zero has a null percentage. A key with more than ``group_rows`` events is cut into slices.
    """
    least = F.lit(-(1 << 62))
    rows = events.filter("new_price IS NOT NULL").select(
        "product_id", "retailer_id", "event_id", "event_time", "new_price", F.lit(1).alias("_new"),
        F.coalesce(F.unix_micros("event_time"), least).alias("_at"), F.coalesce("event_id", least).alias("_tie"))
    known = last.select("product_id", "retailer_id", F.lit(None).cast("bigint").alias("event_id"),
                        F.lit(None).cast("timestamp").alias("event_time"), "new_price", F.lit(0).alias("_new"),
                        least.alias("_at"), least.alias("_tie"))
    stacked = rows.unionByName(known)
    groups = OrderedGroups(stacked, KEYS, ["_new", "_at", "_tie", "new_price"], group_rows)
    found = groups.shift(stacked, {"old_price": "new_price"}).filter("_new = 1 AND old_price IS NOT NULL")
    pct = (F.col("new_price") - F.col("old_price")) / F.nullif("old_price", F.lit(0.0))
    return found.withColumn("pct", pct).select(*ALERT.names)


def detect_changes(stream: DataFrame, path: str, checkpoint: str, threshold: float | None = None,
                   send: Callable[[DataFrame, str], None] | None = None, fold_every: int = 64) -> DataStreamWriter:
    """Writer of all price changes of a stream to ``path``, and of alerts through ``send``.

    Each micro-batch is compared within itself and with the last price of its keys, which lie in a table beside the
    checkpoint (``checkpoint``-state); a batch replaces what a first try of it wrote, in changes and state. The
    state grows by the latest rows of a batch and is folded every ``fold_every`` batches; a batch reads it
    once and shuffles only the rows of its own keys. An event that arrives in a later batch than its
    successor is compared with the newer price. ``send`` gets a batch's changes of at least ``threshold``
    with a name that is the same when the batch is run again.
    """
    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = stream_id(spark, checkpoint)
        state = BatchTable(spark, f"{checkpoint.rstrip('/')}-state/{name}", LAST, KEYS,
                           newest(KEYS, ["event_time", "event_id"], by_batch=True))
        if number and number % fold_every == 0:
            state.fold((name, number))
        with scratch_scope(spark):
            events = kept(batch.filter("new_price IS NOT NULL").select(*LAST.names))
            last = state.read((name, number), events.select(*KEYS).distinct())
            found = changes_of(events, kept(last))
            written = f"{path}/{name}/{number}"
            found.write.mode("overwrite").parquet(written)
            state.put(events, name, number)
            if send:
                read = spark.read.schema(ALERT).parquet(written)
                send(read if threshold is None else alerts(read, threshold), f"{name}/{number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """The changes that ``detect_changes`` wrote."""
    try:
        return spark.read.schema(ALERT).parquet(f"{path}/*/*")
    except AnalysisException as error:  # nothing written yet
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], ALERT)
        raise


def alerts(changes: DataFrame, threshold: float = 0.1) -> DataFrame:
    """Changes of at least ``threshold`` in either direction."""
    return changes.filter(F.abs("pct") >= threshold)


def as_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as topic messages: key per product and retailer, JSON value."""
    return alerts.select(
        F.concat_ws("-", "product_id", "retailer_id").alias("key"),
        F.to_json(F.struct(*alerts.columns), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
        .alias("value"))


def send_alerts(path: str | None = None, servers: str | None = None) -> Callable[[DataFrame, str], None]:
    """A ``send`` of ``detect_changes``: messages to the alerts topic (``servers``) or to files (``path``).

    Files of a batch that is run again are replaced; a topic gets its messages again, as topics deliver at least once.
    """
    def send(found: DataFrame, name: str) -> None:
        messages = as_messages(found)
        if servers:
            (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("topic", "alerts").save())
        else:
            messages.write.mode("overwrite").parquet(f"{path}/{name}")

    return send


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The messages that ``send_alerts`` wrote to files."""
    return spark.read.schema("key string, value string").parquet(f"{path}/*/*")


def _live(spark: SparkSession, path: str) -> BatchTable:
    return BatchTable(spark, path, LAST, KEYS, newest(KEYS, ["event_time", "event_id"]))


def live_prices(stream: DataFrame, path: str, checkpoint: str, fold_every: int = 64) -> DataStreamWriter:
    """Keep the latest price per key for dashboards.

    Each micro-batch is cut to its latest row per key and replaces the folder of its own number, so a
    repeated batch changes nothing and a batch costs only its own size; every ``fold_every`` batches are
    folded into a new generation of the table. Streams with checkpoints of their own may share a table.
    """
    def put(batch: DataFrame, number: int) -> None:
        table, name = _live(batch.sparkSession, path), stream_id(batch.sparkSession, checkpoint)
        if number and number % fold_every == 0:
            table.fold((name, number))
        table.put(batch.filter("new_price IS NOT NULL"), name, number)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)


def read_live(spark: SparkSession, path: str) -> DataFrame:
    """Current price of each product and retailer."""
    return _live(spark, path).read()


def fold_live(spark: SparkSession, path: str, table_path: str | None = None) -> int:
    """Fold the batches of the live table; returns the generation that is current now.

    With ``table_path`` the live prices are also put into a table partitioned by retailer.
    """
    from shelfline.sinks.layers import upsert

    number = _live(spark, path).fold()
    if table_path:
        upsert(table_path, read_live(spark, path), ["retailer_id", "product_id"],
               ["event_time", "event_id"], ["retailer_id"])
    return number


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Run a streaming writer until all input present at its start is consumed."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drained(stream: DataFrame) -> DataFrame:
    """Run an append stream over all its present input and read what it wrote."""
    spark = stream.sparkSession
    path = scratch(spark)
    run_available(stream.writeStream.format("parquet").option("path", f"{path}/rows")
                  .option("checkpointLocation", f"{path}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")


def progress(query: StreamingQuery) -> list[dict]:
    """Rows and duration in milliseconds of the recent micro-batches of a query."""
    return [{"batch_id": p["batchId"], "rows": p["numInputRows"],
             "milliseconds": p["durationMs"].get("triggerExecution", 0)}
            for p in query.recentProgress]
