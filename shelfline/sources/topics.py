"""Event topics as streaming (or, for replays, static) frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.operators.quality import split_corrupt
from shelfline.schemas import EVENT_FILE, PRICE_EVENT, TOPICS

TOPIC_OF_TYPE = {
    "purchase": "price-changes",
    "click": "promotion-events",
    "view": "market-trends",
}


def price_events(events: DataFrame) -> DataFrame:
    """Raw event rows to the price_event contract; other event types are left out."""
    topic = F.create_map(*[F.lit(x) for pair in TOPIC_OF_TYPE.items() for x in pair])
    return events.filter(F.col("event_type").isin(*TOPIC_OF_TYPE)).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.element_at(topic, F.col("event_type")).alias("topic"),
        F.col("user_id").alias("product_id"),
        (F.col("event_id") % 5).alias("retailer_id"),
        F.col("value").alias("new_price"),
        F.col("props").alias("payload"),
    )


def read_events(spark: SparkSession, folder: str, streaming: bool = True,
                files_per_trigger: int | None = None, pattern: str = "*.parquet") -> DataFrame:
    """All raw events of the files in a folder whose names fit ``pattern``."""
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.schema(EVENT_FILE).option("pathGlobFilter", pattern).parquet(folder)


def read_topic(spark: SparkSession, topic: str, folder: str | None = None,
               servers: str | None = None, streaming: bool = True,
               per_trigger: int | None = None, pattern: str = "*.parquet",
               **options) -> DataFrame:
    """Events of one topic in the price_event contract.

    With ``servers`` the topic is read from a broker and the message value is
    parsed as JSON (``parse_messages`` also gives the malformed ones); with ``folder`` landed files are replayed. ``per_trigger``
    limits a micro-batch: offsets for a broker, files for a folder.
    """
    if topic not in TOPICS[:3]:
        raise ValueError(f"unknown input topic {topic!r}")
    if servers is None:
        events = price_events(read_events(spark, folder, streaming, per_trigger, pattern))
        return events.filter(F.col("topic") == topic)
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    if per_trigger and streaming:
        options["maxOffsetsPerTrigger"] = per_trigger
    reader = spark.readStream if streaming else spark.read
    raw = reader.format("kafka").options(**options).load()
    return parse_messages(raw, topic)[0]


def parse_messages(raw: DataFrame, topic: str) -> tuple[DataFrame, DataFrame]:
    """(events, malformed) of the messages of a topic, whose column ``value`` holds JSON.

    Messages that are no JSON or break the event contract go to the second frame as text, so none turns
    into an event of nulls; messages without a value are deletions and hold no event.
    """
    texts = raw.filter("value IS NOT NULL").select(F.col("value").cast("string").alias("value"))
    events, malformed = split_corrupt(texts, "value", PRICE_EVENT)
    return tuple(df.withColumn("topic", F.lit(topic)) for df in (events, malformed))


def replay(spark: SparkSession, topic: str, folder: str, streaming: bool = True, per_trigger: int | None = None,
           pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """(events, malformed) of a topic's messages landed as files of one JSON text a line.

    The same contract as over a broker: what breaks it comes out as text in the second frame.
    """
    if topic not in TOPICS[:3]:
        raise ValueError(f"unknown input topic {topic!r}")
    reader = spark.readStream if streaming else spark.read
    if streaming and per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return parse_messages(reader.option("pathGlobFilter", pattern).text(folder), topic)


def all_events(*topics: DataFrame) -> DataFrame:
    """One frame over several topics; columns missing in one are null."""
    first, *rest = topics
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
