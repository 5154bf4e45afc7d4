"""Scan messages from a topic. Everything after `messages` is source-agnostic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.text import bytes_if_no_text, utf8_text


def topic_options(servers: str, topic: str, max_per_batch: int | None = None,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Options of the Kafka source: from the earliest offset, so many messages
    per batch, read by at least so many tasks however few partitions the topic has."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_per_batch is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_batch)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_events_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream of text. Progress is kept in the checkpoint of the
    query that drains it, which takes the place of a consumer group."""
    return messages(spark.readStream.format("kafka").options(**options).load())


def messages(raw: DataFrame) -> DataFrame:
    """Decode `value`, and `key` if there is one; other columns pass through.
    A value that is no text keeps its bytes in `payload_base64`."""
    decoded = {name: utf8_text(F.col(name)) for name in ("key", "value") if name in raw.columns}
    return raw.withColumn("payload_base64", bytes_if_no_text(F.col("value"))).withColumns(decoded)
