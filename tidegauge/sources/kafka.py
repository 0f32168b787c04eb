"""Kafka: source and sink options, and the record format for name counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegauge.functions.scalar import bytes_to_int, int_to_bytes


def source_options(
    brokers: str, topic: str, group: str | None = None, starting: str = "earliest"
) -> dict[str, str]:
    """Reader options.

    ``starting`` is "earliest" or "latest" and matters on a first run only: a
    query with a checkpoint goes on from the offsets kept there. That is also
    how to get "committed offsets, else earliest".
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group is not None:
        options["kafka.group.id"] = group
    return options


def sink_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def stream_names(spark: SparkSession, brokers: str, topic: str, **kwargs) -> DataFrame:
    """Record values as text, with partition, offset and record time."""
    options = source_options(brokers, topic, **kwargs)
    return decode_text(spark.readStream.format("kafka").options(**options).load())


def decode_text(records: DataFrame) -> DataFrame:
    """Only the value is decoded; event time is the record's own."""
    return records.select(
        F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp"
    ).withWatermark("timestamp", "0 seconds")


def encode_counts(counts: DataFrame) -> DataFrame:
    """Key: the name in UTF-8. Value: the count as a four-byte whole number."""
    return counts.select(
        F.encode("name", "UTF-8").alias("key"), int_to_bytes(F.col("count")).alias("value")
    )


def decode_counts(records: DataFrame) -> DataFrame:
    return records.select(
        F.col("key").cast("string").alias("name"),
        bytes_to_int(F.col("value")).alias("count"),
        "partition",
        "offset",
    )


def write_counts(
    counts: DataFrame, brokers: str, topic: str, checkpoint: str
) -> StreamingQuery:
    """Send a live stream of counts to a topic, every three seconds."""
    return (
        encode_counts(counts)
        .writeStream.format("kafka")
        .options(**sink_options(brokers, topic))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime="3 seconds")
        .start()
    )
