"""Streaming sources of keyed messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwright.operators.messages import key_value, route_lines


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    timestamp: bool = False,
    starting: str = "latest",
    **options: str,
) -> DataFrame:
    """Messages of a topic as ``key, value`` text, with the broker time on request.

    Needs Spark's Kafka package on the class path.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
    )
    return key_value(raw, timestamp)


def file_messages(
    spark: SparkSession, folder: str, timestamp: bool = False, files_per_batch: int | None = None
) -> DataFrame:
    """Messages from parquet files with the columns of a topic; a batch takes all new files."""
    schema = "key string, value string"
    if timestamp:
        schema = "timestamp timestamp, " + schema
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def text_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages from recorded text lines, keyed by the kind written in each line."""
    return route_lines(spark.read.text(path))


def drop_resent(messages: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """Drop messages that come again within ``delay`` of broker time.

    The state holds only that span of keys, so it does not grow with the stream.
    """
    return messages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(
        ["key", "value"]
    )
