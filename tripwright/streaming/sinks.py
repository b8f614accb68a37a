"""Sinks of micro-batches."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripwright.operators.messages import key_counts
from tripwright.operators.tables import latest_per_key
from tripwright.sources.tables import layouts, write_versions

Forward = Callable[[DataFrame, int], None]

PROGRESS = "profile string, batch bigint, stime timestamp, etime timestamp, elapsed bigint"
PROGRESS_COLUMNS = ("profile", "batch", "stime", "etime", "elapsed")


def upsert_batch(
    frame: DataFrame, root: str, name: str, batch_id: int, day: Column | None = None
) -> None:
    """Write the rows of a batch, one per key; an empty batch writes nothing.

    Of equal keys inside a batch the one created last stays, and if that is equal too the higher
    row content, so a repeated run chooses the same row.
    """
    if frame.isEmpty():
        return
    layout = layouts()[name]
    created = frame.withColumn("_created", F.col("created_time").try_cast("bigint"))
    single = latest_per_key(created, layout.keys, ["_created"]).drop("_created")
    write_versions(single, root, name, batch_id, layout.day if day is None else day)


def kafka_forward(servers: str, topic: str) -> Forward:
    """Send keyed messages to a topic. A repeated batch sends its messages again."""

    def send(messages: DataFrame, batch_id: int) -> None:
        (
            messages.select("key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .save()
        )

    return send


def folder_forward(folder: str) -> Forward:
    """Write keyed messages as parquet files that ``file_messages`` reads."""

    def send(messages: DataFrame, batch_id: int) -> None:
        if not messages.isEmpty():
            messages.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return send


def write_progress(
    spark: SparkSession, root: str, profile: str, batch_id: int, started: datetime
) -> None:
    """One row per finished batch: when it ran and how long."""
    ended = datetime.now(UTC)
    elapsed = int((ended - started).total_seconds() * 1000)
    row = spark.createDataFrame(
        [(profile, batch_id, started, ended, elapsed)], PROGRESS
    )
    row.coalesce(1).write.mode("overwrite").parquet(
        f"{root}/streaming_history/app={profile}/batch_id={batch_id}"
    )


def progress_state(spark: SparkSession, root: str) -> DataFrame:
    """The last finished batch of every application."""
    history = spark.read.schema(PROGRESS).parquet(f"{root}/streaming_history")
    return latest_per_key(history.select(*PROGRESS_COLUMNS), ["profile"], ["batch"])


def print_rows(frame: DataFrame, rows: int = 20, name: str | None = None) -> StreamingQuery | None:
    """Show a frame, or start a console query for a stream."""
    if not frame.isStreaming:
        frame.show(rows, truncate=False)
        return None
    writer = frame.writeStream.format("console").option("numRows", rows).option("truncate", False)
    return (writer.queryName(name) if name else writer).start()


def start_key_counts(
    messages: DataFrame, name: str, sink: str = "console", checkpoint: str | None = None
) -> StreamingQuery:
    """Running count of messages per key. The state is one number per key."""
    writer = key_counts(messages).writeStream.outputMode("complete").format(sink).queryName(name)
    if checkpoint:
        writer = writer.option("checkpointLocation", f"{checkpoint}/{name}")
    return writer.start()
