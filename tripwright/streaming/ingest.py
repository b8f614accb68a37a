"""Ingest application: messages of one topic into the stored tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tripwright.operators.messages import (
    fill_texts,
    flatten_events,
    flatten_microtrips,
    flatten_trips,
    parse_events,
    parse_microtrips,
    parse_trips,
    to_score,
)
from tripwright.streaming.sinks import Forward, upsert_batch, write_progress

NAME = "ingest"


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    forward: Forward | None = None,
    fill_empty: bool = False,
) -> None:
    """Write one batch of keyed messages to all tables and forward its finished trips.

    Micro-trips and events are written twice, filed by trip and by time, for the two score
    applications. Rows without key cannot be stored and are left out.
    """
    started = datetime.now(UTC)
    batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        microtrips = flatten_microtrips(parse_microtrips(batch))
        events = flatten_events(parse_events(batch))
        trips = flatten_trips(parse_trips(batch))
        for rows, names in (
            (microtrips, ("sf_microtrip", "microtrip_by_vehicle")),
            (events, ("sf_event", "event_by_vehicle")),
            (trips, ("sf_trip",)),
        ):
            stored = rows.dropna(subset=["key1"])
            for name in names:
                upsert_batch(fill_texts(stored) if fill_empty else stored, root, name, batch_id)
        if forward is not None:
            forward(to_score(batch), batch_id)
    finally:
        batch.unpersist()
    write_progress(batch.sparkSession, root, NAME, batch_id, started)


def start_ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    forward: Forward | None = None,
    fill_empty: bool = False,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Run the ingest application; the default trigger is every 5 seconds."""
    return (
        messages.writeStream.queryName(NAME)
        .option("checkpointLocation", f"{checkpoint}/{NAME}")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .foreachBatch(lambda batch, n: ingest_batch(batch, n, root, forward, fill_empty))
        .start()
    )
