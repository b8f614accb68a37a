"""Score applications: finished trips against the stored samples and events.

Nothing is kept in streaming state. A batch names the trips to score; their samples and events
are read from the tables at that moment, so late samples count as soon as the trip comes again,
and a trip that comes twice gives the same result twice.

``start_multi_score`` reads the samples of all trips of a vehicle whenever one comes.
``start_vehicle_score`` gives the same result per vehicle, without event rows and exceeded limits,
from a stored state per trip: a batch reads the samples and events of its own trips only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripwright.functions.ids import millis_date, uuid_millis
from tripwright.operators.devices import base_device_trips
from tripwright.operators.joins import grid_levels
from tripwright.operators.messages import parse_trips, trip_rows
from tripwright.operators.skew import broadcast_if_small
from tripwright.plans.products import trip_norms, vehicle_scores
from tripwright.plans.score import (
    EVENT_SCHEMA,
    RESULT_SCHEMA,
    heavy_tracks,
    latest_trips,
    matched_events,
    matched_samples,
    multi_tie,
    multi_trip_result,
    score_events,
    stored_samples,
    tracks_to_cut,
    trip_result,
    trip_states,
    vehicle_facts,
    vehicle_result,
)
from tripwright.schemas import SCORE_KEY
from tripwright.sources.tables import (
    BATCH,
    DAY,
    NO_DAY,
    Among,
    day_of_trip,
    load_table,
    scan_latest,
    scan_versions,
    write_versions,
)
from tripwright.streaming.sinks import write_progress

SCORE_SCHEMA = (
    "vehicle_id string, user_id string, trip_id string, dist bigint, accel bigint, deaccel bigint, "
    "overlimit bigint, norm_dist double, norm_accel double, norm_deaccel double, "
    "norm_overlimit double, score double"
)
SINGLE = "score"
MULTI = "score_multi"
VEHICLES = "score_vehicle"
PAYLOAD_SCHEMA = "vehicle_id string, trip_id string, payload string"


def batch_trips(batch: DataFrame) -> DataFrame:
    """The trips of a batch, each once."""
    return latest_trips(trip_rows(parse_trips(batch, SCORE_KEY)).where("trip_id IS NOT NULL"))


def days_of_trips(trips: DataFrame) -> DataFrame:
    """Day folders that hold the samples of these trips by trip id."""
    return trips.select(day_of_trip().alias(DAY)).distinct()


def days_of_ranges(trips: DataFrame) -> Column:
    """Day folders that the time ranges of these trips touch.

    A range that ends outside the calendar, which a faulty device may send, is open on that side;
    it adds the days from its start on, and those without a day, and takes nothing from the others.
    """
    first = millis_date(F.col("start_ts")).cast("string")
    last = millis_date(F.col("end_ts")).cast("string")
    ranges = trips.select(first.alias("first"), last.alias("last"))
    known = F.col("first").isNotNull() & F.col("last").isNotNull()
    low, high, since, until, unknown = ranges.agg(
        F.min(F.when(known, F.col("first"))),
        F.max(F.when(known, F.col("last"))),
        F.min(F.when(F.col("last").isNull(), F.col("first"))),
        F.max(F.when(F.col("first").isNull(), F.col("last"))),
        F.coalesce(F.bool_or(F.col("first").isNull() & F.col("last").isNull()), F.lit(False)),
    ).first()
    day = F.col(DAY)
    touched = F.lit(unknown)
    if low is not None:
        touched = touched | day.between(low, high)
    if since is not None:
        touched = touched | (day >= since) | (day == NO_DAY)
    if until is not None:
        touched = touched | (day <= until) | (day == NO_DAY)
    return touched


@contextmanager
def kept(frame: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that a batch uses several times; a lost part is computed again."""
    frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frame
    finally:
        frame.unpersist()


def only(trips: DataFrame, key: str, size: int) -> Among:
    """The rows whose key occurs among the batch's trips."""
    return Among(broadcast_if_small(trips.select(key).distinct(), size), key)


def score_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    target: str,
    roads: DataFrame | None = None,
    zone: str = "UTC",
) -> None:
    """Score the trips of a batch of a one-device fleet and upsert their results."""
    spark, started = batch.sparkSession, datetime.now(UTC)
    with kept(batch_trips(batch)) as trips:
        size = trips.count()
        if size:
            days = days_of_trips(trips)
            own = only(trips, "trip_id", size)
            events = load_table(spark, root, "sf_event", days=days, among=own)
            stored = load_table(spark, root, "sf_microtrip", days=days, among=own)
            with kept(stored) as microtrips:
                heavy = heavy_tracks(microtrips, "trip_id")
                samples = stored_samples(microtrips)
                result = trip_result(
                    trips, samples, events, zone=zone, heavy=heavy, roads=roads
                )
                with kept(result) as result:
                    write_versions(result, target, "trip_stat", batch_id, day_of_trip())
                    scores = trip_norms(result)
                    write_versions(scores, target, "trip_score", batch_id, day_of_trip())
                rows = score_events(trips, samples, roads, heavy=heavy)
                write_versions(rows, target, "gps_event", batch_id, day_of_trip())
    write_progress(spark, target, SINGLE, batch_id, started)


def score_multi_batch(
    batch: DataFrame,
    batch_id: int,
    root: str,
    target: str,
    by: str = "vehicle_id",
    roads: DataFrame | None = None,
    zone: str = "UTC",
) -> None:
    """Score the vehicles of a batch of a many-device fleet and upsert their results.

    The trips of the representative devices are kept in a table of their own, so a vehicle's
    result covers all its trips and not just those of the batch.
    """
    spark, started = batch.sparkSession, datetime.now(UTC)
    own = base_device_trips(batch_trips(batch)).drop("base_device_type")
    with kept(own.where("start_ts <= end_ts")) as own:
        size = own.count()
        if size:
            write_versions(own, target, "scored_trip", batch_id, day_of_trip())
            trips = own
            if by == "vehicle_id":
                known = only(own, "vehicle_id", size)
                trips = current_trips(spark, target, own.schema, known)
            days = days_of_ranges(trips)
            vehicles = only(own, "vehicle_id", size)
            microtrips = load_table(spark, root, "microtrip_by_vehicle", days, among=vehicles)
            events = load_table(spark, root, "event_by_vehicle", days, among=vehicles)
            levels = grid_levels(trips, "start_ts", "end_ts")
            heavy = heavy_tracks(microtrips, "vehicle_id")
            found = matched_events(trips, events, levels=levels)
            with kept(matched_samples(trips, microtrips, levels=levels, heavy=heavy)) as samples:
                result = multi_trip_result(
                    trips, samples, found, by, zone=zone, heavy_vehicles=heavy, roads=roads
                )
                write_versions(result, target, "ms_trip_stat", batch_id, day_of_trip())
                cut = tracks_to_cut(by, heavy)
                rows = score_events(trips, samples, roads, (by,), multi_tie(by), heavy=cut)
                write_versions(rows, target, "ms_gps_event", batch_id, day_of_trip())
    write_progress(spark, target, MULTI, batch_id, started)


def score_vehicle_batch(
    batch: DataFrame, batch_id: int, root: str, target: str, zone: str = "UTC"
) -> None:
    """Bring the results of the batch's vehicles up to date from the states of their trips.

    ``trip_state`` has a row for each trip of each batch, without sums if no sample was found, so
    that a trip that comes again replaces all that is known of it; ``trip_payload`` has the
    different event payloads of those runs. Late samples count when their own trip comes again.
    A vehicle whose trips interleave has no order of segments; the samples of its trips are read.
    """
    spark, started = batch.sparkSession, datetime.now(UTC)
    own = base_device_trips(batch_trips(batch)).drop("base_device_type")
    with kept(own.where("start_ts <= end_ts")) as own:
        size = own.count()
        if size:
            write_versions(own, target, "scored_trip", batch_id, day_of_trip())
            vehicles = only(own, "vehicle_id", size)
            days = days_of_ranges(own)
            stored = load_table(spark, root, "microtrip_by_vehicle", days, among=vehicles)
            heavy = heavy_tracks(stored, "vehicle_id")
            levels = grid_levels(own, "start_ts", "end_ts")
            samples = matched_samples(own, stored, levels=levels, heavy=heavy)
            states = trip_states(samples, heavy_vehicles=heavy)
            every = own.select("vehicle_id", "trip_id").join(states, ["vehicle_id", "trip_id"], "left")
            write_versions(every, target, "trip_state", batch_id, day_of_trip())
            events = load_table(spark, root, "event_by_vehicle", days, among=vehicles)
            found = matched_events(own, events, levels=levels)
            payloads = found.select("vehicle_id", "trip_id", "payload").distinct()
            write_versions(payloads, target, "trip_payload", batch_id, day_of_trip())

            trips = current_trips(spark, target, own.schema, vehicles)
            ddl = columns_ddl(every.schema)
            known = scan_latest(spark, target, "trip_state", ["trip_id"], ddl, among=vehicles)
            known = known.drop(BATCH)

            def samples_of(mixed: DataFrame) -> DataFrame:
                theirs = trips.join(mixed, "vehicle_id", "left_semi")
                more = load_table(
                    spark,
                    root,
                    "microtrip_by_vehicle",
                    days_of_ranges(theirs),
                    among=Among(mixed, "vehicle_id"),
                )
                return matched_samples(theirs, more)

            facts = vehicle_facts(known, samples_of)
            noted = current_payloads(spark, target, vehicles)
            result = vehicle_result(facts, trips, noted, zone)
            write_versions(result, target, "vehicle_stat", batch_id, day_of_trip())
    write_progress(spark, target, VEHICLES, batch_id, started)


def columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def current_payloads(spark: SparkSession, target: str, among: Among) -> DataFrame:
    """Different event payloads of each trip's latest run, for some vehicles."""
    runs = scan_versions(spark, target, "trip_state", "vehicle_id string, trip_id string")
    newest = runs.join(among.rows, among.key, "left_semi").groupBy("trip_id")
    newest = newest.agg(F.max(BATCH).alias(BATCH))
    rows = scan_versions(spark, target, "trip_payload", PAYLOAD_SCHEMA).drop(DAY)
    rows = rows.join(among.rows, among.key, "left_semi")
    return rows.join(newest, ["trip_id", BATCH], "left_semi").drop(BATCH)


def current_trips(
    spark: SparkSession, target: str, schema: StructType, among: Among | None = None
) -> DataFrame:
    ddl = columns_ddl(schema)
    return scan_latest(spark, target, "scored_trip", ["trip_id"], ddl, among=among).drop(BATCH)


def current_results(spark: SparkSession, target: str, name: str, key: str) -> DataFrame:
    """Latest result per trip or vehicle."""
    return scan_latest(spark, target, name, [key], RESULT_SCHEMA)


def current_scores(spark: SparkSession, target: str) -> DataFrame:
    """Latest score row per trip."""
    return scan_latest(spark, target, "trip_score", ["trip_id"], SCORE_SCHEMA)


def current_vehicle_scores(spark: SparkSession, target: str) -> DataFrame:
    """Score per vehicle and user; ``ts`` is the time inside the id of the latest trip."""
    return vehicle_scores(current_scores(spark, target), uuid_millis(F.col("trip_id")))


def current_events(
    spark: SparkSession, target: str, name: str, results: str, key: str = "trip_id"
) -> DataFrame:
    """Event rows of the latest run per trip or vehicle; those of earlier runs are outdated."""
    scored = scan_versions(spark, target, results, RESULT_SCHEMA)
    runs = scored.groupBy(key).agg(F.max(BATCH).alias(BATCH))
    rows = scan_versions(spark, target, name, EVENT_SCHEMA).drop(DAY)
    return rows.join(runs, [key, BATCH], "left_semi").drop(BATCH)


def _start(
    messages: DataFrame,
    name: str,
    checkpoint: str,
    trigger: dict[str, object] | None,
    run: Callable[[DataFrame, int], None],
) -> StreamingQuery:
    """Every message reaches its batch, however late: a trip sent again is taken once there."""
    return (
        messages.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .foreachBatch(run)
        .start()
    )


def start_score(
    messages: DataFrame,
    root: str,
    target: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    **settings: object,
) -> StreamingQuery:
    """Run the one-device score application; the default trigger is every 3 seconds."""

    def run(batch: DataFrame, n: int) -> None:
        score_batch(batch, n, root, target, **settings)

    return _start(messages, SINGLE, checkpoint, trigger, run)


def start_multi_score(
    messages: DataFrame,
    root: str,
    target: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    **settings: object,
) -> StreamingQuery:
    """Run the many-device score application; the default trigger is every 3 seconds."""

    def run(batch: DataFrame, n: int) -> None:
        score_multi_batch(batch, n, root, target, **settings)

    return _start(messages, MULTI, checkpoint, trigger, run)


def start_vehicle_score(
    messages: DataFrame,
    root: str,
    target: str,
    checkpoint: str,
    trigger: dict[str, object] | None = None,
    **settings: object,
) -> StreamingQuery:
    """Run the application that keeps a state per trip; the default trigger is every 3 seconds."""

    def run(batch: DataFrame, n: int) -> None:
        score_vehicle_batch(batch, n, root, target, **settings)

    return _start(messages, VEHICLES, checkpoint, trigger, run)
