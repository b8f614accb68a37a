"""The two score results, as plans over trips, micro-trips and events."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.operators.devices import base_device_trips
from tripwright.operators.events import (
    all_events,
    event_rows,
    from_satellite,
    over_limit,
    with_traffic_event,
)
from tripwright.operators.joins import grid_levels, range_join
from tripwright.operators.kinematics import with_moves
from tripwright.operators.payloads import explode_samples, parse_samples, parse_trip_payload
from tripwright.operators.points import sample_time
from tripwright.operators.rollups import EVENT_COUNTS, track_facts
from tripwright.operators.segments import (
    COUNTED,
    FOUND,
    interleaved,
    segment_facts,
    track_segments,
)
from tripwright.operators.sequence import with_pieces
from tripwright.operators.skew import (
    ROWS_PER_TASK,
    HeavyKeys,
    checkpointed,
    heavy_keys,
)
from tripwright.operators.stats import event_stats, stat_rows
from tripwright.operators.tables import latest_per_key
from tripwright.schemas import COUNTERS, SPEED_WINDOW, TEXTS

SAMPLE_TIE = ("micro_trip_id", "pos")
TRIP_IDS = ("vehicle_id", "user_id", "company_id", "sensor_id", "device_type")
TRIP_COLUMNS = ("trip_id", *TRIP_IDS, "start_ts", "end_ts", "trip_payload_str")
RESULT = (
    "trip_id",
    "mtrip_cnt",
    *TRIP_IDS,
    "trip_dist",
    "device_dist",
    "date",
    *COUNTERS,
    *TEXTS,
    *["n_" + e for e in EVENT_COUNTS],
)

RESULT_SCHEMA = ", ".join(
    f"{name} {'string' if name in ('trip_id', 'date', *TRIP_IDS, *TEXTS) else 'bigint'}"
    for name in RESULT
)
EVENT_SCHEMA = (
    "vehicle_id string, user_id string, trip_id string, pos_lon double, pos_lat double, "
    "event_ts bigint, event_type int, speed_mh bigint, info string, device_type string, "
    "created_time bigint, id string, source string"
)


def latest_trips(trips: DataFrame) -> DataFrame:
    """One row per trip: a trip that was sent again counts once, in its last version."""
    version = [c for c in ("timestamp", "_created", "end_ts") if c in (*trips.columns, "_created")]
    if "trip_created_time" not in trips.columns:
        return latest_per_key(trips, ["trip_id"], [c for c in version if c != "_created"])
    created = trips.withColumn("_created", F.col("trip_created_time").try_cast("bigint"))
    return latest_per_key(created, ["trip_id"], version).drop("_created")


def stored_samples(microtrips: DataFrame, extra: Sequence[str | Column] = ()) -> DataFrame:
    """Samples of stored micro-trips with their usable ``time`` and ``extra`` columns."""
    narrow = microtrips.select("trip_id", "micro_trip_id", "ts", "payload", *extra)
    narrow = narrow.where(F.col("trip_id").isNotNull())
    return explode_samples(narrow).withColumn("time", sample_time())


def with_trip_distance(trips: DataFrame) -> DataFrame:
    """Trips with the distance the device reported."""
    distance = parse_trip_payload(F.col("trip_payload_str")).dis
    return trips.withColumn("trip_dist", distance.cast("bigint"))


def _gated(result: DataFrame) -> DataFrame:
    """Driving events count only for devices with good positions."""
    return result.withColumns(
        {
            "n_" + e: F.when(from_satellite(), F.col("n_" + e)).otherwise(F.lit(0)).cast("bigint")
            for e in EVENT_COUNTS
        }
    )


def trip_score(
    trips: DataFrame,
    microtrips: DataFrame,
    events: DataFrame,
    window: int = SPEED_WINDOW,
    zone: str = "UTC",
    limit: int = ROWS_PER_TASK,
    roads: DataFrame | None = None,
) -> DataFrame:
    """Result per trip of a one-device vehicle: samples and events are found by trip id.

    With ``roads`` the result also counts exceeded speed limits.
    """
    heavy = heavy_tracks(microtrips, "trip_id", limit)
    samples = stored_samples(microtrips)
    return trip_result(latest_trips(trips), samples, events, window, zone, limit, heavy, roads)


def trip_result(
    trips: DataFrame,
    samples: DataFrame,
    events: DataFrame,
    window: int = SPEED_WINDOW,
    zone: str = "UTC",
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
    roads: DataFrame | None = None,
) -> DataFrame:
    """Result per trip from unique trips, their samples and their events.

    Samples shuffle once, by trip, and leave that stage as one row per trip; everything after
    joins one row to one row. Trips without samples have no result.
    """
    facts = track_facts(samples, ("trip_id",), SAMPLE_TIE, window, limit=limit, heavy=heavy)
    own = with_trip_distance(trips).select("trip_id", *TRIP_IDS, "trip_dist")
    limits = _limits(samples, roads, "trip_id", SAMPLE_TIE, window, limit, heavy)
    return _result(own.join(facts, "trip_id"), event_stats(events), "trip_id", zone, limits)


def _limits(
    samples: DataFrame,
    roads: DataFrame | None,
    key: str,
    tie: Sequence[str],
    window: int,
    limit: int,
    heavy: HeavyKeys | None,
) -> DataFrame | None:
    """Number of exceeded limits per track."""
    if roads is None:
        return None
    moved = with_moves(samples, window, (key,), tie, limit, heavy).where("is_move")
    fast = over_limit(moved, roads, list(tie), limit=limit)
    return fast.groupBy(key).agg(F.count(F.lit(1)).alias("overlimit"))


def _result(
    joined: DataFrame, texts: DataFrame, key: str, zone: str, limits: DataFrame | None
) -> DataFrame:
    stats = stat_rows(joined, texts, key, zone=zone, over_limits=limits)
    return _gated(stats.withColumn("device_dist", F.col("distance"))).select(*RESULT)


def heavy_tracks(
    microtrips: DataFrame, key: str, limit: int = ROWS_PER_TASK
) -> HeavyKeys:
    """Trips or vehicles with very many samples.

    A sample is one JSON object, so a payload holds no more samples than opening braces; counting
    those needs no parse, and a track that is cut without need gives the same result.
    """
    payload = F.col("payload")
    braces = F.length(payload) - F.length(F.replace(payload, F.lit("{"), F.lit("")))
    return heavy_keys(microtrips, [key], limit, F.greatest(F.coalesce(braces, F.lit(1)), F.lit(1)))


def matched_samples(
    trips: DataFrame,
    microtrips: DataFrame,
    limit: int = ROWS_PER_TASK,
    levels: Sequence[int] | None = None,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Samples of a vehicle inside the time range of its trips, with the trip's id.

    Payloads are parsed before the join, so no JSON text is shuffled, and exploded after it, so
    the join sees one row per micro-trip. A sample inside two trips appears once for each.
    """
    if heavy is None:
        heavy = heavy_tracks(microtrips, "vehicle_id", limit)
    parsed = microtrips.select(
        "vehicle_id", "micro_trip_id", "ts", parse_samples(F.col("payload")).alias("_samples")
    )
    matched = range_join(
        trips.select("vehicle_id", "trip_id", "start_ts", "end_ts"),
        parsed,
        ["vehicle_id"],
        "start_ts",
        "end_ts",
        "ts",
        ["micro_trip_id"],
        limit,
        levels=levels,
        heavy=heavy,
    )
    kept = ["vehicle_id", "trip_id", "start_ts", "micro_trip_id", "ts"]
    return (
        matched.select(*kept, F.posexplode("_samples").alias("pos", "_sample"))
        .where(F.col("_sample").isNotNull())
        .select(*kept, "pos", "_sample.*")
        .withColumn("time", sample_time())
    )


def matched_events(
    trips: DataFrame,
    events: DataFrame,
    limit: int = ROWS_PER_TASK,
    levels: Sequence[int] | None = None,
) -> DataFrame:
    """Events of a vehicle inside the time range of its trips.

    The stored event time is text; it is compared as a number.
    """
    timed = events.select(
        "vehicle_id",
        "event_id",
        "payload",
        F.col("event_ts").try_cast("bigint").alias("_at"),
    )
    return range_join(
        trips.select("vehicle_id", "trip_id", "start_ts", "end_ts"),
        timed,
        ["vehicle_id"],
        "start_ts",
        "end_ts",
        "_at",
        ["event_id"],
        limit,
        levels=levels,
    ).select("vehicle_id", "trip_id", "event_id", "payload", F.col("_at").alias("event_ts"))


def multi_trip_score(
    trips: DataFrame,
    microtrips: DataFrame,
    events: DataFrame,
    by: str = "vehicle_id",
    window: int = SPEED_WINDOW,
    zone: str = "UTC",
    limit: int = ROWS_PER_TASK,
    roads: DataFrame | None = None,
) -> DataFrame:
    """Result of vehicles with several devices, per vehicle or, ``by='trip_id'``, per trip.

    Only trips of the representative device count; samples and events of all devices are found
    by vehicle and time range. A vehicle's ids are those of its earliest trip with samples.
    """
    # Written once, as four parts of the plan start from the chosen trips.
    own = checkpointed(base_device_trips(latest_trips(trips)).select(*TRIP_COLUMNS))
    levels = grid_levels(own, "start_ts", "end_ts")
    heavy = heavy_tracks(microtrips, "vehicle_id", limit)
    samples = matched_samples(own, microtrips, limit, levels, heavy)
    found = matched_events(own, events, limit, levels)
    return multi_trip_result(own, samples, found, by, window, zone, limit, heavy, roads)


def multi_trip_result(
    trips: DataFrame,
    samples: DataFrame,
    events: DataFrame,
    by: str = "vehicle_id",
    window: int = SPEED_WINDOW,
    zone: str = "UTC",
    limit: int = ROWS_PER_TASK,
    heavy_vehicles: HeavyKeys | None = None,
    roads: DataFrame | None = None,
) -> DataFrame:
    """Result per vehicle or trip from unique trips and what matched them by time range."""
    heavy = tracks_to_cut(by, heavy_vehicles)
    first = F.min(F.struct("start_ts", "trip_id")).alias("_first")
    tie = multi_tie(by)
    facts = track_facts(samples, (by,), tie, window, extra=[first], limit=limit, heavy=heavy)
    if by != "trip_id":
        facts = facts.withColumn("trip_id", F.col("_first.trip_id"))
    ids = [c for c in TRIP_IDS if c != by]
    own = with_trip_distance(trips).select("trip_id", *ids, "trip_dist")
    joined = facts.drop("_first").join(own, "trip_id")
    limits = _limits(samples, roads, by, tie, window, limit, heavy)
    return _result(joined, event_stats(events, by), by, zone, limits)


VEHICLE = ("vehicle_id",)


def trip_states(
    samples: DataFrame,
    window: int = SPEED_WINDOW,
    limit: int = ROWS_PER_TASK,
    heavy_vehicles: HeavyKeys | None = None,
) -> DataFrame:
    """State per trip of what ``matched_samples`` found, from which the vehicle's facts follow."""
    heavy = tracks_to_cut("trip_id", heavy_vehicles)
    keys, firsts = (*VEHICLE, "trip_id"), ("start_ts", "trip_id")
    return track_segments(samples, keys, multi_tie("vehicle_id"), firsts, window, limit, heavy)


def vehicle_facts(
    states: DataFrame,
    samples_of: Callable[[DataFrame], DataFrame],
    window: int = SPEED_WINDOW,
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Facts per vehicle from the states of its trips, with the id of its earliest trip.

    Trips that interleave are no segments of a track. For their vehicles, and for those only,
    ``samples_of(vehicles)`` has to find the samples of all trips.
    """
    tie = multi_tie("vehicle_id")
    mixed = checkpointed(interleaved(states, VEHICLE, tie))
    first = F.col("first.f_trip_id").alias("trip_id")
    columns = [*VEHICLE, *COUNTED, "distance", *FOUND]
    if mixed.isEmpty():
        return segment_facts(states, VEHICLE, tie, window, limit).select(*columns, first)
    apart = states.join(mixed, "vehicle_id", "left_anti")
    facts = segment_facts(apart, VEHICLE, tie, window, limit).select(*columns, first)
    earliest = [F.min(F.struct("start_ts", F.col("trip_id").alias("f_trip_id"))).alias("first")]
    samples = samples_of(mixed)
    whole = track_facts(samples, VEHICLE, tie, window, extra=earliest, limit=limit, heavy=heavy)
    return facts.unionByName(whole.select(*columns, first))


def vehicle_result(
    facts: DataFrame, trips: DataFrame, events: DataFrame, zone: str = "UTC"
) -> DataFrame:
    """The result of ``multi_trip_result`` per vehicle from its facts and matched events."""
    ids = [c for c in TRIP_IDS if c != "vehicle_id"]
    own = with_trip_distance(trips).select("trip_id", *ids, "trip_dist")
    return _result(facts.join(own, "trip_id"), event_stats(events, "vehicle_id"), "vehicle_id", zone, None)


def multi_trip_score_by_states(
    trips: DataFrame,
    microtrips: DataFrame,
    events: DataFrame,
    window: int = SPEED_WINDOW,
    zone: str = "UTC",
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """The result of ``multi_trip_score`` per vehicle, by way of one state per trip.

    No track is longer than a trip, so that a vehicle with very many trips has no sort of all its
    samples. What the states came from is not needed again when more trips follow.
    """
    own = checkpointed(base_device_trips(latest_trips(trips)).select(*TRIP_COLUMNS))
    levels = grid_levels(own, "start_ts", "end_ts")
    heavy = heavy_tracks(microtrips, "vehicle_id", limit)
    found = matched_samples(own, microtrips, limit, levels, heavy)
    # Written, as both the search for interleaved trips and the facts start from the states.
    states = checkpointed(trip_states(found, window, limit, heavy))

    def samples_of(vehicles: DataFrame) -> DataFrame:
        return found.join(vehicles, "vehicle_id", "left_semi")

    facts = vehicle_facts(states, samples_of, window, limit, heavy)
    return vehicle_result(facts, own, matched_events(own, events, limit, levels), zone)


def multi_tie(by: str) -> tuple[str, ...]:
    """Columns that tell apart the samples of a track of equal time."""
    return SAMPLE_TIE if by == "trip_id" else ("trip_id", *SAMPLE_TIE)


def tracks_to_cut(by: str, heavy_vehicles: HeavyKeys | None) -> HeavyKeys | None:
    """Heavy tracks, as far as the heavy vehicles tell.

    A trip has no more samples than its vehicle: no heavy vehicle, no heavy trip.
    """
    if by == "trip_id" and heavy_vehicles is not None and heavy_vehicles.size:
        return None
    return heavy_vehicles


def score_events(
    trips: DataFrame,
    samples: DataFrame,
    roads: DataFrame | None = None,
    keys: Sequence[str] = ("trip_id",),
    tie: Sequence[str] = SAMPLE_TIE,
    window: int = SPEED_WINDOW,
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Event rows of scored trips, driving events and, with roads, exceeded limits.

    Pass the samples of ``stored_samples``, or those of ``matched_samples`` with the vehicle as
    key and the trip as first tie column. Events are few, so the trip's ids are joined to them
    and not to the samples.
    """
    ids = latest_trips(trips).select("trip_id", "vehicle_id", "user_id", "device_type")
    named = samples.drop(*[c for c in ("vehicle_id", "user_id", "device_type") if c not in keys])
    moved = with_moves(named, window, keys, tie, limit, heavy).where("is_move")
    if "vehicle_id" in keys:
        ids = ids.drop("vehicle_id")
    sample = F.concat_ws("#", F.col("micro_trip_id"), F.col("pos"))
    driving = with_traffic_event(moved).where(F.col("event").isNotNull())
    rows = event_rows(driving.join(ids, "trip_id").where(from_satellite()), sample)
    if roads is None:
        return rows.withColumn("source", F.lit("check_event"))
    fast = over_limit(moved, roads, list(tie), limit=limit).join(ids, "trip_id")
    return all_events(rows, event_rows(fast, F.concat_ws("#", sample, F.col("road_id"))))


def nested_events(rows: DataFrame, key: str = "trip_id", row_events: int = 100_000) -> DataFrame:
    """Both event lists of a trip in one row, for readers of the nested result.

    A row holds up to ``row_events`` events that follow each other in time; ``piece`` numbers the
    rows of a trip. The events, few compared to the samples, are written once and not found twice.
    """
    rows = checkpointed(rows)
    fields = [c for c in rows.columns if c not in (key, "source")]

    def listed(source: str) -> Column:
        item = F.when(F.col("source") == source, F.struct(*fields))
        return F.array_sort(F.collect_list(item)).alias(source)

    order = [F.col(c) for c in ("event_ts", "source", "id")]
    pieces = with_pieces(rows, [key], order, row_events)
    return pieces.groupBy(key, "piece").agg(listed("check_event"), listed("check_over_limit"))
