"""Roll-ups of sample rows per trip or vehicle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.operators.events import with_traffic_event
from tripwright.operators.kinematics import TIE, TRACK, driven_distance, with_moves
from tripwright.operators.sequence import with_pieces
from tripwright.operators.skew import ROWS_PER_TASK, HeavyKeys
from tripwright.operators.stats import counter_sums
from tripwright.schemas import SPEED_WINDOW

EVENT_COUNTS = ("start", "accel", "deaccel", "stop")


def track_facts(
    samples: DataFrame,
    keys: Sequence[str] = TRACK,
    tie: Sequence[str] = TIE,
    window: int = SPEED_WINDOW,
    category: str | None = None,
    extra: Sequence[Column] = (),
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Everything the score needs from the samples of a track, in one shuffle.

    ``samples`` have ``time`` (NULL where there is no usable position) and the counter codes.
    Result: ``mtrip_cnt``, sample counters, ``distance`` and driving events ``n_start``.. of all
    devices, whose device gate the caller applies.
    """
    moved = with_traffic_event(with_moves(samples, window, keys, tie, limit, heavy), category)
    events = [
        F.sum(F.when(F.col("event") == e, F.lit(1)).otherwise(F.lit(0))).alias("n_" + e)
        for e in EVENT_COUNTS
    ]
    return moved.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mtrip_cnt"),
        *counter_sums(),
        driven_distance().alias("distance"),
        *events,
        *extra,
    )


def trip_rollup(
    samples: DataFrame,
    key: str = "trip_id",
    firsts: Sequence[str] = ("vehicle_id", "user_id", "company_id", "sensor_id", "device_type"),
    tie: Sequence[str] = TIE,
) -> DataFrame:
    """Sample count and time span per trip; ``firsts`` are those of the earliest sample.

    The earliest sample, unlike the first to arrive, is the same in every run. A sample without
    usable time counts, but is the earliest only if no sample of the trip has a time.
    """
    earliest = F.min(F.struct(F.col("time").isNull(), "time", *tie, *firsts)).alias("_first")
    return (
        samples.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("mtrip_cnt"),
            F.min("time").alias("first_time"),
            F.max("time").alias("last_time"),
            earliest,
        )
        .select("*", *[F.col(f"_first.{c}").alias(c) for c in firsts])
        .drop("_first")
    )


def vehicle_rollup(
    samples: DataFrame,
    firsts: Sequence[str] = ("trip_id", "user_id", "company_id", "sensor_id", "device_type"),
    tie: Sequence[str] = TIE,
) -> DataFrame:
    """The same per vehicle; the trip is that of the earliest sample."""
    return trip_rollup(samples, "vehicle_id", firsts, tie)


def collect_points(
    points: DataFrame,
    fields: Sequence[str],
    keys: Sequence[str] = TRACK,
    tie: Sequence[str] = TIE,
    chunk_ms: int = 60_000,
    chunk_rows: int = 4096,
) -> DataFrame:
    """Points of a track as arrays in time order, one row per piece of the track.

    A piece holds up to ``chunk_rows`` consecutive points of one ``chunk_ms`` time slice, so no
    array grows with the data. ``piece`` numbers the arrays of a slice.
    """
    slices = [*keys, "slice"]
    cut = points.withColumn("slice", F.call_function("div", F.col("time"), F.lit(chunk_ms)))
    cut = with_pieces(cut, slices, [F.col(c) for c in ("time", *tie)], chunk_rows)
    point = F.struct("time", *tie, *fields)
    return cut.groupBy(*slices, "piece").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(point)).alias("points")
    )
