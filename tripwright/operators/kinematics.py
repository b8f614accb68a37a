"""Distances, windowed speeds and speed changes along a track.

All functions expect position rows with ``time`` (ms, NULL for a sample without usable
position), ``lon`` and ``lat``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tripwright.functions.geo import haversine_km
from tripwright.operators.sequence import over_tracks
from tripwright.operators.skew import ROWS_PER_TASK, HeavyKeys
from tripwright.schemas import MIN_MOVE_MS, MIN_TRACK_POINTS, SPEED_WINDOW

TRACK = ("trip_id",)
TIE = ("sample_id",)


def track_order(tie: Sequence[str] = TIE) -> list[Column]:
    """Time order with unusable samples last, so that no window of a usable one reaches them."""
    return [F.col("time").asc_nulls_last(), *[F.col(t).asc() for t in tie]]


def with_moves(
    points: DataFrame,
    window: int = SPEED_WINDOW,
    keys: Sequence[str] = TRACK,
    tie: Sequence[str] = TIE,
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Add the move that ends at each point.

    A move spans ``window`` steps, fewer at the start of a track. Added columns:
    ``step_m`` metres from the previous point; ``is_move``; ``head_time``, ``head_lon``,
    ``head_lat`` start of the move; ``elapsed_ms``; ``distance_m`` whole metres; ``speed_mh``
    metres per hour; ``prev_speed_mh`` speed of the move before, NULL where the two may not
    be compared. Tracks with fewer than three usable points have no moves.
    """

    def compute(rows: DataFrame, track: WindowSpec) -> DataFrame:
        return moves_over(rows, track, window)

    return over_tracks(points, keys, track_order(tie), window + 1, compute, limit, heavy)


def moves_over(rows: DataFrame, track: WindowSpec, window: int) -> DataFrame:
    """The columns of ``with_moves`` over one window; a row depends on ``window + 1`` rows before it."""
    return _with_speed_change(_with_speed(rows, track, window), track)


def _with_speed(rows: DataFrame, track: WindowSpec, window: int) -> DataFrame:
    trail = track.rowsBetween(-(window - 1), 0)
    start = track.rowsBetween(-window, 0)
    stepped = (
        rows.withColumn("_lon0", F.lag("lon").over(track))
        .withColumn("_lat0", F.lag("lat").over(track))
        .withColumn("_time0", F.lag("time").over(track))
        # A row has company if its track has a third usable point before or after it.
        .withColumn("_time2", F.lag("time", 2).over(track))
        .withColumn("_next", F.lead("time").over(track))
        .withColumn("head_time", F.first("time").over(start))
        .withColumn("head_lon", F.first("lon").over(start))
        .withColumn("head_lat", F.first("lat").over(start))
        .withColumn(
            "step_m",
            F.coalesce(
                haversine_km(F.col("_lon0"), F.col("_lat0"), F.col("lon"), F.col("lat")) * 1000.0,
                F.lit(0.0),
            ),
        )
    )
    is_move = (
        F.col("time").isNotNull()
        & F.col("_time0").isNotNull()
        & (F.col("_time2").isNotNull() | F.col("_next").isNotNull())
    )
    distance = whole_metres(F.sum("step_m").over(trail))
    elapsed = F.col("time") - F.col("head_time")
    return (
        stepped.withColumn("is_move", is_move)
        .withColumn("distance_m", F.when(F.col("is_move"), distance))
        .withColumn("elapsed_ms", F.when(F.col("is_move"), elapsed))
        .withColumn("speed_mh", speed_mh(F.col("distance_m"), F.col("elapsed_ms")))
        .drop("_lon0", "_lat0", "_time0", "_time2", "_next")
    )


def _with_speed_change(rows: DataFrame, track: WindowSpec) -> DataFrame:
    move = F.struct(
        F.when(F.col("is_move"), F.col("head_time")).alias("head_time"), F.col("speed_mh")
    )
    previous = rows.withColumn("_prev", F.lag(move).over(track))
    comparable = F.abs(F.col("head_time") - F.col("_prev.head_time")) >= MIN_MOVE_MS
    return previous.withColumn(
        "prev_speed_mh", F.when(F.col("is_move") & comparable, F.col("_prev.speed_mh"))
    ).drop("_prev")


def whole_metres(metres: Column) -> Column:
    """Truncated metres; impossible coordinates, whose distance is no number, count as 0."""
    return F.nanvl(metres, F.lit(0.0)).cast("int").cast("bigint")


def speed_mh(distance_m: Column, elapsed_ms: Column) -> Column:
    """Whole metres per hour; 0 for a move that is too short in time."""
    return F.when(elapsed_ms < MIN_MOVE_MS, F.lit(0).cast("bigint")).otherwise(
        F.call_function("div", distance_m * 3600000, elapsed_ms)
    )


def moves(
    points: DataFrame,
    window: int = SPEED_WINDOW,
    keys: Sequence[str] = TRACK,
    tie: Sequence[str] = TIE,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per move."""
    return with_moves(points, window, keys, tie, limit).where("is_move")


def segments(
    points: DataFrame,
    keys: Sequence[str] = TRACK,
    tie: Sequence[str] = TIE,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Steps between neighbouring points, of tracks with two points or more.

    Adds ``prev_time``, ``elapsed_ms``, ``step_m`` and, as a trip-point pair operator, the
    whole seconds, kilometres and whole metres per hour of the step.
    """

    def compute(rows: DataFrame, track: WindowSpec) -> DataFrame:
        return (
            rows.withColumn("prev_time", F.lag("time").over(track))
            .withColumn("prev_lon", F.lag("lon").over(track))
            .withColumn("prev_lat", F.lag("lat").over(track))
        )

    usable = points.where(F.col("time").isNotNull())
    steps = over_tracks(usable, keys, track_order(tie), 1, compute, limit)
    return (
        steps.where(F.col("prev_time").isNotNull())
        .withColumn("elapsed_ms", F.col("time") - F.col("prev_time"))
        .withColumn(
            "distance_km",
            haversine_km(F.col("prev_lon"), F.col("prev_lat"), F.col("lon"), F.col("lat")),
        )
        .withColumn("step_m", F.col("distance_km") * 1000.0)
    )


def pair_speed(steps: DataFrame) -> DataFrame:
    """Whole seconds, kilometres and speed in metres per hour of every step.

    The speed is NULL for a step without elapsed time.
    """
    elapsed = F.col("elapsed_ms")
    return steps.withColumn("elapsed_sec", F.call_function("div", elapsed, F.lit(1000))).withColumn(
        "speed_mh",
        F.when(elapsed > 0, (F.col("step_m") * 3600000.0 / elapsed).cast("bigint")),
    )


def driven_distance() -> Column:
    """Aggregate over the rows of a track: metres, whole per step, 0 below three points."""
    return F.when(
        F.count("time") >= MIN_TRACK_POINTS,
        F.sum(F.when(F.col("time").isNotNull(), whole_metres(F.col("step_m")))),
    ).otherwise(F.lit(0))
