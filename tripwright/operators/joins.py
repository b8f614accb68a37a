"""Joins of trips with samples and events, by trip id or by vehicle and time range."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.operators.skew import ROWS_PER_TASK, HeavyKeys, heavy_keys, salted_join, salted_pair

HOUR_MS = 3_600_000
# Buckets that one interval may touch before it moves to a 16 times coarser time grid.
MAX_BUCKETS = 32
# 16 ** 10 hours still fit in a long and leave few buckets for any pair of longs.
MAX_LEVEL = 10


def join_samples(
    trips: DataFrame, samples: DataFrame, spread: Sequence[str], limit: int = ROWS_PER_TASK
) -> DataFrame:
    """Trips with their samples by trip id; trips without samples are left out.

    The samples of a heavy trip are dealt to several tasks by the ``spread`` columns.
    """
    return salted_join(samples, trips, ["trip_id"], spread, limit)


def left_join_events(
    trips: DataFrame,
    events: DataFrame,
    spread: Sequence[str],
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """All trips with their events by trip id.

    The events of a heavy trip can be split on that side of an inner join, but not of a left join.
    A heavy trip has events, so an inner join is enough for it; all others take one left join.
    ``heavy`` may come from a cheaper count than one over ``events``.
    """
    if heavy is None:
        heavy = heavy_keys(events, ["trip_id"], limit)
    if heavy.size == 0:
        return trips.join(events, "trip_id", "left")
    marks = heavy.for_join().drop("_rows")
    many = trips.join(marks, "trip_id", "left_semi")
    split = salted_join(events.join(marks, "trip_id", "left_semi"), many, ["trip_id"], spread, limit)
    # a key that only seems heavy may have no events
    lonely = many.join(events.join(marks, "trip_id", "left_semi").select("trip_id"), "trip_id", "left_anti")
    few = trips.join(marks, "trip_id", "left_anti").join(
        events.join(marks, "trip_id", "left_anti"), "trip_id", "left"
    )
    return few.unionByName(split).unionByName(lonely, allowMissingColumns=True)


def with_unmatched(
    left: DataFrame, matched: DataFrame, matching: DataFrame, key: str
) -> DataFrame:
    """Add to an inner join the left rows whose ``key`` does not occur in ``matching``.

    Pass a stored frame as both, so that the join behind it runs once.
    """
    keys = matching.select(key).groupBy(key).agg(F.lit(1).alias("_one")).drop("_one")
    return matched.unionByName(left.join(keys, key, "left_anti"), allowMissingColumns=True)


def grid_levels(
    intervals: DataFrame, start: str, end: str, bucket_ms: int = HOUR_MS
) -> list[int]:
    """Time grids in use by a set of intervals, at most eleven numbers."""
    leveled = intervals.where(F.col(start) <= F.col(end)).select(
        _level(F.col(start), F.col(end), bucket_ms).alias("_level")
    )
    return sorted(r["_level"] for r in leveled.distinct().collect())


def range_join(
    intervals: DataFrame,
    instants: DataFrame,
    on: Sequence[str],
    start: str,
    end: str,
    at: str,
    spread: Sequence[str],
    limit: int = ROWS_PER_TASK,
    bucket_ms: int = HOUR_MS,
    levels: Sequence[int] | None = None,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Inner join where ``start <= at <= end`` for equal ``on`` columns.

    Both sides meet in time buckets, so the rows of a vehicle spread over its history. A long
    interval uses a coarser grid; an instant is looked up once per grid in use, nearly always
    one. Every instant has one bucket per grid, so no pair appears twice. Where some ``on`` key
    is heavy, its buckets with too many instants are salted by the ``spread`` columns.

    ``levels`` and ``heavy`` may be passed on from ``grid_levels`` and ``heavy_keys``.
    """
    if levels is None:
        levels = grid_levels(intervals, start, end, bucket_ms)
    if heavy is None:
        heavy = heavy_keys(instants, on, limit)
    begin, stop = F.col(start), F.col(end)
    width = F.element_at(
        F.array(*[F.lit(bucket_ms * 16**x).cast("bigint") for x in range(MAX_LEVEL + 1)]),
        F.col("_level") + 1,
    )
    left = (
        intervals.where(begin <= stop)
        .withColumn("_level", _level(begin, stop, bucket_ms))
        .withColumn("_bucket", F.explode(F.sequence(_bucket(begin, width), _bucket(stop, width))))
    )
    right = instants.where(F.col(at).isNotNull())
    if len(levels) == 1:
        right = right.withColumn("_level", F.lit(levels[0]))
    else:
        right = right.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels or [0]])))
    right = right.withColumn("_bucket", _bucket(F.col(at), width))
    keys = [*on, "_level", "_bucket"]
    if heavy.size:
        right, left, keys = salted_pair(right, left, keys, spread, limit)
    return (
        left.join(right, keys)
        .where((F.col(at) >= begin) & (F.col(at) <= stop))
        .drop(*[k for k in keys if k not in on])
    )


def _level(begin: Column, stop: Column, bucket_ms: int) -> Column:
    # Any level gives the right result, so rounding in the logarithm does no harm.
    span = (stop.cast("double") - begin.cast("double")) / (bucket_ms * (MAX_BUCKETS - 1))
    return F.least(
        F.ceil(F.log(16.0, F.greatest(span, F.lit(1.0)))).cast("int"), F.lit(MAX_LEVEL)
    )


def _bucket(time: Column, width: Column) -> Column:
    return F.call_function("div", time, width)


def fanout_counts(trips: DataFrame, samples: DataFrame, events: DataFrame, key: str) -> DataFrame:
    """Rows per trip of the literal trip x sample x event join, without making those rows."""
    n_samples = samples.groupBy(key).agg(F.count(F.lit(1)).alias("n_samples"))
    n_events = events.groupBy(key).agg(F.count(F.lit(1)).alias("n_events"))
    n = F.col("n_samples") * F.greatest(F.coalesce(F.col("n_events"), F.lit(0)), F.lit(1))
    return (
        trips.select(key)
        .join(n_samples, key)
        .join(n_events, key, "left")
        .select(
            key,
            "n_samples",
            F.coalesce("n_events", F.lit(0)).alias("n_events"),
            n.alias("n_rows"),
        )
    )
