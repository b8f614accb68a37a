"""Mergeable state of tracks: the facts of a whole track from those of its segments.

A segment is a run of consecutive samples of a track, a trip of a vehicle for example. What a
point adds to the facts depends on the ``window + 1`` points before it. So the state of a segment
holds the sums over the points that have as many inside it, and its first and last ``window + 1``
points (``edges``), the first ones marked ``open``, as what they add is not known yet. States of
neighbours combine to the state of both: the edges, put in order, are looked at as a track is,
open points that now have enough before them are counted, and the outer edges are kept. The
combination is associative, and a state has the same few hundred bytes whatever it stands for.

Segments of a track must not interleave; ``interleaved`` finds the tracks where they do. Samples
without usable time have no place in a track, they only count. A track without samples has no
state, empty inputs give empty results, rows without key belong to no track. Repeated samples
count as often as they occur, but ``tie`` must tell the samples of equal time apart. Columns of
the samples that are neither named here nor asked for are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tripwright.functions.codes import sample_flags
from tripwright.operators.events import with_traffic_event
from tripwright.operators.kinematics import TIE, moves_over, track_order, whole_metres
from tripwright.operators.rollups import EVENT_COUNTS
from tripwright.operators.sequence import over_tracks
from tripwright.operators.skew import ROWS_PER_TASK, HeavyKeys
from tripwright.schemas import MIN_TRACK_POINTS, SPEED_WINDOW

COUNTED = ("mtrip_cnt", *sample_flags())
FOUND = tuple("n_" + e for e in EVENT_COUNTS)
SUMS = (*COUNTED, "points", "metres", *FOUND)


def track_segments(
    samples: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str] = TIE,
    firsts: Sequence[str] = (),
    window: int = SPEED_WINDOW,
    limit: int = ROWS_PER_TASK,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """One state per key, from samples with ``time``, ``lon``, ``lat`` and the counter codes.

    ``keys`` name the segment, its track's keys among them. ``first`` is the least of the
    ``firsts``, taken as a tuple.
    """
    rows = samples.select(
        *keys,
        "time",
        *[F.col(t) for t in tie if t not in keys],
        "lon",
        "lat",
        F.col("time").isNotNull().alias("open"),
        F.lit(1).cast("bigint").alias("mtrip_cnt"),
        *[
            F.expr(f"cast(coalesce({flag}, 0) AS bigint) AS {name}")
            for name, flag in sample_flags().items()
        ],
        F.col("time").isNotNull().cast("bigint").alias("points"),
        *[F.lit(0).cast("bigint").alias(n) for n in ("metres", *FOUND)],
        F.struct(*[F.col(c).alias(f"f_{c}") for c in firsts] or [F.lit(0).alias("f_none")]).alias("first"),
    )
    return _reduced(rows, keys, tie, window, limit, heavy)


def merge_segments(
    states: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str] = TIE,
    window: int = SPEED_WINDOW,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """States of the segments that ``keys`` name together, from those of their parts."""
    return _reduced(_edge_rows(states, keys, tie), keys, tie, window, limit)


def segment_facts(
    states: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str] = TIE,
    window: int = SPEED_WINDOW,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """The result of ``rollups.track_facts`` and ``first``, from the states of a track's segments.

    The points before a track's first ones are none, so that nothing stays open here.
    """
    rows = _edge_rows(states, keys, tie)
    seen = _seen(rows, keys, tie, window, limit)
    facts = seen.groupBy(*keys).agg(*_sums(F.col("open")), F.min("first").alias("first"))
    distance = F.when(F.col("points") >= MIN_TRACK_POINTS, F.col("metres")).otherwise(F.lit(0))
    return facts.select(*keys, *COUNTED, distance.cast("bigint").alias("distance"), *FOUND, "first")


def interleaved(states: DataFrame, keys: Sequence[str], tie: Sequence[str] = TIE) -> DataFrame:
    """Tracks of which a segment begins before another one's end, each once."""

    def place(index: int) -> Column:
        edge = F.element_at("edges", index)
        return F.struct(*[edge[c].alias(c) for c in ("time", *tie)])

    spans = states.where(F.size("edges") > 0).select(*keys, place(1).alias("_low"), place(-1).alias("_high"))
    before = Window.partitionBy(*keys).orderBy("_low", "_high").rowsBetween(Window.unboundedPreceding, -1)
    ends = spans.withColumn("_end", F.max("_high").over(before))
    return ends.where(F.col("_end") >= F.col("_low")).select(*keys).distinct()


def _edge_rows(states: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The edges of each state as points, and a row without time that has its sums."""
    point = states.schema["edges"].dataType.elementType
    points = F.concat(F.array(F.lit(None).cast(point)), F.col("edges"))
    carried = F.col("_n") == 0
    names = [*dict.fromkeys([*keys, *SUMS, "first"])]
    return states.select(*names, F.posexplode(points).alias("_n", "_p")).select(
        *keys,
        "_p.time",
        *[f"_p.{t}" for t in tie if t not in keys],
        "_p.lon",
        "_p.lat",
        F.coalesce(F.col("_p.open"), F.lit(False)).alias("open"),
        *[F.when(carried, F.col(n)).otherwise(F.lit(0)).cast("bigint").alias(n) for n in SUMS],
        F.when(carried, F.col("first")).alias("first"),
    )


def _seen(
    rows: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str],
    window: int,
    limit: int,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """Moves and events, and whether ``window + 1`` points lie before and behind each."""
    reach = window + 1

    def compute(frame: DataFrame, track: WindowSpec) -> DataFrame:
        return (
            moves_over(frame, track, window)
            .withColumn("_inner", F.lag("time", reach).over(track).isNotNull())
            .withColumn("_passed", F.lead("time", reach).over(track).isNotNull())
        )

    done = over_tracks(rows, keys, track_order(tie), reach, compute, limit, heavy, ahead=reach)
    return with_traffic_event(done)


def _sums(counted: Column) -> list[Column]:
    """The sums so far and what the ``counted`` points add."""

    def added(what: Column) -> Column:
        return F.when(counted, what).otherwise(F.lit(0))

    metres = added(whole_metres(F.col("step_m")))
    hits = {"n_" + e: added(F.when(F.col("event") == e, 1).otherwise(0)) for e in EVENT_COUNTS}
    return [
        *[F.sum(n).alias(n) for n in (*COUNTED, "points")],
        F.sum(F.col("metres") + metres).alias("metres"),
        *[F.sum(F.col(n) + hit).alias(n) for n, hit in hits.items()],
    ]


def _reduced(
    rows: DataFrame,
    keys: Sequence[str],
    tie: Sequence[str],
    window: int,
    limit: int,
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    point = F.struct(
        "time", *tie, "lon", "lat", (F.col("open") & ~F.col("_inner")).alias("open")
    )
    outer = F.col("time").isNotNull() & ~(F.col("_inner") & F.col("_passed"))
    return (
        _seen(rows, keys, tie, window, limit, heavy)
        .groupBy(*keys)
        .agg(
            *_sums(F.col("open") & F.col("_inner")),
            F.min("first").alias("first"),
            # At most window + 1 points from each end.
            F.array_sort(F.collect_list(F.when(outer, point))).alias("edges"),
        )
    )
