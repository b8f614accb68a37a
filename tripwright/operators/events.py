"""Driving events: hard start, acceleration, braking, stop and exceeded speed limits."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions.codes import event_code
from tripwright.functions.ids import row_id
from tripwright.functions.text import over_limit_info
from tripwright.operators.skew import BROADCAST_BYTES, ROWS_PER_TASK, row_bytes, salted_pair
from tripwright.schemas import (
    DEFAULT_CATEGORY,
    SATELLITE_DEVICES,
    SPEED_RULES,
)


def rule_numbers(text: str) -> list[int]:
    """Bounds of one rule in m/h, -1 for no bound."""
    return [-1 if part == "-" else int(float(part) * 1000) for part in text.split(",")]


def rules_of(
    sensor: Column | None = None,
    category: Column | None = None,
    rules: Mapping[str, Mapping[str, str]] = SPEED_RULES,
) -> Column:
    """Map ``event -> [from, change, to]`` in m/h that applies to a row.

    The sensor's rules come first, then those of the vehicle category, then the default ones.
    The rule book is a handful of constants, so the lookup is a literal map (folded by the
    optimizer where no column takes part) and no join.
    """
    book = F.create_map(
        *[
            part
            for name, texts in rules.items()
            for part in (
                F.lit(name),
                F.create_map(
                    *[
                        x
                        for event, text in texts.items()
                        for x in (F.lit(event), F.array(*[F.lit(v) for v in rule_numbers(text)]))
                    ]
                ),
            )
        ]
    )
    asked = [c for c in (sensor, category) if c is not None]
    return F.coalesce(*[book[c] for c in asked], book[F.lit(DEFAULT_CATEGORY)])


def classify(bounds: Callable[[str], tuple[object, object, object] | None]) -> str:
    """SQL text for the driving event between two neighbouring moves, NULL if there is none.

    While speeding up ``start`` is tried before ``accel``, while slowing down ``stop`` before
    ``deaccel``. If the first of a pair has no rule, the second is not tried. ``bounds`` gives
    the three values of an event's rule as numbers or SQL text.
    """
    change = "(speed_mh - prev_speed_mh)"

    def hit(event: str) -> str:
        found = bounds(event)
        if found is None:
            return "false"
        low, step, high = found
        return (
            f"if({step} > 0, {change} >= {step} AND ({low} < 0 OR prev_speed_mh <= {low}),"
            f" {change} <= {step} AND ({low} < 0 OR prev_speed_mh >= {low})"
            f" AND ({high} < 0 OR speed_mh <= {high}))"
        )

    def pair(sign: str, one: str, two: str) -> str:
        found = bounds(one)
        if found is None:
            return ""
        start = f"WHEN {change} {sign} 0 AND {found[1]} IS NOT NULL AND"
        return f"{start} {hit(one)} THEN '{one}' {start} {hit(two)} THEN '{two}'"

    cases = pair(">", "start", "accel") + " " + pair("<", "stop", "deaccel")
    return f"CASE {cases} END" if cases.strip() else "cast(NULL AS string)"


def with_traffic_event(
    moves: DataFrame,
    category: str | None = None,
    rules: Mapping[str, Mapping[str, str]] = SPEED_RULES,
) -> DataFrame:
    """Add ``event`` to moves made with ``prev_speed_mh``.

    The rules are those of the vehicle ``category`` column, or the default ones without it.
    """
    if category is None:
        default = rules[DEFAULT_CATEGORY]
        event = classify(lambda e: tuple(rule_numbers(default[e])) if e in default else None)
        return moves.withColumn("event", F.expr(event))
    event = classify(lambda e: tuple(f"_rules['{e}'][{i}]" for i in range(3)))
    ruled = moves.withColumn("_rules", rules_of(None, F.col(category), rules))
    return ruled.withColumn("event", F.expr(event)).drop("_rules")


def from_satellite(device: str = "device_type") -> Column:
    """Only these devices have positions that are good enough for driving events."""
    return F.col(device).isin(*SATELLITE_DEVICES)


def traffic_events(
    moves: DataFrame,
    device: str = "device_type",
    category: str | None = None,
    rules: Mapping[str, Mapping[str, str]] = SPEED_RULES,
) -> DataFrame:
    """The moves that are a driving event."""
    return with_traffic_event(moves.where(from_satellite(device)), category, rules).where(
        F.col("event").isNotNull()
    )


def event_rows(events: DataFrame, sample: Column) -> DataFrame:
    """Driving events in the layout of the event table."""
    return events.select(
        "vehicle_id",
        "user_id",
        "trip_id",
        F.col("lon").alias("pos_lon"),
        F.col("lat").alias("pos_lat"),
        F.col("time").alias("event_ts"),
        event_code(F.col("event")).alias("event_type"),
        "speed_mh",
        (F.col("info") if "info" in events.columns else F.lit("")).alias("info"),
        "device_type",
        F.lit(0).cast("bigint").alias("created_time"),
        row_id(F.col("trip_id"), F.col("time"), F.col("event"), sample).alias("id"),
    )


def over_limit(
    moves: DataFrame,
    roads: DataFrame,
    spread: list[str],
    cell: float = 0.0005,
    limit: int = ROWS_PER_TASK,
) -> DataFrame:
    """Moves that end on a road and are faster than its limit.

    ``roads(road_id, rank, max_speed_mh, min_lon, max_lon, min_lat, max_lat)`` are boxes, the
    upper edges not included. Roads and moves meet in cells of a map grid. A long road goes to
    a coarser grid, so that no road covers many cells. The finest cells are about 50 m wide, so
    that the short roads of a town don't share one.
    """
    levels = F.lit(0)
    for level in range(1, 6):
        finer = cell * 16 ** (level - 1)
        covered = (
            (F.floor(F.col("max_lon") / finer) - F.floor(F.col("min_lon") / finer) + 1)
            * (F.floor(F.col("max_lat") / finer) - F.floor(F.col("min_lat") / finer) + 1)
        )
        levels = F.when(covered > 64, F.lit(level)).otherwise(levels)
    sized = roads.withColumn("_level", levels).withColumn("_size", cell * F.pow(F.lit(16.0), "_level"))
    cells = sized.select(
        "road_id",
        "rank",
        "max_speed_mh",
        "min_lon",
        "max_lon",
        "min_lat",
        "max_lat",
        "_level",
        "_size",
        F.explode(_span("min_lon", "max_lon")).alias("_x"),
    ).withColumn("_y", F.explode(_span("min_lat", "max_lat"))).drop("_size")

    # At most five numbers, and the row count of the grid.
    found = cells.groupBy("_level").agg(F.count(F.lit(1)).alias("n")).collect()
    used = sorted(r["_level"] for r in found)
    total = sum(r["n"] for r in found)
    if not used:
        used = [0]
    placed = moves.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in used])))
    size = cell * F.pow(F.lit(16.0), F.col("_level"))
    placed = placed.withColumn("_x", F.floor(F.col("lon") / size)).withColumn(
        "_y", F.floor(F.col("lat") / size)
    )
    keys = ["_level", "_x", "_y"]
    if total * row_bytes(cells) <= BROADCAST_BYTES:
        joined = placed.join(F.broadcast(cells), keys)
    else:
        big, small, salted = salted_pair(placed, cells, keys, spread, limit)
        joined = big.join(small, salted).drop("_salt")
    return (
        joined.where(
            (F.col("lon") >= F.col("min_lon"))
            & (F.col("lon") < F.col("max_lon"))
            & (F.col("lat") >= F.col("min_lat"))
            & (F.col("lat") < F.col("max_lat"))
            & (F.col("speed_mh") > F.col("max_speed_mh"))
        )
        .withColumn("event", F.lit("overlimit"))
        .withColumn(
            "info", over_limit_info(F.col("road_id"), F.col("max_speed_mh"), F.col("rank"))
        )
        .drop(*keys, "min_lon", "max_lon", "min_lat", "max_lat")
    )


def _span(low: str, high: str) -> Column:
    return F.sequence(
        F.floor(F.col(low) / F.col("_size")), F.floor(F.col(high) / F.col("_size"))
    )


def over_limit_counts(events: DataFrame) -> DataFrame:
    """Exceeded limits per vehicle, trip and user."""
    return events.groupBy("vehicle_id", "trip_id", "user_id").agg(
        F.count(F.lit(1)).alias("overlimit")
    )


def all_events(driving: DataFrame, limits: DataFrame) -> DataFrame:
    """Both kinds of events with the check they come from."""
    return driving.withColumn("source", F.lit("check_event")).unionByName(
        limits.withColumn("source", F.lit("check_over_limit"))
    )
