"""Keyed tables: upserts, cursors and copies under another key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions.ids import latest_uuid

# Copies of a table under another leading key: columns that must be present, and the new key.
REKEYED = {
    "event_by_trip": ("trip_id", "event_id", "vehicle_id", "sensor_id", "ty"),
    "event_by_vehicle": ("vehicle_id", "device_type", "event_ts", "trip_id"),
    "microtrip_by_vehicle": ("vehicle_id", "device_type", "ts", "trip_id"),
    "stat_by_vehicle": ("vehicle_id", "trip_id"),
    "score_by_user": ("user_id", "vehicle_id"),
}
REQUIRED = {
    "event_by_vehicle": ("event_id", "sensor_id"),
    "microtrip_by_vehicle": ("micro_trip_id", "sensor_id"),
}


def latest_per_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the highest version per key.

    An aggregate, not a ranking window: copies of a heavy key shrink to one row per task before
    the shuffle.
    """
    rest = [c for c in rows.columns if c not in keys and c not in version]
    ranked = F.struct(*[F.col(c) for c in (*version, *rest)])
    return (
        rows.groupBy(*keys)
        .agg(F.max(ranked).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in (*version, *rest)])
        .select(*rows.columns)
    )


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """Target rows after writing a batch: of equal keys the later version stays."""
    return latest_per_key(target.unionByName(batch), keys, version)


def rekey(rows: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Copy of a table for lookups by another key.

    Rows without a complete key are left out. The rows are ranged over the whole key, not hashed
    by its first column, so one vehicle's rows may fill many files, each sorted for row-group
    pruning.
    """
    key = REKEYED[name]
    complete = rows.dropna(subset=[*key, *REQUIRED.get(name, ())])
    order = [F.col(k) for k in key]
    ranged = (
        complete.repartitionByRange(partitions, *order)
        if partitions
        else complete.repartitionByRange(*order)
    )
    return ranged.sortWithinPartitions(*key)


def rows_with_key(rows: DataFrame, key: str, value: Column | str | int) -> DataFrame:
    """The rows of one key; the filter is pushed to the scan."""
    return rows.where(F.col(key) == (value if isinstance(value, Column) else F.lit(value)))


def next_key(rows: DataFrame, key: str, last: str | int | None = None) -> DataFrame:
    """One row with the smallest key above ``last``, NULL if there is none."""
    keys = rows.select(key)
    if last is not None:
        keys = keys.where(F.col(key) > F.lit(last))
    return keys.agg(F.min(key).alias("next_key"))


def latest_time_uuid(rows: DataFrame, keys: Sequence[str], uuid: str) -> DataFrame:
    """Per key the time UUID that was made last."""
    return rows.groupBy(*keys).agg(latest_uuid(F.col(uuid)).alias("latest_" + uuid))


def first_rows(rows: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows for display, the same ones every time."""
    return rows.orderBy(*order).limit(n)
