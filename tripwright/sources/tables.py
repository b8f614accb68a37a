"""Stored tables in parquet: layout, versions, scans.

A table is a folder ``<root>/<name>/batch_id=<n>/part_day=<day>``. Every write adds the versions
of one batch; the current row of a key is its version from the latest batch. Writing a batch
again replaces its whole folder, so a repeated batch leaves nothing of its first attempt, even if
late data have moved rows to other days meanwhile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions.ids import millis_date, uuid_date
from tripwright.schemas import TABLES

BATCH = "batch_id"
DAY = "part_day"
NO_DAY = "none"
# Order inside the files of a table, so that row groups can be skipped by what readers ask for.
CLUSTERING = {
    "sf_microtrip": ("trip_id", "ts", "vehicle_id"),
    "sf_trip": ("trip_id", "vehicle_id"),
    "sf_event": ("trip_id", "event_ts", "vehicle_id"),
    "microtrip_by_vehicle": ("vehicle_id", "ts", "trip_id"),
    "event_by_vehicle": ("vehicle_id", "event_ts", "trip_id"),
    "trip_stat": ("trip_id",),
    "gps_event": ("trip_id", "event_ts"),
}


@dataclass(frozen=True)
class Layout:
    """Row key, columns and the day a row is filed under."""

    keys: tuple[str, ...]
    schema: str
    day: Column


@dataclass(frozen=True)
class Among:
    """Rows of some keys only: ``rows`` has them in the column ``key``, each once."""

    rows: DataFrame
    key: str


def day_of_trip(trip: str = "trip_id") -> Column:
    """Day inside a trip's time UUID: known from the id alone, on both sides of a join."""
    return F.coalesce(uuid_date(F.col(trip)).cast("string"), F.lit(NO_DAY))


def day_of_time(millis: str) -> Column:
    day = millis_date(F.col(millis).try_cast("bigint"))
    return F.coalesce(day.cast("string"), F.lit(NO_DAY))


def layouts() -> dict[str, Layout]:
    """The stored tables; those ``_by_vehicle`` hold the same rows, filed by their time."""

    def keyed(name: str, day: Column) -> Layout:
        key, schema = TABLES[name]
        return Layout((key,), schema, day)

    return {
        "sf_microtrip": keyed("sf_microtrip", day_of_trip()),
        "sf_trip": keyed("sf_trip", day_of_trip()),
        "sf_event": keyed("sf_event", day_of_trip()),
        "microtrip_by_vehicle": keyed("sf_microtrip", day_of_time("ts")),
        "event_by_vehicle": keyed("sf_event", day_of_time("event_ts")),
    }


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def conform(frame: DataFrame, name: str) -> DataFrame:
    """A frame in the column order and types of a catalog table; absent columns are NULL."""
    columns = [c.strip().split(" ") for c in TABLES[name][1].split(",")]
    return frame.select(
        *[
            (F.col(c) if c in frame.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in columns
        ]
    )


def write_versions(frame: DataFrame, root: str, name: str, batch_id: int, day: Column) -> None:
    """Write one batch of a table.

    Rows are dealt to files by day, but a day with many rows gets several files and small days
    share a task (``rebalance``), and each file is sorted, so scans can skip row groups.
    """
    sort = [c for c in CLUSTERING.get(name, ("vehicle_id", "trip_id", "ts")) if c in frame.columns]
    (
        frame.withColumn(DAY, day)
        .hint("rebalance", DAY)
        .sortWithinPartitions(DAY, *sort)
        .write.mode("overwrite")
        .partitionBy(DAY)
        .parquet(f"{root}/{name}/{BATCH}={int(batch_id)}")
    )


def scan_versions(
    spark: SparkSession,
    root: str,
    name: str,
    schema: str,
    where: Column | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """All versions of a table, or those of the days that ``where`` selects or ``days`` lists.

    ``days`` is a frame with the column ``part_day``: at most one row for each day of the
    calendar, so that it is small whatever the data, and prunes the folders at run time. A table
    that was never written is empty.
    """
    full = f"{schema}, {DAY} string, {BATCH} bigint"
    try:
        rows = spark.read.schema(full).parquet(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], full)
    if days is not None:
        rows = rows.join(F.broadcast(days.select(DAY).distinct()), DAY, "left_semi")
    return rows if where is None else rows.where(where)


def scan_latest(
    spark: SparkSession,
    root: str,
    name: str,
    keys: Sequence[str],
    schema: str,
    where: Column | None = None,
    days: DataFrame | None = None,
    among: Among | None = None,
) -> DataFrame:
    """Current rows, with the batch that wrote them.

    ``among`` keeps the rows of some keys before versions are compared, so that nothing else is
    shuffled; like ``where`` it relies on a repeat keeping that column.

    The newest batch per key comes from two narrow columns; rows are then kept by key and batch.
    A pair of those has one row, so many versions of one key do not meet in a task, and columns
    nobody asks for are not read.
    """
    versions = scan_versions(spark, root, name, schema, where, days).drop(DAY)
    if among is not None:
        versions = versions.join(among.rows, among.key, "left_semi")
    newest = versions.groupBy(*keys).agg(F.max(BATCH).alias(BATCH))
    return versions.join(newest, [*keys, BATCH], "left_semi")


def load_table(
    spark: SparkSession,
    root: str,
    name: str,
    where: Column | None = None,
    as_view: bool = False,
    days: DataFrame | None = None,
    among: Among | None = None,
) -> DataFrame:
    """Current rows of a stored table.

    ``where`` may select days, which are folders and so never read otherwise. It relies on a
    message that comes again keeping its trip and time; without it every day is read.
    """
    layout = layouts()[name]
    rows = scan_latest(spark, root, name, layout.keys, layout.schema, where, days, among).drop(BATCH)
    if as_view:
        rows.createOrReplaceTempView(name)
    return rows


def compact(spark: SparkSession, root: str, name: str, target_root: str) -> None:
    """Rewrite a table with its current rows only, under another root.

    Rows keep the batch they came from, so later batches go on in the new place.
    """
    layout = layouts()[name]
    rows = scan_latest(spark, root, name, layout.keys, layout.schema)
    (
        rows.withColumn(DAY, layout.day)
        .repartitionByRange(F.col(DAY), F.col(layout.keys[0]))
        .write.mode("overwrite")
        .partitionBy(BATCH, DAY)
        .parquet(f"{target_root}/{name}")
    )
