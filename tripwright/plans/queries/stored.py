"""Queries on stored tables: scans, cursors, upserts and copies under another key."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators import tables
from tripwright.operators.skew import checkpoint_folder
from tripwright.plans import fixtures as fx
from tripwright.plans.oracle import ELEMENTS, FX_EVENTS, FX_POINTS, FX_ROADS, FX_TRIPS, sql
from tripwright.plans.queries.joined import STAT_CTES
from tripwright.plans.queries.messages import FLAT_EVENT, PAYLOAD_KIND
from tripwright.plans.queries.registry import query
from tripwright.plans.queries.scores import NORMS, VEHICLE_SCORES, trip_score_result, vehicle_score
from tripwright.sources.tables import BATCH, NO_DAY, conform, load_table, scan_latest, write_versions
from tripwright.streaming.sinks import upsert_batch


def _new_root(spark: SparkSession) -> str:
    return f"{checkpoint_folder(spark)}/tables-{uuid4().hex}"


@query(
    sql(
        FLAT_EVENT.replace("company_id,", "NULL::VARCHAR AS company_id,"),
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
    )
)
def scan_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table read in its catalog layout; a column it lacks is NULL."""
    rows = conform(fx.stored_events(spark, sf_dir).drop("company_id"), "sf_event")
    root = _new_root(spark)
    upsert_batch(rows, root, "sf_event", 0)
    return load_table(spark, root, "sf_event")


@query(sql("SELECT min(trip_id) AS next_key FROM fx_points WHERE trip_id > '00000002-'", FX_POINTS))
def next_partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.next_key(fx.points(spark, sf_dir), "trip_id", "00000002-")


@query(
    sql(
        """SELECT trip_id, event_id, clt FROM fx_points WHERE trip_id =
        (SELECT min(trip_id) FROM fx_points WHERE trip_id > '00000002-')""",
        FX_POINTS,
    )
)
def list_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the next key of the work list, from a stored table; the key is one value."""
    root, schema = _new_root(spark), "trip_id string, event_id bigint, clt bigint"
    rows = fx.points(spark, sf_dir).select("trip_id", "event_id", "clt")
    write_versions(rows, root, "points", 0, F.lit(NO_DAY))
    stored = scan_latest(spark, root, "points", ["trip_id", "event_id"], schema).drop(BATCH)
    key = tables.next_key(stored, "trip_id", "00000002-").first()["next_key"]
    return tables.rows_with_key(stored, "trip_id", key)


# A batch of the oracle spans 100 days of events. Its writes come by event id, in several stored batches.
WRITE_PARTS = 3
WRITES = """
writes AS (
  SELECT vehicle_id || ':' || event_type AS key1, us // 8640000000000 AS batch_id, event_id, value
  FROM fx_base)"""


@query(
    sql(
        """SELECT key1, batch_id, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY key1 ORDER BY batch_id DESC, event_id DESC) AS rn
          FROM writes) WHERE rn = 1""",
        FX_POINTS,
        WRITES,
    )
)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table after all batches of writes: per key the last write stays."""
    writes = fx.points(spark, sf_dir).selectExpr(
        "concat(vehicle_id, ':', event_type) AS key1",
        "(clt - 1528163784000) div 432000 AS batch_id",
        "event_id",
        "value",
    )
    return upserted(spark, _new_root(spark), writes)


def upserted(spark: SparkSession, root: str, writes: DataFrame, parts: int = WRITE_PARTS) -> DataFrame:
    """A table after the upserts of all batches that ``writes`` has, whatever their numbers.

    Each batch is written in ``parts`` stored batches of consecutive event ids. A stored batch has
    the latest of its own writes per key, so that the latest of all is for the table to find.
    """
    schema = "key1 string, event_id bigint, value double, write_batch bigint"
    found = writes.groupBy(BATCH).agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"))
    for k, span in enumerate(found.orderBy(BATCH).collect()):
        width = (span["high"] - span["low"]) // parts + 1
        rows = writes.where(F.col(BATCH).eqNullSafe(span[BATCH])).withColumnRenamed(BATCH, "write_batch")
        for n in range(parts):
            low = span["low"] + n * width
            batch = rows.where(F.col("event_id").between(low, low + width - 1))
            last = tables.latest_per_key(batch, ["key1"], ["event_id"])
            write_versions(last, root, "writes", k * parts + n, F.lit(NO_DAY))
    return scan_latest(spark, root, "writes", ["key1"], schema).select(
        "key1", F.col("write_batch").alias(BATCH), "event_id", "value"
    )


@query(
    sql(
        """SELECT trip_id, start_ts, end_ts, n FROM fx_trips ORDER BY start_ts, trip_id LIMIT 5""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def first_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fx.trips(spark, sf_dir).select("trip_id", "start_ts", "end_ts", "n")
    return tables.first_rows(trips, 5, ["start_ts", "trip_id"])


def _with_gaps(frame: DataFrame, column: str) -> DataFrame:
    """Some rows without sensor, as incomplete keys must not reach the copies."""
    return frame.withColumn("sensor_id", F.expr(f"if(substr({column}, -1) = '7', NULL, sensor_id)"))


REKEYED_EVENTS = """SELECT trip_id, 'e' || event_id AS event_id, 'v' || vehicle_id AS vehicle_id,
sensor_id, '108' AS ty, device_type, event_ts::VARCHAR AS event_ts, user_id, payload
FROM payloads WHERE event_id % 10 <> 7"""
EVENT_COLUMNS = (
    "trip_id",
    "event_id",
    "vehicle_id",
    "sensor_id",
    "ty",
    "device_type",
    "event_ts",
    "user_id",
    "payload",
)


@query(sql(REKEYED_EVENTS, FX_POINTS, FX_EVENTS, ELEMENTS))
def rekey_event_by_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _with_gaps(fx.stored_events(spark, sf_dir), "event_id")
    return tables.rekey(events.select(*EVENT_COLUMNS), "event_by_trip")


@query(sql(REKEYED_EVENTS, FX_POINTS, FX_EVENTS, ELEMENTS))
def rekey_event_by_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _with_gaps(fx.stored_events(spark, sf_dir), "event_id")
    return tables.rekey(events.select(*EVENT_COLUMNS), "event_by_vehicle")


@query(
    sql(
        f"""SELECT 'v' || vehicle_id AS vehicle_id, device_type, ts, trip_id,
        'm' || event_id AS micro_trip_id, sensor_id, {PAYLOAD_KIND} AS kind
        FROM fx_points WHERE event_id % 10 <> 7""",
        FX_POINTS,
    )
)
def rekey_microtrip_by_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _with_gaps(fx.stored_microtrips(spark, sf_dir), "micro_trip_id").selectExpr(
        "vehicle_id",
        "device_type",
        "ts",
        "trip_id",
        "micro_trip_id",
        "sensor_id",
        "CASE WHEN payload IS NULL THEN 'absent' WHEN payload = '' THEN 'empty'"
        " WHEN payload LIKE '[%' THEN 'array' WHEN payload LIKE '{%' THEN 'object'"
        " ELSE 'text' END AS kind",
    )
    return tables.rekey(stored, "microtrip_by_vehicle")


@query(
    sql(
        """SELECT 'v' || t.vehicle_id AS vehicle_id, t.trip_id, f.mtrip_cnt,
        coalesce(l.metres, 0) AS distance FROM fx_trips t JOIN facts f ON f.trip_id = t.trip_id
        LEFT JOIN lengths l ON l.trip_id = t.trip_id""",
        *STAT_CTES,
    )
)
def rekey_stat_by_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = trip_score_result(spark, sf_dir)
    return tables.rekey(
        stats.select("vehicle_id", "trip_id", "mtrip_cnt", "distance"), "stat_by_vehicle"
    )


@query(sql(VEHICLE_SCORES, *STAT_CTES, FX_ROADS, NORMS))
def rekey_score_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.rekey(vehicle_score(spark, sf_dir), "score_by_user")
