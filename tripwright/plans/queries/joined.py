"""Queries on joins of trips with samples and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators import joins, stats
from tripwright.operators.skew import checkpointed
from tripwright.plans import fixtures as fx
from tripwright.plans import score
from tripwright.plans.oracle import (
    ELEMENTS,
    FX_EVENTS,
    FX_POINTS,
    FX_TRIPS,
    SAMPLES,
    counters,
    elements,
    merged_texts,
    moves,
    sql,
)
from tripwright.plans.queries.registry import query
from tripwright.schemas import COUNTERS, TEXTS


@query(
    sql(
        """SELECT t.trip_id, 'v' || t.vehicle_id AS vehicle_id, user_id, sensor_id, company_id,
        start_ts, 'dt' || start_ts AS start_dt, end_ts, 'dt' || end_ts AS end_dt, t.device_type,
        (start_ts + 3376)::VARCHAR AS trip_created_time, n::VARCHAR AS updated, 'trip' AS msg_type,
        micro_trip_id, pos::BIGINT AS pos, ts AS mtrip_ts, clt, lon, lat,
        (ts + 500)::VARCHAR AS mtrip_created_time, '2018-06-' || (event_id % 20 + 10) AS mtrip_date,
        CASE trip_no % 5 WHEN 2 THEN '' WHEN 3 THEN NULL
          ELSE '{"tid":' || trip_no % 1000 || ',"dis":' || n * 10 || CASE trip_no % 5
            WHEN 0 THEN ',"stlat":37.5,"stlon":126.9,"edlat":37.25,"edlon":126.75'
            WHEN 1 THEN ',"stlat":37.5,"stlon":126.9,"endlat":37.125,"endlon":126.5'
            ELSE '' END || '}' END AS trip_payload_str,
        CASE WHEN t.device_type = 'OBD' THEN 'BLACKBOX,OBD' WHEN t.device_type = 'ADAS' THEN 'ADAS'
          WHEN t.device_type = 'GPS' THEN if(trip_no % 2 = 1, 'GPS,ADAS', 'BLACKBOX,GPS')
          ELSE if(trip_no % 2 = 1, 'OTHER', 'BLACKBOX') END AS latest_devices
        FROM fx_trips t JOIN samples s ON s.trip_id = t.trip_id""",
        FX_POINTS,
        FX_TRIPS,
        SAMPLES,
    )
)
def join_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fx.stored_microtrips(spark, sf_dir)
    more = [F.col("created_time").alias("mtrip_created_time"), F.col("date").alias("mtrip_date")]
    samples = score.stored_samples(stored, more)
    joined = joins.join_samples(fx.scored_trips(spark, sf_dir), samples, score.SAMPLE_TIE)
    return joined.select(
        "trip_id",
        "vehicle_id",
        "user_id",
        "sensor_id",
        "company_id",
        "start_ts",
        "start_dt",
        "end_ts",
        "end_dt",
        "device_type",
        "trip_created_time",
        "updated",
        "msg_type",
        "micro_trip_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("ts").alias("mtrip_ts"),
        "clt",
        "lon",
        "lat",
        "mtrip_created_time",
        "mtrip_date",
        "trip_payload_str",
        F.array_join(F.transform("latest_trip", lambda d: d["deviceType"]), ",").alias(
            "latest_devices"
        ),
    )


@query(
    sql(
        """SELECT t.trip_id, 'v' || t.vehicle_id AS vehicle_id, 'e' || event_id AS event_id, payload
        FROM fx_trips t LEFT JOIN payloads p ON p.trip_id = t.trip_id""",
        FX_POINTS,
        FX_TRIPS,
        FX_EVENTS,
        ELEMENTS,
    )
)
def left_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fx.scored_trips(spark, sf_dir).select("trip_id", "vehicle_id")
    events = fx.stored_events(spark, sf_dir).select("trip_id", "event_id", "payload")
    return joins.left_join_events(trips, events, ["event_id"])


@query(
    sql(
        """SELECT t.trip_id, p.event_id FROM fx_trips t JOIN fx_points p
        ON p.vehicle_id = t.vehicle_id AND p.clt BETWEEN t.start_ts AND t.end_ts""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def range_join_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = fx.trips(spark, sf_dir).select("trip_id", "vehicle_id", "start_ts", "end_ts")
    points = fx.points(spark, sf_dir).select("vehicle_id", "event_id", "clt")
    found = joins.range_join(
        trips, points, ["vehicle_id"], "start_ts", "end_ts", "clt", ["event_id"]
    )
    return found.select("trip_id", "event_id")


@query(
    sql(
        """SELECT t.trip_id, 'e' || e.event_id AS event_id, e.event_ts FROM fx_trips t
        LEFT JOIN fx_events e ON e.vehicle_id = t.vehicle_id
         AND e.event_ts BETWEEN t.start_ts AND t.end_ts""",
        FX_POINTS,
        FX_TRIPS,
        FX_EVENTS,
    )
)
def range_join_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with the events in their time range; the stored event time is text."""
    trips = fx.scored_trips(spark, sf_dir).select("trip_id", "vehicle_id", "start_ts", "end_ts")
    matched = checkpointed(score.matched_events(trips, fx.stored_events(spark, sf_dir)))
    rows = joins.with_unmatched(trips, matched, matched, "trip_id")
    return rows.select("trip_id", "event_id", "event_ts")


COUNTS = """
fan AS (
  SELECT t.trip_id, (SELECT count(*) FROM fx_points p WHERE p.trip_id = t.trip_id) AS n_samples,
         (SELECT count(*) FROM fx_events e WHERE e.trip_id = t.trip_id) AS n_events
  FROM fx_trips t)"""


@query(
    sql(
        """SELECT trip_id, n_samples, n_events, n_samples * greatest(n_events, 1) AS n_rows
        FROM fan""",
        FX_POINTS,
        FX_TRIPS,
        FX_EVENTS,
        COUNTS,
    )
)
def fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.fanout_counts(
        fx.trips(spark, sf_dir), fx.points(spark, sf_dir), fx.device_events(spark, sf_dir), "trip_id"
    )


@query(
    sql(
        "SELECT p.trip_id, count(*) AS mtrip_cnt, "
        + counters()
        + """ FROM fx_points p LEFT JOIN (SELECT trip_id FROM fx_events) e
        ON e.trip_id = p.trip_id GROUP BY p.trip_id""",
        FX_POINTS,
        FX_EVENTS,
    )
)
def fanout_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters as the three-way join would sum them, every sample once per event."""
    points, events = fx.points(spark, sf_dir), fx.device_events(spark, sf_dir)
    counts = events.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n_events"))
    names = ["mtrip_cnt", *COUNTERS[:11]]
    return stats.weighted(stats.sample_counters(points), counts, names, "trip_id")


@query(
    sql(
        f"SELECT trip_id, count(*) AS mtrip_cnt, {counters()} FROM samples GROUP BY trip_id",
        FX_POINTS,
        SAMPLES,
    )
)
def sample_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.sample_counters(score.stored_samples(fx.stored_microtrips(spark, sf_dir)))


@query(
    sql(
        """SELECT trip_id, lldw, rldw, fcw1, fcw2 FROM event_stat""",
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
        elements("trip_id"),
        merged_texts("trip_id"),
    )
)
def event_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.event_counters(fx.stored_events(spark, sf_dir))


TEXT_ROWS = """
texts AS (
  UNPIVOT (SELECT DISTINCT trip_id, dtcc, cwdrv, cwprk, bw, bbxwn FROM elements)
  ON dtcc, cwdrv, cwprk, bw, bbxwn INTO NAME field VALUE text),
trip_texts AS (SELECT DISTINCT trip_id, field, text FROM texts WHERE text <> '')"""

TEXT_TRIPS = """
SELECT trip_id, max(CASE WHEN field = 'dtcc' THEN merged ELSE '' END) AS dtcc,
  max(CASE WHEN field = 'cwdrv' THEN merged ELSE '' END) AS cwdrv,
  max(CASE WHEN field = 'cwprk' THEN merged ELSE '' END) AS cwprk,
  max(CASE WHEN field = 'bw' THEN merged ELSE '' END) AS bw,
  max(CASE WHEN field = 'bbxwn' THEN merged ELSE '' END) AS bbxwn
FROM merged GROUP BY trip_id"""


@query(
    sql(
        "SELECT trip_id, field, text FROM trip_texts",
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
        elements("trip_id"),
        TEXT_ROWS,
    )
)
def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.event_texts(fx.stored_events(spark, sf_dir))


@query(
    sql(
        TEXT_TRIPS,
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
        elements("trip_id"),
        TEXT_ROWS,
        """
merged AS (
  SELECT trip_id, field, string_agg(text, ',' ORDER BY text) AS merged
  FROM trip_texts GROUP BY trip_id, field)""",
    )
)
def merge_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.merge_texts(stats.event_texts(fx.stored_events(spark, sf_dir)))


@query(
    sql(
        TEXT_TRIPS,
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
        elements("trip_id"),
        TEXT_ROWS,
        """
merged AS (
  SELECT trip_id, field, list_reduce(list(text ORDER BY text), lambda done, t:
    CASE WHEN contains(done, t) THEN done ELSE done || ',' || t END) AS merged
  FROM trip_texts GROUP BY trip_id, field)""",
    )
)
def merge_texts_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = stats.event_texts(fx.stored_events(spark, sf_dir))
    return stats.merge_texts(texts, by_substring=True)


DEVICE_FACTS = f"""
facts AS (SELECT trip_id, count(*) AS mtrip_cnt, {counters()} FROM samples GROUP BY trip_id),
lengths AS (
  SELECT trip_id, CASE WHEN count(*) < 3 THEN 0 ELSE sum(trunc(step_m)::BIGINT)::BIGINT END AS metres
  FROM steps GROUP BY trip_id)"""

STAT_SUMS = ", ".join(
    [f"f.{c}::BIGINT AS {c}" for c in COUNTERS[:7]]
    + [f"(f.{c} + coalesce(s.{c}, 0))::BIGINT AS {c}" for c in COUNTERS[7:11]]
    + ["0::BIGINT AS overlimit"]
)
STAT_TEXTS = ", ".join(f"coalesce(s.{t}, '') AS {t}" for t in TEXTS)

STAT_CTES = (
    FX_POINTS,
    FX_TRIPS,
    FX_EVENTS,
    SAMPLES,
    ELEMENTS,
    elements("trip_id"),
    merged_texts("trip_id"),
    moves("samples", tie="micro_trip_id, pos"),
    DEVICE_FACTS,
)


@query(
    sql(
        f"""SELECT t.trip_id, 'v' || t.vehicle_id AS vehicle_id, t.user_id, t.company_id,
        '2018-06-05' AS date, t.device_type, {STAT_SUMS}, coalesce(l.metres, 0) AS distance,
        {STAT_TEXTS}
        FROM fx_trips t JOIN facts f ON f.trip_id = t.trip_id
        LEFT JOIN lengths l ON l.trip_id = t.trip_id
        LEFT JOIN event_stat s ON s.trip_id = t.trip_id""",
        *STAT_CTES,
    )
)
def trip_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = score.trip_score(
        fx.scored_trips(spark, sf_dir),
        fx.stored_microtrips(spark, sf_dir),
        fx.stored_events(spark, sf_dir),
    )
    return result.select(
        "trip_id", "vehicle_id", "user_id", "company_id", "date", "device_type", *COUNTERS, *TEXTS
    )
