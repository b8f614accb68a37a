"""Queries on point tracks: distances, speeds, driving events, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions import codes, geo, ids, text
from tripwright.operators import events as ev
from tripwright.operators import kinematics as kin
from tripwright.operators import rollups
from tripwright.operators.tables import latest_time_uuid
from tripwright.plans import fixtures as fx
from tripwright.plans.oracle import (
    CODE,
    FX_POINTS,
    FX_ROADS,
    FX_TRIPS,
    MASK,
    TAXI,
    moves,
    sql,
    step_km,
)
from tripwright.plans.queries.registry import query
from tripwright.schemas import SPEED_RULES

TRACK_IDS = ("trip_id", "sample_id")


@query(
    sql(
        """SELECT trip_id, sample_id, prev_time, elapsed_ms, round(step_m, 6) AS step_m,
        trunc(step_m)::BIGINT AS whole_m FROM
        (SELECT *, time - prev_time AS elapsed_ms FROM steps) WHERE prev_time IS NOT NULL""",
        FX_POINTS,
        moves("fx_points"),
    )
)
def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = kin.segments(fx.timed_points(spark, sf_dir))
    return steps.select(
        *TRACK_IDS,
        "prev_time",
        "elapsed_ms",
        F.round("step_m", 6).alias("step_m"),
        kin.whole_metres(F.col("step_m")).alias("whole_m"),
    )


@query(
    sql(
        """SELECT trip_id, sample_id, elapsed_ms // 1000 AS elapsed_sec,
        round(step_m / 1000.0, 9) AS distance_km,
        CASE WHEN elapsed_ms > 0 THEN trunc(step_m * 3600000.0 / elapsed_ms)::BIGINT END AS speed_mh
        FROM (SELECT *, time - prev_time AS elapsed_ms FROM steps) WHERE prev_time IS NOT NULL""",
        FX_POINTS,
        moves("fx_points"),
    )
)
def pair_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = kin.pair_speed(kin.segments(fx.timed_points(spark, sf_dir)))
    return steps.select(
        *TRACK_IDS, "elapsed_sec", F.round("distance_km", 9).alias("distance_km"), "speed_mh"
    )


MOVE_COLUMNS = (
    "trip_id, sample_id, head_time, head_lon, head_lat, time, lon, lat, elapsed_ms, distance_m, "
    "speed_mh"
)


def _moves(spark: SparkSession, sf_dir: str, window: int) -> DataFrame:
    found = kin.moves(fx.timed_points(spark, sf_dir), window)
    return found.select(*MOVE_COLUMNS.split(", "))


@query(sql(f"SELECT {MOVE_COLUMNS} FROM moves", FX_POINTS, moves("fx_points")))
def moves_w5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moves(spark, sf_dir, 5)


@query(sql(f"SELECT {MOVE_COLUMNS} FROM moves", FX_POINTS, moves("fx_points", w=1)))
def moves_w1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _moves(spark, sf_dir, 1)


@query(
    sql(
        """SELECT trip_id, sample_id, speed_mh, prev_speed_mh, speed_mh - prev_speed_mh AS delta_mh
        FROM moves WHERE prev_speed_mh IS NOT NULL""",
        FX_POINTS,
        moves("fx_points"),
    )
)
def speed_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kin.moves(fx.timed_points(spark, sf_dir)).where(F.col("prev_speed_mh").isNotNull())
    return found.select(
        *TRACK_IDS,
        "speed_mh",
        "prev_speed_mh",
        (F.col("speed_mh") - F.col("prev_speed_mh")).alias("delta_mh"),
    )


@query(
    sql(
        """SELECT trip_id, count(*) AS n_points, CASE WHEN count(*) < 3 THEN 0
        ELSE sum(trunc(step_m)::BIGINT)::BIGINT END AS device_dist,
        round(sum(step_m), 3) AS exact_m FROM steps GROUP BY trip_id""",
        FX_POINTS,
        moves("fx_points"),
    )
)
def trip_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = kin.with_moves(fx.timed_points(spark, sf_dir), 1)
    return moved.groupBy("trip_id").agg(
        F.count("time").alias("n_points"),
        kin.driven_distance().alias("device_dist"),
        F.round(F.sum("step_m"), 3).alias("exact_m"),
    )


@query(
    sql(
        f"""SELECT trip_id, sample_id, event, speed_mh, prev_speed_mh FROM
        (SELECT *, {TAXI} AS event FROM moves WHERE device_type IN ('GPS', 'BLACKBOX'))
        WHERE event IS NOT NULL""",
        FX_POINTS,
        moves("fx_points"),
    )
)
def traffic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.traffic_events(kin.moves(fx.timed_points(spark, sf_dir)))
    return found.select(*TRACK_IDS, "event", "speed_mh", "prev_speed_mh")


CATEGORY = (
    "CASE vehicle_id % 5 WHEN 0 THEN 'taxi' WHEN 1 THEN 'bus' WHEN 2 THEN 'truck'"
    " WHEN 3 THEN 'etas' END"
)


@query(
    sql(
        """SELECT trip_id, sample_id, event FROM (
          SELECT m.*, CASE
            WHEN speed_mh - prev_speed_mh > 0 AND speed_mh - prev_speed_mh >= gain
              AND prev_speed_mh <= slow THEN 'start'
            WHEN speed_mh - prev_speed_mh > 0 AND speed_mh - prev_speed_mh >= gain THEN 'accel'
            WHEN speed_mh - prev_speed_mh <= loss AND speed_mh <= still THEN 'stop'
            WHEN speed_mh - prev_speed_mh <= loss THEN 'deaccel' END AS event
          FROM moves m JOIN (VALUES ('taxi', 8000, 5000, -14000, 5000),
            ('bus', 6000, 5000, -9000, 5000), ('truck', 5000, 5000, -8000, 5000), ('etas', 11000, 0, -7500, 0))
            AS s(category, gain, slow, loss, still) ON s.category = coalesce(
              CASE vehicle_id % 5 WHEN 0 THEN 'taxi' WHEN 1 THEN 'bus' WHEN 2 THEN 'truck'
                WHEN 3 THEN 'etas' END, 'taxi')
          WHERE device_type IN ('GPS', 'BLACKBOX')) WHERE event IS NOT NULL""",
        FX_POINTS,
        moves("fx_points"),
    )
)
def traffic_events_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driving events by the rules of each vehicle's category."""
    points = fx.timed_points(spark, sf_dir).withColumn("category", F.expr(CATEGORY))
    return ev.traffic_events(kin.moves(points), category="category").select(*TRACK_IDS, "event")


EVENT_ROWS = f"""
found AS (
  SELECT *, '' AS info, {TAXI} AS event FROM moves WHERE device_type IN ('GPS', 'BLACKBOX')),
event_rows AS (
  SELECT vehicle_id, user_id, trip_id, lon AS pos_lon, lat AS pos_lat, time AS event_ts,
         ({CODE})::BIGINT AS event_type, speed_mh, info, device_type, 0::BIGINT AS created_time,
         sha256(trip_id || '|' || time || '|' || event || '|' || sample_id) AS id
  FROM found WHERE event IS NOT NULL)"""

LIMIT_ROWS = """
fast AS (
  SELECT m.*, r.road_id, r.max_speed_mh,
         '{"id":"' || road_id || '","maxSpd":' || max_speed_mh || ',"rank":' || rank || '}' AS info
  FROM moves m JOIN fx_roads r ON lon >= min_lon AND lon < max_lon AND lat >= min_lat
   AND lat < max_lat AND speed_mh > max_speed_mh)"""

LIMIT_EVENT_ROWS = """
limit_rows AS (
  SELECT vehicle_id, user_id, trip_id, lon AS pos_lon, lat AS pos_lat, time AS event_ts,
         5::BIGINT AS event_type, speed_mh, info, device_type, 0::BIGINT AS created_time,
         sha256(trip_id || '|' || time || '|overlimit|' || sample_id || '#' || road_id) AS id
  FROM fast)"""


def _typed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_type", F.col("event_type").cast("bigint"))


@query(sql("SELECT * FROM event_rows", FX_POINTS, moves("fx_points"), EVENT_ROWS))
def gps_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.traffic_events(kin.moves(fx.timed_points(spark, sf_dir)))
    return _typed(ev.event_rows(found, F.col("sample_id")))


@query(
    sql(
        "SELECT trip_id, sample_id, road_id, speed_mh, max_speed_mh, info FROM fast",
        FX_POINTS,
        FX_ROADS,
        moves("fx_points"),
        LIMIT_ROWS,
    )
)
def over_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kin.moves(fx.timed_points(spark, sf_dir))
    fast = ev.over_limit(found, fx.roads(spark, sf_dir), ["sample_id"])
    return fast.select(*TRACK_IDS, "road_id", "speed_mh", "max_speed_mh", "info")


@query(
    sql(
        """SELECT vehicle_id, trip_id, user_id, count(*) AS overlimit FROM fast
        GROUP BY vehicle_id, trip_id, user_id""",
        FX_POINTS,
        FX_ROADS,
        moves("fx_points"),
        LIMIT_ROWS,
    )
)
def over_limit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kin.moves(fx.timed_points(spark, sf_dir))
    return ev.over_limit_counts(ev.over_limit(found, fx.roads(spark, sf_dir), ["sample_id"]))


@query(
    sql(
        """SELECT *, 'check_event' AS source FROM event_rows
        UNION ALL SELECT *, 'check_over_limit' FROM limit_rows""",
        FX_POINTS,
        FX_ROADS,
        moves("fx_points"),
        EVENT_ROWS,
        LIMIT_ROWS,
        LIMIT_EVENT_ROWS,
    )
)
def all_gps_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = kin.moves(fx.timed_points(spark, sf_dir))
    fast = ev.over_limit(found, fx.roads(spark, sf_dir), ["sample_id"])
    driving = ev.event_rows(ev.traffic_events(found), F.col("sample_id"))
    limits = ev.event_rows(fast, F.concat_ws("#", F.col("sample_id"), F.col("road_id")))
    return _typed(ev.all_events(driving, limits))


@query(
    sql(
        """SELECT trip_id, start_from::BIGINT AS start_from, start_by::BIGINT AS start_by,
        accel_by::BIGINT AS accel_by, stop_by::BIGINT AS stop_by, stop_to::BIGINT AS stop_to,
        deaccel_by::BIGINT AS deaccel_by FROM fx_trips JOIN (VALUES ('taxi', 5000, 8000, 8000, -14000, 5000, -14000),
          ('bus', 5000, 6000, 6000, -9000, 5000, -9000),
          ('truck', 5000, 5000, 5000, -8000, 5000, -8000),
          ('etas', 0, 11000, 11000, -7500, 0, -7500))
          AS s(category, start_from, start_by, accel_by, stop_by, stop_to, deaccel_by)
        ON s.category = CASE WHEN trip_no % 7 = 0 THEN 'etas' ELSE coalesce(
          CASE vehicle_id % 5 WHEN 0 THEN 'taxi' WHEN 1 THEN 'bus' WHEN 2 THEN 'truck'
            WHEN 3 THEN 'etas' END, 'taxi') END""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def spec_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of each trip: by sensor type, else by vehicle category, else the default."""
    trips = fx.trips(spark, sf_dir).selectExpr(
        "trip_id", "if(trip_no % 7 = 0, 'etas', device_type) AS sensor", f"{CATEGORY} AS category"
    )
    ruled = trips.withColumn("r", ev.rules_of(F.col("sensor"), F.col("category"), SPEED_RULES))
    return ruled.selectExpr(
        "trip_id",
        *[
            f"cast(r['{event}'][{place}] AS bigint) AS {name}"
            for name, event, place in (
                ("start_from", "start", 0),
                ("start_by", "start", 1),
                ("accel_by", "accel", 1),
                ("stop_by", "stop", 1),
                ("stop_to", "stop", 2),
                ("deaccel_by", "deaccel", 1),
            )
        ],
    )


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE (event_id % 90) * 1000 END AS low,
    CASE WHEN event_id % 2 = 0 THEN (event_id % 40) * 1000 + 500 ELSE -(event_id % 40) * 1000 - 500
      END AS step,
    CASE WHEN event_id % 5 = 0 THEN -1 ELSE (event_id % 70) * 1000 END AS high FROM events"""
)
def spec_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = fx.points(spark, sf_dir).selectExpr(
        "event_id",
        "concat_ws(',', if(event_id % 3 = 0, '-', string(event_id % 90)),"
        " concat(if(event_id % 2 = 0, '', '-'), event_id % 40, '.5'),"
        " if(event_id % 5 = 0, '-', string(event_id % 70))) AS rule",
    )
    values = rules.select("event_id", text.rule_values(F.col("rule")).alias("v"))
    return values.selectExpr(
        "event_id",
        "cast(v[0] AS bigint) AS low",
        "cast(v[1] AS bigint) AS step",
        "cast(v[2] AS bigint) AS high",
    )


@query(
    sql(
        "SELECT event_id, "
        + ", ".join(
            f"(CASE WHEN em > 0 THEN (em >> {i}) & 1 ELSE 0 END)::BIGINT AS {n}"
            for i, n in enumerate(MASK)
        )
        + " FROM fx_points",
        FX_POINTS,
    )
)
def em_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = codes.mask_flags("em")
    return fx.points(spark, sf_dir).selectExpr(
        "event_id", *[f"cast({f} AS bigint) AS {n}" for n, f in flags.items()]
    )


@query(
    sql(
        """SELECT event_id, (ldw = 31)::BIGINT AS lldw, (ldw = 32)::BIGINT AS rldw,
        (fcw = 31)::BIGINT AS fcw1, (fcw = 32)::BIGINT AS fcw2 FROM fx_points""",
        FX_POINTS,
    )
)
def adas_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = codes.assist_flags("ldw", "fcw")
    return fx.points(spark, sf_dir).selectExpr(
        "event_id", *[f"cast({f} AS bigint) AS {n}" for n, f in flags.items()]
    )


@query(
    sql(
        f"""SELECT event_id, round({step_km('lon', 'lat', '126.97', '37.56')}, 9) AS km
        FROM fx_points""",
        FX_POINTS,
    )
)
def haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    km = geo.haversine_km(F.col("lon"), F.col("lat"), F.lit(126.97), F.lit(37.56))
    return fx.points(spark, sf_dir).select("event_id", F.round(km, 9).alias("km"))


def _bearing_sql(angle: str) -> str:
    lat1, lat2 = f"{angle}(37.49)", f"{angle}(lat)"
    dlon = f"{angle}(lon - 126.89)"
    return sql(
        f"""SELECT event_id, CASE WHEN deg < 0 THEN trunc(deg)::BIGINT + 360
        ELSE trunc(deg)::BIGINT END AS degrees FROM (SELECT event_id, atan2(
          sin({dlon}) * cos({lat2}),
          cos({lat1}) * sin({lat2}) - sin({lat1}) * cos({lat2}) * cos({dlon})) * 180 / pi() AS deg
        FROM fx_points)""",
        FX_POINTS,
    )


def _bearing(spark: SparkSession, sf_dir: str, raw: bool) -> DataFrame:
    degrees = geo.bearing(F.lit(126.89), F.lit(37.49), F.col("lon"), F.col("lat"), raw)
    return fx.points(spark, sf_dir).select("event_id", degrees.cast("bigint").alias("degrees"))


@query(_bearing_sql("radians"))
def bearing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bearing(spark, sf_dir, False)


@query(_bearing_sql(""))
def bearing_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bearing(spark, sf_dir, True)


@query(
    """SELECT event_id, CASE WHEN event_id % 10 <> 0 AND event_id % 11 <> 0 THEN
    '{lon:' || (126000 + event_id % 1000) / 1000.0::DOUBLE || ',lat:'
    || (37000 + event_id % 1000) / 1000.0::DOUBLE || '}' END AS pos FROM events"""
)
def lon_lat_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.points(spark, sf_dir).selectExpr(
        "event_id",
        "if(event_id % 10 = 0, NULL, (126000 + event_id % 1000) / 1000.0D) AS lon",
        "if(event_id % 11 = 0, NULL, (37000 + event_id % 1000) / 1000.0D) AS lat",
    )
    return rows.select("event_id", text.lon_lat_text(F.col("lon"), F.col("lat")).alias("pos"))


@query(
    sql(
        """SELECT trip_id, 488 * 281474976710656 + 26723 * 4294967296 + trip_no AS ticks,
        (488 * 281474976710656 + 26723 * 4294967296 + trip_no - 122192928000000000) // 10000 AS ms,
        strftime(make_timestamp((488 * 281474976710656 + 26723 * 4294967296 + trip_no
          - 122192928000000000) // 10), '%Y-%m-%d') AS utc_date,
        strftime(make_timestamp((488 * 281474976710656 + 26723 * 4294967296 + trip_no
          - 122192928000000000) // 10) - INTERVAL 9 HOURS, '%Y-%m-%d') AS west_date
        FROM fx_trips""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def uuid_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    trip = F.col("trip_id")
    return fx.trips(spark, sf_dir).select(
        "trip_id",
        ids.uuid_ticks(trip).alias("ticks"),
        ids.uuid_millis(trip).alias("ms"),
        ids.uuid_date(trip).cast("string").alias("utc_date"),
        ids.uuid_date(trip, "-09:00").cast("string").alias("west_date"),
    )


@query(
    sql(
        """SELECT vehicle_id, arg_max(trip_id, trip_no) AS latest_trip_id FROM fx_points
        GROUP BY vehicle_id""",
        FX_POINTS,
    )
)
def max_timeuuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_time_uuid(fx.points(spark, sf_dir), ["vehicle_id"], "trip_id")


@query(
    sql(
        """SELECT trip_id, count(*) AS mtrip_cnt, min(time) AS first_time, max(time) AS last_time,
        arg_min(vehicle_id, (time, sample_id)) AS vehicle_id,
        arg_min(user_id, (time, sample_id)) AS user_id,
        arg_min(company_id, (time, sample_id)) AS company_id,
        arg_min(device_type, (time, sample_id)) AS device_type,
        arg_min(sensor_id, (time, sample_id)) AS sensor_id FROM fx_points GROUP BY trip_id""",
        FX_POINTS,
    )
)
def trip_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.trip_rollup(fx.timed_points(spark, sf_dir))


@query(
    sql(
        """SELECT vehicle_id, count(*) AS mtrip_cnt, min(time) AS first_time, max(time) AS last_time,
        arg_min(trip_id, (time, sample_id)) AS trip_id,
        arg_min(user_id, (time, sample_id)) AS user_id,
        arg_min(company_id, (time, sample_id)) AS company_id,
        arg_min(device_type, (time, sample_id)) AS device_type,
        arg_min(sensor_id, (time, sample_id)) AS sensor_id FROM fx_points GROUP BY vehicle_id""",
        FX_POINTS,
    )
)
def vehicle_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.vehicle_rollup(fx.timed_points(spark, sf_dir))


@query(
    sql(
        """SELECT trip_id, time // 60000 AS slice, 0::BIGINT AS piece, count(*) AS n,
        string_agg(time || ':' || sample_id || ':' || em, ',' ORDER BY time, sample_id) AS points
        FROM fx_points GROUP BY trip_id, time // 60000""",
        FX_POINTS,
    )
)
def collect_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = rollups.collect_points(fx.timed_points(spark, sf_dir), ["lon", "lat", "em"])
    shown = F.array_join(
        F.transform("points", lambda p: F.concat_ws(":", p["time"], p["sample_id"], p["em"])), ","
    )
    return pieces.withColumn("points", shown)
