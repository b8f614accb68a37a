"""Queries on keyed messages and their payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators import devices, payloads
from tripwright.operators import messages as m
from tripwright.operators.points import clean_points as cleaned
from tripwright.operators.stats import distinct_payloads as distinct_event_payloads
from tripwright.plans import fixtures as fx
from tripwright.plans.oracle import (
    ELEMENTS,
    FX_EVENTS,
    FX_POINTS,
    FX_TRIPS,
    LATEST_DEVICES,
    SAMPLES,
    elements,
    sql,
)
from tripwright.plans.queries.registry import query

ALL_KEYS = """
SELECT 'sf-microtrip' AS key, 'microtrip' AS msg_type, trip_id FROM fx_points
UNION ALL SELECT 'sf-trip', 'trip', trip_id FROM fx_trips
UNION ALL SELECT 'sf-event', 'event', trip_id FROM fx_events"""


def _as_lines(frame: DataFrame) -> DataFrame:
    return frame.select(
        "key",
        F.get_json_object("value", "$.msgType").alias("msg_type"),
        F.get_json_object("value", "$.data.tripId").alias("trip_id"),
    )


@query(sql(ALL_KEYS, FX_POINTS, FX_TRIPS, FX_EVENTS))
def bronze_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.messages(spark, sf_dir).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")
    )
    return _as_lines(m.key_value(raw))


@query(
    sql(
        f"SELECT key, count(*) AS count FROM ({ALL_KEYS}) GROUP BY key",
        FX_POINTS,
        FX_TRIPS,
        FX_EVENTS,
    )
)
def demux_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.key_counts(fx.messages(spark, sf_dir))


@query(
    sql(
        f"""SELECT key, trip_id FROM ({ALL_KEYS})
        UNION ALL SELECT 'none', NULL FROM events WHERE event_type = 'view'""",
        FX_POINTS,
        FX_TRIPS,
        FX_EVENTS,
    )
)
def route_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded lines, some with a topic prefix, some without any message."""
    sent = fx.messages(spark, sf_dir).select(
        F.when(F.col("key") == "sf-trip", F.concat(F.lit("sf-trip | "), F.col("value")))
        .otherwise(F.col("value"))
        .alias("value")
    )
    noise = (
        fx.points(spark, sf_dir)
        .where(F.col("event_type") == "view")
        .select(F.concat(F.lit("line "), F.col("event_id")).alias("value"))
    )
    routed = m.route_lines(sent.unionByName(noise))
    return routed.select("key", F.get_json_object("value", "$.data.tripId").alias("trip_id"))


@query(sql("SELECT 'sf-score' AS key, trip_id FROM fx_trips", FX_POINTS, FX_TRIPS))
def forward_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.to_score(fx.messages(spark, sf_dir)).select(
        "key", F.get_json_object("value", "$.data.tripId").alias("trip_id")
    )


PAYLOAD_KIND = """CASE event_id % 20 WHEN 0 THEN 'object' WHEN 1 THEN 'empty' WHEN 2 THEN 'text'
  WHEN 4 THEN 'absent' WHEN 6 THEN 'object' ELSE 'array' END"""


def _kind(payload: str) -> Column:
    p = F.col(payload)
    return (
        F.when(p.isNull(), "absent")
        .when(p == "", "empty")
        .when(p.startswith("["), "array")
        .when(p.startswith("{"), "object")
        .otherwise("text")
    )


@query(
    sql(
        f"""SELECT 'm' || event_id AS microTripId, trip_id AS tripId, sensor_id AS sensorId,
        'v' || vehicle_id AS vehicleId, '2018-06-' || (event_id % 20 + 10) AS date, ts,
        device_type AS deviceType, (clt + 1000)::VARCHAR AS createdTime, company_id AS companyId,
        'microtrip' AS msgType, {PAYLOAD_KIND} AS kind FROM fx_points""",
        FX_POINTS,
    )
)
def parse_microtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = m.parse_microtrips(fx.messages(spark, sf_dir)).select("data.*", "msgType")
    return parsed.withColumn("kind", _kind("payload")).drop("payload")


@query(
    sql(
        """SELECT 'e' || event_id AS eventId, trip_id AS tripId, sensor_id AS sensorId,
        'v' || vehicle_id AS vehicleId, user_id AS userId, company_id AS companyId,
        device_type AS deviceType, '108' AS ty, payload, event_ts::VARCHAR AS eventTs,
        'dt' || event_ts AS eventDt, (event_ts + 1000)::VARCHAR AS createdTime, 'event' AS msgType
        FROM payloads""",
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
    )
)
def parse_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.parse_events(fx.messages(spark, sf_dir)).select("data.*", "msgType")


@query(
    sql(
        """SELECT trip_id AS tripId, 'v' || vehicle_id AS vehicleId, user_id AS userId,
        sensor_id AS sensorId, company_id AS companyId, start_ts::VARCHAR AS startTs,
        'dt' || start_ts AS startDt, end_ts::VARCHAR AS endTs, 'dt' || end_ts AS endDt,
        device_type AS deviceType, (start_ts + 3376)::VARCHAR AS createdTime,
        n::VARCHAR AS updated, 'trip' AS msgType,
        (CASE WHEN device_type = 'OBD' OR device_type = 'GPS' THEN 2 ELSE 1 END)::BIGINT AS devices
        FROM fx_trips""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def parse_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = m.parse_trips(fx.messages(spark, sf_dir))
    return parsed.select(
        "data.*", "msgType", F.size("latestTrip").cast("bigint").alias("devices")
    ).drop("payload")


FLAT_MICROTRIP = f"""SELECT 'm' || event_id AS key1, 'm' || event_id AS micro_trip_id,
'v' || vehicle_id AS vehicle_id, trip_id, sensor_id, (clt + 1000)::VARCHAR AS created_time,
'2018-06-' || (event_id % 20 + 10) AS date, device_type, ts, {PAYLOAD_KIND} AS kind
FROM fx_points"""


@query(sql(FLAT_MICROTRIP, FX_POINTS))
def flatten_microtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = m.flatten_microtrips(m.parse_microtrips(fx.messages(spark, sf_dir)))
    return flat.withColumn("kind", _kind("payload")).drop("payload")


@query(sql(FLAT_MICROTRIP.replace("WHEN 4 THEN 'absent'", "WHEN 4 THEN 'empty'"), FX_POINTS))
def fill_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = m.flatten_microtrips(m.parse_microtrips(fx.messages(spark, sf_dir)))
    return m.fill_texts(flat).withColumn("kind", _kind("payload")).drop("payload")


FLAT_EVENT = """SELECT 'e' || event_id AS key1, 'v' || vehicle_id AS vehicle_id, trip_id,
'e' || event_id AS event_id, company_id, '108' AS ty, sensor_id,
(event_ts + 1000)::VARCHAR AS created_time, 'dt' || event_ts AS event_dt,
event_ts::VARCHAR AS event_ts, payload, device_type, user_id FROM payloads"""


@query(sql(FLAT_EVENT, FX_POINTS, FX_EVENTS, ELEMENTS))
def flatten_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.flatten_events(m.parse_events(fx.messages(spark, sf_dir)))


TRIP_PAYLOAD_TEXT = """CASE trip_no % 5
  WHEN 0 THEN '{"tid":' || (trip_no % 1000) || ',"dis":' || (n * 10)
    || ',"stlat":37.5,"stlon":126.9,"edlat":37.25,"edlon":126.75}'
  WHEN 1 THEN '{"tid":' || (trip_no % 1000) || ',"dis":' || (n * 10)
    || ',"stlat":37.5,"stlon":126.9,"endlat":37.125,"endlon":126.5}'
  WHEN 2 THEN '' WHEN 3 THEN NULL
  ELSE '{"tid":' || (trip_no % 1000) || ',"dis":' || (n * 10) || '}' END"""


@query(
    sql(
        f"""SELECT trip_id AS key1, 'v' || vehicle_id AS vehicle_id, trip_id, sensor_id,
        (start_ts + 3376)::VARCHAR AS created_time,
        strftime(timestamp '1970-01-01 00:00:00' + to_milliseconds(start_ts), '%Y-%m-%d') AS date,
        device_type, 'dt' || end_ts AS end_dt, end_ts::VARCHAR AS end_ts,
        'dt' || start_ts AS start_dt, start_ts::VARCHAR AS start_ts, {TRIP_PAYLOAD_TEXT} AS payload,
        'spark_index1' AS spark_idx, n::VARCHAR AS updated, user_id FROM fx_trips""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def flatten_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.flatten_trips(m.parse_trips(fx.messages(spark, sf_dir)))


@query(
    sql(
        """SELECT trip_id,
        CASE WHEN trip_no % 5 IN (0, 1, 4) THEN trip_no % 1000 END AS tid,
        CASE WHEN trip_no % 5 IN (0, 1, 4) THEN n * 10 END AS dis,
        CASE WHEN trip_no % 5 IN (0, 1) THEN 37.5::DOUBLE END AS stlat,
        CASE WHEN trip_no % 5 IN (0, 1) THEN 126.9::DOUBLE END AS stlon,
        CASE trip_no % 5 WHEN 0 THEN 37.25::DOUBLE WHEN 1 THEN 37.125::DOUBLE END AS endlat,
        CASE trip_no % 5 WHEN 0 THEN 126.75::DOUBLE WHEN 1 THEN 126.5::DOUBLE END AS endlon
        FROM fx_trips""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def trip_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = fx.scored_trips(spark, sf_dir).select(
        "trip_id", payloads.parse_trip_payload(F.col("trip_payload_str")).alias("p")
    )
    return parsed.select("trip_id", "p.*").withColumns(
        {c: F.col(c).cast("bigint") for c in ("tid", "dis")}
    )


@query(
    sql(
        "SELECT micro_trip_id, pos::BIGINT AS pos, lon, lat, clt, sp, em, ldw, fcw FROM samples",
        FX_POINTS,
        SAMPLES,
    )
)
def explode_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fx.stored_microtrips(spark, sf_dir).select("micro_trip_id", "payload")
    return payloads.explode_samples(stored).withColumns(
        {c: F.col(c).cast("bigint") for c in ("pos", "sp", "em", "ldw", "fcw")}
    )


@query(
    sql(
        """SELECT trip_id, micro_trip_id, pos::BIGINT AS pos, time, lon, lat
        FROM samples WHERE time IS NOT NULL""",
        FX_POINTS,
        SAMPLES,
    )
)
def clean_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fx.stored_microtrips(spark, sf_dir).select("trip_id", "micro_trip_id", "ts", "payload")
    clean = cleaned(payloads.explode_samples(stored))
    return clean.select(
        "trip_id", "micro_trip_id", F.col("pos").cast("bigint").alias("pos"), "time", "lon", "lat"
    )


@query(
    sql(
        """SELECT 'e' || event_id AS event_id, CASE WHEN shape = 0 THEN 31::BIGINT ELSE 0 END AS ldw,
        CASE shape WHEN 1 THEN 31::BIGINT WHEN 5 THEN 32 ELSE 0 END AS fcw,
        CASE WHEN shape IN (0, 1) THEN dtcc ELSE '' END AS dtcc,
        CASE WHEN shape = 2 THEN '{lon:' || elon || ',lat:' || elat || '}' ELSE '' END AS cwdrv,
        CASE WHEN shape = 5 THEN '{lon:' || elon || ',lat:' || elat || '}' ELSE '' END AS cwprk,
        CASE WHEN shape = 0 THEN wbv::VARCHAR ELSE '' END AS bw, '' AS bbxwn
        FROM fx_events WHERE shape IN (0, 1, 2, 5)
        UNION ALL SELECT 'e' || event_id, 0, 0, 'P2600', '', '', '', '3'
        FROM fx_events WHERE shape = 1""",
        FX_POINTS,
        FX_EVENTS,
    )
)
def event_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = fx.stored_events(spark, sf_dir).select("event_id", "payload")
    return payloads.event_elements(stored).withColumns(
        {c: F.col(c).cast("bigint") for c in ("ldw", "fcw")}
    )


@query(
    sql(
        "SELECT 'e' || event_id AS event_id, payload FROM payloads WHERE shape IN (3, 4)",
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
    )
)
def rejected_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.rejected(fx.stored_events(spark, sf_dir)).select("event_id", "payload")


@query(
    sql(
        "SELECT trip_id, payload FROM distinct_payloads",
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
        elements("trip_id"),
    )
)
def distinct_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_event_payloads(fx.stored_events(spark, sf_dir))


@query(
    sql("SELECT trip_id, base_device_type FROM own_devices", FX_POINTS, FX_TRIPS, LATEST_DEVICES)
)
def base_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.scored_trips(spark, sf_dir).select(
        "trip_id", devices.base_device(F.col("latest_trip")).alias("base_device_type")
    )


@query(
    sql(
        """SELECT trip_id, device_type, base_device_type FROM fx_trips JOIN own_devices
        USING (trip_id) WHERE device_type = base_device_type""",
        FX_POINTS,
        FX_TRIPS,
        LATEST_DEVICES,
    )
)
def base_device_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.base_device_trips(fx.scored_trips(spark, sf_dir)).select(
        "trip_id", "device_type", "base_device_type"
    )


@query(
    sql(
        """SELECT 'sf-microtrip,{"data":{"microTripId":"m' || event_id || '","tripId":"' || trip_id
        || '","sensorId":"' || sensor_id || '","vehicleId":"v' || vehicle_id || '"'
        || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',"date":"d' || event_id % 30 || '"' END
        || ',"ts":' || ts
        || CASE WHEN event_id % 4 = 0 THEN '' ELSE ',"payload":"{\\"em\\":' || em || '}"' END
        || ',"deviceType":"' || device_type || '","createdTime":' || (clt + 1000)
        || '},"companyId":"' || company_id || '","sensorId":"' || sensor_id
        || '","msgType":"microtrip"}' AS line FROM fx_points""",
        FX_POINTS,
    )
)
def serialize_microtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.points(spark, sf_dir).selectExpr(
        "concat('m', event_id) AS micro_trip_id",
        "trip_id",
        "sensor_id",
        "concat('v', vehicle_id) AS vehicle_id",
        "if(event_id % 3 = 0, NULL, concat('d', event_id % 30)) AS date",
        "ts",
        "if(event_id % 4 = 0, NULL, to_json(struct(em))) AS payload",
        "device_type",
        "clt + 1000 AS created_time",
        "company_id",
    )
    return rows.select(m.microtrip_line().alias("line"))


@query(
    sql(
        """SELECT 'sf-trip,{"data":{"tripId":"' || trip_id || '","vehicleId":"v' || vehicle_id
        || '","userId":"' || user_id || '","sensorId":"' || sensor_id || '"'
        || CASE WHEN trip_no % 3 = 0 THEN '' ELSE ',"companyId":"' || company_id || '"' END
        || ',"startTs":' || start_ts || ',"startDt":"dt' || start_ts || '","endTs":' || end_ts
        || ',"endDt":"dt' || end_ts || '","deviceType":"' || device_type || '","createdTime":'
        || (start_ts + 3376)
        || CASE WHEN trip_no % 4 = 0 THEN '' ELSE ',"payload":"{\\"dis\\":' || n || '}"' END
        || ',"updated":' || n || '},"latestTrip":[{"deviceType":"' || device_type
        || '","id":null}],"companyId":"'
        || CASE WHEN trip_no % 3 = 0 THEN '' ELSE company_id END
        || '","sensorId":"' || sensor_id || '","msgType":"trip"}' AS line FROM fx_trips""",
        FX_POINTS,
        FX_TRIPS,
    )
)
def serialize_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.trips(spark, sf_dir).selectExpr(
        "trip_id",
        "concat('v', vehicle_id) AS vehicle_id",
        "user_id",
        "sensor_id",
        "if(trip_no % 3 = 0, NULL, company_id) AS company_id",
        "start_ts",
        "concat('dt', start_ts) AS start_dt",
        "end_ts",
        "concat('dt', end_ts) AS end_dt",
        "device_type",
        "start_ts + 3376 AS trip_created_time",
        "if(trip_no % 4 = 0, NULL, concat('{\"dis\":', n, '}')) AS trip_payload_str",
        "n AS updated",
    )
    return rows.select(m.trip_line().alias("line"))
