"""Building blocks of the oracle SQL: the fixture views and expected intermediate tables.

Everything here is written for an independent engine and reads the raw tables only. It never
goes through JSON: what a message should parse to is computed from the row it was made of.
"""

from __future__ import annotations

FX_POINTS = """
fx_raw AS (
  SELECT *, (epoch_us(ts) - epoch_us(timestamp '2024-01-01 00:00:00')) AS us FROM events),
fx_base AS (
  SELECT event_id, event_type, value, user_id AS vehicle_id, us,
         user_id * 2 + us // 1296000000000 AS trip_no, (us // 432000000000) % 2 AS mv,
         1528163784000 + us // 20000000 AS clt
  FROM fx_raw),
fx_points AS (
  SELECT event_id, event_id AS sample_id, event_type, value, vehicle_id, trip_no,
         lower(lpad(to_hex(trip_no), 8, '0')) || '-6863-11e8-96b3-bf7af28e956c' AS trip_id,
         'u' || (vehicle_id % 7) AS user_id, 's' || trip_no AS sensor_id,
         'c' || (vehicle_id % 5) AS company_id, clt, clt + 500 AS ts, clt AS time, mv,
         126.9::DOUBLE + mv * value * 0.000003::DOUBLE AS lon,
         37.5::DOUBLE + mv * (event_id % 97) * 0.000003::DOUBLE AS lat,
         CASE vehicle_id % 4 WHEN 0 THEN 'OBD' WHEN 1 THEN 'ADAS' WHEN 2 THEN 'GPS'
              ELSE 'BLACKBOX' END AS device_type,
         event_id % 128 AS em, 30 + event_id % 4 AS ldw, 30 + (event_id // 4) % 4 AS fcw,
         event_id % 120 AS sp
  FROM fx_base)"""

FX_TRIPS = """
fx_trips AS (
  SELECT trip_id, trip_no, vehicle_id, user_id, sensor_id, company_id, device_type,
         min(clt) AS start_ts, max(clt) AS end_ts, count(*) AS n
  FROM fx_points GROUP BY ALL)"""

FX_EVENTS = """
fx_events AS (
  SELECT event_id, trip_id, vehicle_id, user_id, sensor_id, company_id, device_type,
         clt AS event_ts, 'P' || (2500 + event_id % 5) AS dtcc, event_id % 20 AS wbv,
         (event_id // 7) % 6 AS shape,
         (126000 + event_id % 1000) / 1000.0::DOUBLE AS elon,
         (37000 + event_id % 1000) / 1000.0::DOUBLE AS elat
  FROM fx_points)"""

FX_ROADS = """
fx_roads AS (
  SELECT 'r' || s_suppkey AS road_id, s_suppkey % 4 + 1 AS rank,
         20000 + (s_suppkey % 5) * 10000 AS max_speed_mh,
         126.9::DOUBLE + ((s_suppkey - 1) % 10) * 0.00015::DOUBLE
           + ((s_suppkey - 1) // 30) * 0.01::DOUBLE AS min_lon,
         126.9::DOUBLE + ((s_suppkey - 1) % 10 + 1) * 0.00015::DOUBLE
           + ((s_suppkey - 1) // 30) * 0.01::DOUBLE AS max_lon,
         37.5::DOUBLE + (((s_suppkey - 1) // 10) % 3) * 0.0001::DOUBLE AS min_lat,
         37.5::DOUBLE + (((s_suppkey - 1) // 10) % 3 + 1) * 0.0001::DOUBLE AS max_lat
  FROM supplier)"""

# What the micro-trip payloads hold: forms 1 to 4 nothing, form 5 two samples.
SAMPLES = """
one_sample AS (
  SELECT event_id, trip_id, vehicle_id, device_type, 'm' || event_id AS micro_trip_id, 0 AS pos, ts,
         CASE WHEN event_id % 20 IN (6, 9) THEN NULL ELSE lon END AS lon,
         CASE WHEN event_id % 20 = 6 THEN NULL ELSE lat END AS lat,
         CASE WHEN event_id % 20 IN (6, 8) THEN NULL WHEN event_id % 20 = 10 THEN 0
              ELSE clt END AS clt,
         CASE WHEN event_id % 20 IN (6, 7) THEN NULL ELSE sp END AS sp,
         CASE WHEN event_id % 20 = 6 THEN NULL ELSE em END AS em,
         CASE WHEN event_id % 20 = 6 THEN NULL ELSE ldw END AS ldw,
         CASE WHEN event_id % 20 = 6 THEN NULL ELSE fcw END AS fcw
  FROM fx_points WHERE event_id % 20 NOT IN (1, 2, 3, 4)),
all_samples AS (
  SELECT * FROM one_sample
  UNION ALL
  SELECT event_id, trip_id, vehicle_id, device_type, 'm' || event_id, 1, ts,
         lon + 0.000003::DOUBLE, lat, clt + 1000, NULL, em, ldw, fcw
  FROM fx_points WHERE event_id % 20 = 5),
samples AS (
  SELECT *, CASE WHEN lon IS NOT NULL AND lat IS NOT NULL AND coalesce(clt, ts) > 0
                 THEN coalesce(clt, ts) END AS time
  FROM all_samples)"""

# What the event payloads hold, one row per JSON object, and a text that stands for the payload.
ELEMENTS = """
payloads AS (
  SELECT *, CASE shape
    WHEN 0 THEN '{"dtcc":"' || dtcc || '","wbv":' || wbv || ',"ldw":31}'
    WHEN 1 THEN '[{"dtcc":"' || dtcc || '","fcw":31},{"dtcc":"P2600","wid":3}]'
    WHEN 2 THEN '[1,{"dclon":' || elon || ',"dclat":' || elat || '},"s"]'
    WHEN 3 THEN 'bad text'
    WHEN 4 THEN ''
    ELSE '{"dtcc":7,"plon":' || elon || ',"plat":' || elat || ',"fcw":32}' END AS payload
  FROM fx_events)"""


def elements(key: str, source: str = "payloads") -> str:
    return f"""
distinct_payloads AS (
  SELECT DISTINCT {key}, payload, shape, CASE WHEN shape IN (0, 1) THEN dtcc END AS code,
         CASE WHEN shape = 0 THEN wbv END AS wbv,
         CASE WHEN shape IN (2, 5) THEN elon END AS elon,
         CASE WHEN shape IN (2, 5) THEN elat END AS elat
  FROM {source}),
elements AS (
  SELECT {key}, CASE WHEN shape = 0 THEN 31 ELSE 0 END AS ldw,
         CASE shape WHEN 1 THEN 31 WHEN 5 THEN 32 ELSE 0 END AS fcw,
         coalesce(code, '') AS dtcc,
         CASE WHEN shape = 2 THEN '{{lon:' || elon || ',lat:' || elat || '}}' ELSE '' END AS cwdrv,
         CASE WHEN shape = 5 THEN '{{lon:' || elon || ',lat:' || elat || '}}' ELSE '' END AS cwprk,
         CASE WHEN shape = 0 THEN wbv::VARCHAR ELSE '' END AS bw, '' AS bbxwn
  FROM distinct_payloads WHERE shape IN (0, 1, 2, 5)
  UNION ALL
  SELECT {key}, 0, 0, 'P2600', '', '', '', '3' FROM distinct_payloads WHERE shape = 1)"""


LATEST_DEVICES = """
own_devices AS (
  SELECT trip_id, CASE
    WHEN device_type = 'OBD' THEN 'OBD' WHEN device_type = 'ADAS' THEN 'ADAS'
    WHEN device_type = 'GPS' AND trip_no % 2 = 1 THEN 'ADAS'
    WHEN device_type = 'GPS' THEN 'GPS'
    WHEN trip_no % 2 = 1 THEN NULL ELSE 'BLACKBOX' END AS base_device_type
  FROM fx_trips)"""


def step_km(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    h = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * "
        f"cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(6371 * (2 * atan2(sqrt({h}), sqrt(1 - {h}))))"


def moves(source: str, key: str = "trip_id", tie: str = "sample_id", w: int = 5) -> str:
    """CTEs ``steps`` and ``moves`` over the rows of ``source`` that have a time."""
    order = f"PARTITION BY {key} ORDER BY time, {tie}"
    return f"""
usable AS (
  SELECT *, count(*) OVER (PARTITION BY {key}) AS n_points,
         row_number() OVER ({order}) - 1 AS place
  FROM {source} WHERE time IS NOT NULL),
steps AS (
  SELECT *, coalesce({step_km('lag(lon) OVER win', 'lag(lat) OVER win', 'lon', 'lat')} * 1000.0, 0.0)
           AS step_m,
         lag(time) OVER win AS prev_time
  FROM usable WINDOW win AS ({order})),
spans AS (
  SELECT *, trunc(sum(step_m) OVER (win ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW))::BIGINT
           AS distance_m,
         coalesce(lag(time, {w}) OVER win, first_value(time) OVER win) AS head_time,
         coalesce(lag(lon, {w}) OVER win, first_value(lon) OVER win) AS head_lon,
         coalesce(lag(lat, {w}) OVER win, first_value(lat) OVER win) AS head_lat
  FROM steps WINDOW win AS ({order})),
speeds AS (
  SELECT *, time - head_time AS elapsed_ms,
         CASE WHEN time - head_time < 900 THEN 0
              ELSE distance_m * 3600000 // (time - head_time) END AS speed_mh
  FROM spans WHERE place >= 1 AND n_points >= 3),
moves AS (
  SELECT *, CASE WHEN abs(head_time - lag(head_time) OVER win) >= 900
                 THEN lag(speed_mh) OVER win END AS prev_speed_mh
  FROM speeds WINDOW win AS ({order}))"""


TAXI = """CASE
  WHEN speed_mh - prev_speed_mh >= 8000 AND prev_speed_mh <= 5000 THEN 'start'
  WHEN speed_mh - prev_speed_mh >= 8000 THEN 'accel'
  WHEN speed_mh - prev_speed_mh <= -14000 AND speed_mh <= 5000 THEN 'stop'
  WHEN speed_mh - prev_speed_mh <= -14000 THEN 'deaccel' END"""

CODE = "CASE event WHEN 'start' THEN 1 WHEN 'accel' THEN 2 WHEN 'deaccel' THEN 3 WHEN 'stop' THEN 4 END"

MASK = ("start", "lturn", "rturn", "uturn", "deaccel", "accel", "stop")


def counters() -> str:
    bits = [
        f"sum(CASE WHEN coalesce(em, 0) > 0 THEN (em >> {i}) & 1 ELSE 0 END)::BIGINT AS {n}"
        for i, n in enumerate(MASK)
    ]
    codes = [
        f"(count(*) FILTER ({col} = {code})) AS {n}"
        for n, col, code in (
            ("lldw", "ldw", 31),
            ("rldw", "ldw", 32),
            ("fcw1", "fcw", 31),
            ("fcw2", "fcw", 32),
        )
    ]
    return ", ".join(bits + codes)


def merged_texts(key: str) -> str:
    """CTE ``event_stat``: counters and merged texts per key over ``elements``."""
    texts = ", ".join(
        f"coalesce(string_agg(DISTINCT {t}, ',' ORDER BY {t}) FILTER ({t} <> ''), '') AS {t}"
        for t in ("dtcc", "cwdrv", "cwprk", "bw", "bbxwn")
    )
    return f"""
event_stat AS (
  SELECT {key}, count(*) FILTER (ldw = 31) AS lldw, count(*) FILTER (ldw = 32) AS rldw,
         count(*) FILTER (fcw = 31) AS fcw1, count(*) FILTER (fcw = 32) AS fcw2, {texts}
  FROM elements GROUP BY {key})"""


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body
