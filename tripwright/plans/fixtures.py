"""Vehicle data derived from the ``events`` and ``supplier`` tables.

Points, trips, device events, roads and the JSON messages that would have carried them. Every
view grows with the tables. Some messages are faulty on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwright.operators.messages import (
    flatten_events,
    flatten_microtrips,
    parse_events,
    parse_microtrips,
    parse_trips,
    trip_rows,
)
from tripwright.operators.points import sample_time
from tripwright.schemas import EVENT_KEY, MICROTRIP_KEY, TRIP_KEY
from tripwright.sources.tables import parquet_table

# The views are written as SQL text, which reads like the oracle's and is planned in few calls.


def points(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Position samples: one per row of ``events``, time squeezed to about 2 s per step.

    ``spread`` deals the rows to the shuffle partitions, which pays for work as heavy as writing
    and parsing JSON.
    """
    events = parquet_table(spark, sf_dir, "events")
    if spread:
        events = events.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")
    return (
        events.selectExpr(
            "event_id",
            "event_type",
            "value",
            "user_id AS vehicle_id",
            "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts) AS us",
        )
        .selectExpr(
            "*",
            "vehicle_id * 2 + us div 1296000000000 AS trip_no",
            "(us div 432000000000) % 2 AS mv",
            "1528163784000 + us div 20000000 AS clt",
        )
        .selectExpr(
            "event_id",
            "event_id AS sample_id",
            "event_type",
            "value",
            "vehicle_id",
            "trip_no",
            "concat(lower(lpad(hex(trip_no), 8, '0')), '-6863-11e8-96b3-bf7af28e956c') AS trip_id",
            "concat('u', vehicle_id % 7) AS user_id",
            "concat('s', trip_no) AS sensor_id",
            "concat('c', vehicle_id % 5) AS company_id",
            "clt",
            "clt + 500 AS ts",
            "mv",
            "126.9D + mv * value * 0.000003D AS lon",
            "37.5D + mv * (event_id % 97) * 0.000003D AS lat",
            "CASE vehicle_id % 4 WHEN 0 THEN 'OBD' WHEN 1 THEN 'ADAS' WHEN 2 THEN 'GPS'"
            " ELSE 'BLACKBOX' END AS device_type",
            "cast(event_id % 128 AS int) AS em",
            "cast(30 + event_id % 4 AS int) AS ldw",
            "cast(30 + (event_id div 4) % 4 AS int) AS fcw",
            "cast(event_id % 120 AS int) AS sp",
        )
    )


def timed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points(spark, sf_dir).withColumn("time", sample_time())


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips: half a month of a vehicle's points each."""
    return spark.sql(
        """
        SELECT trip_id, trip_no, vehicle_id, user_id, sensor_id, company_id, device_type,
               min(clt) AS start_ts, max(clt) AS end_ts, count(*) AS n
        FROM {points}
        GROUP BY trip_id, trip_no, vehicle_id, user_id, sensor_id, company_id, device_type
        """,
        points=points(spark, sf_dir),
    )


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row as a device event as well."""
    return (
        points(spark, sf_dir)
        .selectExpr(
            "event_id",
            "trip_id",
            "vehicle_id",
            "user_id",
            "sensor_id",
            "company_id",
            "device_type",
            "clt AS event_ts",
            "concat('P', 2500 + event_id % 5) AS dtcc",
            "event_id % 20 AS wbv",
            "(event_id div 7) % 6 AS shape",
            "(126000 + event_id % 1000) / 1000.0D AS elon",
            "(37000 + event_id % 1000) / 1000.0D AS elat",
        )
    )


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One road box per supplier; the first thirty tile the area where vehicles move."""
    return (
        parquet_table(spark, sf_dir, "supplier")
        .selectExpr("s_suppkey", "s_name", "s_suppkey - 1 AS k")
        .selectExpr("*", "k % 10 AS slot", "(k div 10) % 3 AS band", "k div 30 AS away")
        .selectExpr(
            "concat('r', s_suppkey) AS road_id",
            "s_name AS name",
            "s_suppkey % 4 + 1 AS rank",
            "20000 + (s_suppkey % 5) * 10000 AS max_speed_mh",
            "126.9D + slot * 0.00015D + away * 0.01D AS min_lon",
            "126.9D + (slot + 1) * 0.00015D + away * 0.01D AS max_lon",
            "37.5D + band * 0.0001D AS min_lat",
            "37.5D + (band + 1) * 0.0001D AS max_lat",
        )
    )


def _sent(rows: DataFrame, key: str, message: str) -> DataFrame:
    # Emitted by a generator, as a filter on a parsed field would otherwise be pushed below the
    # projections that write the JSON, and repeat all of them.
    return rows.selectExpr(
        f"explode(array(named_struct('key', '{key}', 'value', to_json({message})))) AS _m"
    ).select("_m.key", "_m.value")


def microtrip_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One micro-trip message per point; ``event_id % 20`` selects the form of its payload."""
    return _sent(
        points(spark, sf_dir, spread=True),
        MICROTRIP_KEY,
        """
        named_struct(
          'data', named_struct(
            'microTripId', concat('m', event_id),
            'tripId', trip_id,
            'sensorId', sensor_id,
            'vehicleId', concat('v', vehicle_id),
            'date', concat('2018-06-', event_id % 20 + 10),
            'ts', ts,
            'payload', CASE event_id % 20
              WHEN 0 THEN to_json(struct(lon, lat, clt, sp, em, ldw, fcw))
              WHEN 1 THEN ''
              WHEN 2 THEN 'not json'
              WHEN 3 THEN '[1,2]'
              WHEN 4 THEN NULL
              WHEN 5 THEN concat(
                '[', to_json(struct(lon, lat, clt, sp, em, ldw, fcw)), ',',
                to_json(struct(lon + 0.000003D AS lon, lat, clt + 1000 AS clt, em, ldw, fcw)), ']')
              WHEN 6 THEN '{"tid":1,"try":2,"vlt":12.3}'
              WHEN 7 THEN concat(
                '[', to_json(struct(lon, lat, clt, sp + 0.5D AS sp, em, ldw, fcw)), ']')
              WHEN 8 THEN concat('[', to_json(struct(lon, lat, sp, em, ldw, fcw)), ']')
              WHEN 9 THEN concat('[', to_json(struct(lat, clt, sp, em, ldw, fcw)), ']')
              WHEN 10 THEN concat('[', to_json(struct(lon, lat, 0 AS clt, sp, em, ldw, fcw)), ']')
              ELSE concat('[', to_json(struct(lon, lat, clt, sp, em, ldw, fcw)), ']')
              END,
            'deviceType', device_type,
            'createdTime', clt + 1000,
            'companyId', company_id,
            'extra', 'unknown'),
          'msgType', 'microtrip')
        """,
    )


def trip_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per trip; ``trip_no % 5`` selects the form of its payload."""
    return _sent(
        trips(spark, sf_dir),
        TRIP_KEY,
        """
        named_struct(
          'data', named_struct(
            'tripId', trip_id,
            'vehicleId', concat('v', vehicle_id),
            'userId', user_id,
            'sensorId', sensor_id,
            'companyId', company_id,
            'startTs', start_ts,
            'startDt', concat('dt', start_ts),
            'endTs', end_ts,
            'endDt', concat('dt', end_ts),
            'deviceType', device_type,
            'createdTime', start_ts + 3376,
            'payload', CASE trip_no % 5
              WHEN 0 THEN to_json(named_struct('tid', trip_no % 1000, 'dis', n * 10,
                'stlat', 37.5D, 'stlon', 126.9D, 'edlat', 37.25D, 'edlon', 126.75D))
              WHEN 1 THEN to_json(named_struct('tid', trip_no % 1000, 'dis', n * 10,
                'stlat', 37.5D, 'stlon', 126.9D, 'endlat', 37.125D, 'endlon', 126.5D))
              WHEN 2 THEN ''
              WHEN 3 THEN NULL
              ELSE to_json(named_struct('tid', trip_no % 1000, 'dis', n * 10)) END,
            'updated', n),
          'latestTrip', CASE
            WHEN device_type = 'OBD' THEN array(
              named_struct('deviceType', 'BLACKBOX', 'id', sensor_id),
              named_struct('deviceType', 'OBD', 'id', sensor_id))
            WHEN device_type = 'ADAS' THEN array(
              named_struct('deviceType', 'ADAS', 'id', cast(NULL AS string)))
            WHEN device_type = 'GPS' AND trip_no % 2 = 1 THEN array(
              named_struct('deviceType', 'GPS', 'id', sensor_id),
              named_struct('deviceType', 'ADAS', 'id', sensor_id))
            WHEN device_type = 'GPS' THEN array(
              named_struct('deviceType', 'BLACKBOX', 'id', cast(NULL AS string)),
              named_struct('deviceType', 'GPS', 'id', sensor_id))
            WHEN trip_no % 2 = 1 THEN array(
              named_struct('deviceType', 'OTHER', 'id', sensor_id))
            ELSE array(named_struct('deviceType', 'BLACKBOX', 'id', 'null')) END,
          'msgType', 'trip')
        """,
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per device event; ``shape`` selects the form of its payload."""
    return _sent(
        device_events(spark, sf_dir),
        EVENT_KEY,
        """
        named_struct(
          'data', named_struct(
            'deviceType', device_type,
            'eventId', concat('e', event_id),
            'companyId', company_id,
            'ty', 108,
            'payload', CASE shape
              WHEN 0 THEN to_json(named_struct('dtcc', dtcc, 'wbv', wbv, 'ldw', 31))
              WHEN 1 THEN concat('[', to_json(named_struct('dtcc', dtcc, 'fcw', 31)), ',',
                to_json(named_struct('dtcc', 'P2600', 'wid', 3)), ']')
              WHEN 2 THEN concat('[1,', to_json(named_struct('dclon', elon, 'dclat', elat)), ',"s"]')
              WHEN 3 THEN 'bad text'
              WHEN 4 THEN ''
              ELSE to_json(named_struct('dtcc', 7, 'plon', elon, 'plat', elat, 'fcw', 32)) END,
            'createdTime', event_ts + 1000,
            'tripId', trip_id,
            'vehicleId', concat('v', vehicle_id),
            'eventDt', concat('dt', event_ts),
            'eventTs', event_ts,
            'userId', user_id,
            'sensorId', sensor_id),
          'msgType', 'event')
        """,
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages of the ingest topic."""
    return (
        microtrip_messages(spark, sf_dir)
        .unionByName(trip_messages(spark, sf_dir))
        .unionByName(event_messages(spark, sf_dir))
    )


def stored_microtrips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_microtrips(parse_microtrips(microtrip_messages(spark, sf_dir)))


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_events(parse_events(event_messages(spark, sf_dir)))


def scored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_rows(parse_trips(trip_messages(spark, sf_dir)))
