"""Keyed JSON messages: routing, parsing, flattening and writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions.ids import millis_date
from tripwright.schemas import (
    EVENT_KEY,
    EVENT_MESSAGE,
    MICROTRIP_KEY,
    MICROTRIP_MESSAGE,
    SCORE_KEY,
    TRIP_INDEX,
    TRIP_KEY,
    TRIP_MESSAGE,
)


def key_value(raw: DataFrame, timestamp: bool = False) -> DataFrame:
    """Broker rows with binary key and value as text."""
    names = ["timestamp"] if timestamp else []
    return raw.select(
        *names, F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def with_key(messages: DataFrame, key: str) -> DataFrame:
    return messages.where(F.col("key") == key)


def key_counts(messages: DataFrame) -> DataFrame:
    """Messages per key; a message without key forms a group of its own and counts 0."""
    return messages.groupBy("key").agg(F.count("key").alias("count"))


def message_kind(line: Column) -> Column:
    """Message key of a text line, from the kind written in it."""

    def says(kind: str) -> Column:
        return F.instr(line, f'"msgType":"{kind}"') > 1

    return (
        F.when(says("microtrip"), MICROTRIP_KEY)
        .when(says("trip"), TRIP_KEY)
        .when(says("event"), EVENT_KEY)
        .otherwise("none")
    )


def message_text(line: Column) -> Column:
    """The JSON part of a line that may start with ``topic |`` or ``topic,``."""
    return F.regexp_replace(line, r"^[^{]*", "")


def route_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Text lines as keyed messages; a line without message keeps its text under ``none``."""
    kind, line = message_kind(F.col(column)), F.col(column)
    return lines.select(
        kind.alias("key"),
        F.when(kind == "none", line).otherwise(message_text(line)).alias("value"),
    )


def _parsed(messages: DataFrame, key: str, schema: str) -> DataFrame:
    # Through a generator, as a later filter on a parsed field would otherwise be pushed below the
    # parse and repeat it.
    kept = [c for c in messages.columns if c not in ("key", "value")]
    return with_key(messages, key).select(*kept, F.inline(F.array(F.from_json("value", schema))))


def parse_microtrips(messages: DataFrame) -> DataFrame:
    return _parsed(messages, MICROTRIP_KEY, MICROTRIP_MESSAGE)


def parse_events(messages: DataFrame) -> DataFrame:
    return _parsed(messages, EVENT_KEY, EVENT_MESSAGE)


def parse_trips(messages: DataFrame, key: str = TRIP_KEY) -> DataFrame:
    return _parsed(messages, key, TRIP_MESSAGE)


def flatten_microtrips(parsed: DataFrame) -> DataFrame:
    """Stored layout of micro-trips, keyed by micro-trip id."""
    return parsed.select(
        F.col("data.microTripId").alias("key1"),
        F.col("data.microTripId").alias("micro_trip_id"),
        F.col("data.vehicleId").alias("vehicle_id"),
        F.col("data.tripId").alias("trip_id"),
        F.col("data.sensorId").alias("sensor_id"),
        F.col("data.createdTime").alias("created_time"),
        F.col("data.date").alias("date"),
        F.col("data.deviceType").alias("device_type"),
        F.col("data.payload").alias("payload"),
        F.col("data.ts").alias("ts"),
    )


def flatten_events(parsed: DataFrame) -> DataFrame:
    """Stored layout of device events, keyed by event id."""
    return parsed.select(
        F.col("data.eventId").alias("key1"),
        F.col("data.vehicleId").alias("vehicle_id"),
        F.col("data.tripId").alias("trip_id"),
        F.col("data.eventId").alias("event_id"),
        F.col("data.companyId").alias("company_id"),
        F.col("data.ty").alias("ty"),
        F.col("data.sensorId").alias("sensor_id"),
        F.col("data.createdTime").alias("created_time"),
        F.col("data.eventDt").alias("event_dt"),
        F.col("data.eventTs").alias("event_ts"),
        F.col("data.payload").alias("payload"),
        F.col("data.deviceType").alias("device_type"),
        F.col("data.userId").alias("user_id"),
    )


def flatten_trips(parsed: DataFrame, zone: str = "UTC") -> DataFrame:
    """Stored layout of trips, keyed by trip id; the date comes from the start time."""
    start = F.col("data.startTs")
    return parsed.select(
        F.col("data.tripId").alias("key1"),
        F.col("data.vehicleId").alias("vehicle_id"),
        F.col("data.tripId").alias("trip_id"),
        F.col("data.sensorId").alias("sensor_id"),
        F.col("data.createdTime").alias("created_time"),
        millis_date(start.try_cast("bigint"), zone).cast("string").alias("date"),
        F.col("data.deviceType").alias("device_type"),
        F.col("data.endDt").alias("end_dt"),
        F.col("data.endTs").alias("end_ts"),
        F.col("data.startDt").alias("start_dt"),
        start.alias("start_ts"),
        F.col("data.payload").alias("payload"),
        F.lit(TRIP_INDEX).alias("spark_idx"),
        F.col("data.updated").alias("updated"),
        F.col("data.userId").alias("user_id"),
    )


def fill_texts(frame: DataFrame) -> DataFrame:
    """Empty text instead of NULL in text columns; other columns stay as they are."""
    return frame.na.fill("")


def trip_rows(parsed: DataFrame) -> DataFrame:
    """Typed trips for scoring, from parsed trip messages."""
    kept = [c for c in parsed.columns if c not in ("data", "latestTrip", "msgType")]
    d = "data."
    return parsed.select(
        *kept,
        F.col(d + "tripId").alias("trip_id"),
        F.col(d + "vehicleId").alias("vehicle_id"),
        F.col(d + "userId").alias("user_id"),
        F.col(d + "sensorId").alias("sensor_id"),
        F.col(d + "companyId").alias("company_id"),
        F.col(d + "startTs").try_cast("bigint").alias("start_ts"),
        F.col(d + "startDt").alias("start_dt"),
        F.col(d + "endTs").try_cast("bigint").alias("end_ts"),
        F.col(d + "endDt").alias("end_dt"),
        F.col(d + "deviceType").alias("device_type"),
        F.col(d + "createdTime").alias("trip_created_time"),
        F.col(d + "payload").alias("trip_payload_str"),
        F.col(d + "updated").alias("updated"),
        F.col("latestTrip").alias("latest_trip"),
        F.col("msgType").alias("msg_type"),
    )


def to_score(messages: DataFrame) -> DataFrame:
    """Finished trips under the key of the score topic, value unchanged."""
    return with_key(messages, TRIP_KEY).select(F.lit(SCORE_KEY).alias("key"), "value")


def microtrip_line(topic: str = MICROTRIP_KEY) -> Column:
    """``topic,{json}`` of a stored micro-trip; absent fields are left out."""
    data = F.struct(
        F.col("micro_trip_id").alias("microTripId"),
        F.col("trip_id").alias("tripId"),
        F.col("sensor_id").alias("sensorId"),
        F.col("vehicle_id").alias("vehicleId"),
        F.col("date"),
        F.col("ts"),
        F.col("payload"),
        F.col("device_type").alias("deviceType"),
        F.col("created_time").try_cast("bigint").alias("createdTime"),
    )
    body = F.struct(
        data.alias("data"),
        F.col("company_id").alias("companyId"),
        F.col("sensor_id").alias("sensorId"),
        F.lit("microtrip").alias("msgType"),
    )
    return F.concat(F.lit(topic + ","), F.to_json(body))


def trip_line(topic: str = TRIP_KEY) -> Column:
    """``topic,{json}`` of a trip; its own device is the only latest trip, without id."""
    data = F.struct(
        F.col("trip_id").alias("tripId"),
        F.col("vehicle_id").alias("vehicleId"),
        F.col("user_id").alias("userId"),
        F.col("sensor_id").alias("sensorId"),
        F.col("company_id").alias("companyId"),
        F.col("start_ts").alias("startTs"),
        F.col("start_dt").alias("startDt"),
        F.col("end_ts").alias("endTs"),
        F.col("end_dt").alias("endDt"),
        F.col("device_type").alias("deviceType"),
        F.col("trip_created_time").try_cast("bigint").alias("createdTime"),
        F.col("trip_payload_str").alias("payload"),
        F.col("updated").try_cast("int").alias("updated"),
    )
    latest = F.array(
        F.struct(
            F.coalesce(F.col("device_type"), F.lit("")).alias("deviceType"),
            F.lit(None).cast("string").alias("id"),
        )
    )
    # Absent trip fields are left out, the empty device id is written.
    return F.concat(
        F.lit(topic + ',{"data":'),
        F.to_json(data),
        F.lit(',"latestTrip":'),
        F.to_json(latest, {"ignoreNullFields": "false"}),
        F.lit(","),
        F.substring(
            F.to_json(
                F.struct(
                    F.coalesce(F.col("company_id"), F.lit("")).alias("companyId"),
                    F.col("sensor_id").alias("sensorId"),
                    F.lit("trip").alias("msgType"),
                )
            ),
            2,
            2147483647,
        ),
    )
