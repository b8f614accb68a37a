"""Time-based UUIDs and deterministic row ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 100-ns intervals between 1582-10-15, where version-1 UUID time starts, and 1970-01-01.
UUID_EPOCH_TICKS = 122192928000000000
# Unix milliseconds of the first and last instant of the years 1 to 9999.
CALENDAR_MS = (-62135596800000, 253402300799999)


def uuid_ticks(uuid: Column) -> Column:
    """60-bit time of a version-1 UUID text; NULL for other versions and malformed text."""
    well_formed = uuid.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-1[0-9a-fA-F]{3}-")
    digits = F.concat(uuid.substr(16, 3), uuid.substr(10, 4), uuid.substr(1, 8))
    return F.when(well_formed, F.conv(digits, 16, 10).cast("bigint"))


def uuid_millis(uuid: Column) -> Column:
    """Unix time in milliseconds of a version-1 UUID text."""
    return F.call_function("div", uuid_ticks(uuid) - F.lit(UUID_EPOCH_TICKS), F.lit(10000))


def millis_date(millis: Column, zone: str = "UTC") -> Column:
    """Calendar date of a Unix time in a given zone, whatever the session zone is.

    NULL for a time outside the calendar, which a faulty device may send.
    """
    known = F.when(millis.between(*CALENDAR_MS), millis)
    instant = F.timestamp_add(
        "MILLISECOND", known, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), instant).cast("date")


def uuid_date(uuid: Column, zone: str = "UTC") -> Column:
    """Calendar date on which a version-1 UUID was made."""
    return millis_date(uuid_millis(uuid), zone)


def latest_uuid(uuid: Column) -> Column:
    """Aggregate: the UUID with the latest embedded time."""
    return F.max_by(uuid, F.struct(uuid_ticks(uuid), uuid))


def row_id(*parts: Column) -> Column:
    """The same input row always gets the same id, so a repeated run overwrites its own rows."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
