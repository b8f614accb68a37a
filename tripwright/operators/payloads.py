"""Second-level JSON: the payload texts inside messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions.text import lon_lat_text
from tripwright.schemas import EVENT_PAYLOAD, SAMPLE_PAYLOAD, TRIP_PAYLOAD


def parse_trip_payload(payload: Column) -> Column:
    """Trip payload struct; the end position is read under both of its names."""
    p = F.from_json(payload, TRIP_PAYLOAD)
    return F.when(
        p.isNotNull(),
        F.struct(
            p.tid.alias("tid"),
            p.dis.alias("dis"),
            p.stlat.alias("stlat"),
            p.stlon.alias("stlon"),
            F.coalesce(p.endlat, p.edlat).alias("endlat"),
            F.coalesce(p.endlon, p.edlon).alias("endlon"),
        ),
    )


def parse_samples(payload: Column) -> Column:
    """Array of samples; one JSON object counts as one sample, unreadable text is NULL."""
    return F.from_json(payload, SAMPLE_PAYLOAD)


def explode_samples(microtrips: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per sample of a micro-trip, ``pos`` being its place in the payload.

    A micro-trip without readable payload has no rows.
    """
    kept = [c for c in microtrips.columns if c != payload]
    return (
        microtrips.select(*kept, F.posexplode(parse_samples(F.col(payload))).alias("pos", "sample"))
        .where(F.col("sample").isNotNull())
        .select(*kept, "pos", "sample.*")
    )


def event_elements(events: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per JSON object of an event payload, with counters' codes and texts.

    A payload may be an object or an array; array elements that are no objects are left out.
    Empty, unreadable and other payloads have no rows.
    """
    kept = [c for c in events.columns if c != payload]
    variant = F.try_parse_json(F.col(payload))
    shape = F.schema_of_variant(F.col("_v"))
    elements = F.when(shape.startswith("OBJECT"), F.array("_v")).when(
        shape.startswith("ARRAY"),
        F.filter(
            F.col("_v").try_cast("array<variant>"),
            lambda x: F.schema_of_variant(x).startswith("OBJECT"),
        ),
    )
    e = "_e."
    is_text = F.schema_of_variant(F.col(e + "dtcc")) == "STRING"
    return (
        events.withColumn("_v", variant)
        .select(*kept, F.explode(elements).alias("_o"))
        .select(*kept, F.from_json(F.to_json("_o"), EVENT_PAYLOAD).alias("_e"))
        .select(
            *kept,
            F.coalesce(F.col(e + "ldw"), F.lit(0)).alias("ldw"),
            F.coalesce(F.col(e + "fcw"), F.lit(0)).alias("fcw"),
            F.coalesce(
                F.when(is_text, F.try_variant_get(F.col(e + "dtcc"), "$", "string")), F.lit("")
            ).alias("dtcc"),
            F.coalesce(lon_lat_text(F.col(e + "dclon"), F.col(e + "dclat")), F.lit("")).alias(
                "cwdrv"
            ),
            F.coalesce(lon_lat_text(F.col(e + "plon"), F.col(e + "plat")), F.lit("")).alias("cwprk"),
            F.coalesce(F.col(e + "wbv").cast("string"), F.lit("")).alias("bw"),
            F.coalesce(F.col(e + "wid").cast("string"), F.lit("")).alias("bbxwn"),
        )
    )


def rejected(frame: DataFrame, payload: str = "payload") -> DataFrame:
    """Rows whose payload holds text that is no JSON."""
    text = F.col(payload)
    return frame.where(text.isNotNull() & F.try_parse_json(text).isNull())
