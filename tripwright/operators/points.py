"""Cleaning of position samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_time(clt: str = "clt", ts: str = "ts", track: str = "trip_id") -> Column:
    """Time of a usable position sample, else NULL.

    The device clock counts; the stored time stands in for it. A sample without stored time,
    position or id, or with a time that is not positive, is not usable.
    """
    time = F.coalesce(F.col(clt), F.col(ts))
    usable = (
        F.col(ts).isNotNull()
        & F.col("lon").isNotNull()
        & F.col("lat").isNotNull()
        & F.col(track).isNotNull()
        & (time > 0)
    )
    return F.when(usable, time)


def clean_points(samples: DataFrame, track: str = "trip_id") -> DataFrame:
    """Usable samples with their ``time`` column."""
    return samples.withColumn("time", sample_time(track=track)).where(F.col("time").isNotNull())
