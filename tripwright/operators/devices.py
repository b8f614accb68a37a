"""Vehicles with several devices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.schemas import DEVICE_PRIORITY


def base_device(latest_trip: Column) -> Column:
    """The device with the highest priority among the latest trips, NULL if there is none.

    Only the device types count, so a missing id does no harm.
    """

    def present(device: str) -> Column:
        return F.exists(latest_trip, lambda x: F.coalesce(x.deviceType == device, F.lit(False)))

    return F.coalesce(*[F.when(present(d), F.lit(d)) for d in DEVICE_PRIORITY])


def base_device_trips(trips: DataFrame) -> DataFrame:
    """Trips of the representative device of their vehicle."""
    return trips.withColumn("base_device_type", base_device(F.col("latest_trip"))).where(
        F.col("base_device_type") == F.col("device_type")
    )
