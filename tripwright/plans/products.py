"""Score tables made from trip statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.schemas import SCORE_SPEC


def normed(value: Column, low: float, high: float) -> Column:
    """Position of a value between two bounds, 0 to 1."""
    share = (value - F.lit(float(low))) / F.lit(float(high - low))
    return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))


def trip_norms(
    stats: DataFrame, spec: Mapping[str, tuple[float, float, float]] = SCORE_SPEC
) -> DataFrame:
    """Driving measures of a trip, each with its share between the configured bounds.

    ``score`` is this package's own definition, as no formula is given with the bounds and
    weights: 100 for a trip with nothing to report, less the weighted mean of the event shares.
    """
    measures = {"accel": "accel", "deaccel": "deaccel", "overlimit": "overlimit", "dist": "distance"}
    normed_cols = {
        "norm_" + short: normed(F.col(source), spec[source][0], spec[source][1])
        for short, source in measures.items()
    }
    counted = [s for s in measures if s != "dist"]
    total = sum(spec[s][2] for s in counted)
    penalty = sum(F.col("norm_" + s) * F.lit(spec[s][2] / total) for s in counted)
    return (
        stats.withColumns(normed_cols)
        .withColumn("dist", F.col("distance"))
        .withColumn("score", F.lit(100.0) * (F.lit(1.0) - penalty))
        .select(
            "vehicle_id",
            "user_id",
            "trip_id",
            "dist",
            "accel",
            "deaccel",
            "overlimit",
            *["norm_" + s for s in ("dist", "accel", "deaccel", "overlimit")],
            "score",
        )
    )


def vehicle_scores(trip_scores: DataFrame, ts: Column) -> DataFrame:
    """Mean trip score and number of trips per vehicle and user; ``ts`` is the score time."""
    return trip_scores.groupBy("vehicle_id", "user_id").agg(
        F.count(F.lit(1)).alias("cnt"), F.max(ts).alias("ts"), F.avg("score").alias("score")
    )
