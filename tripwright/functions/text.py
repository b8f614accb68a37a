"""Small text and JSON column functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lon_lat_text(lon: Column, lat: Column) -> Column:
    """``{lon:..,lat:..}``, or NULL if either coordinate is missing."""
    return F.concat(
        F.lit("{lon:"), lon.cast("string"), F.lit(",lat:"), lat.cast("string"), F.lit("}")
    )


def counters_json(names: Sequence[str]) -> Column:
    """JSON object of the positive counters."""
    return F.to_json(F.struct(*[F.when(F.col(n) > 0, F.col(n)).alias(n) for n in names]))


def texts_json(names: Sequence[str]) -> Column:
    """JSON object of the non-empty texts."""
    return F.to_json(F.struct(*[F.when(F.col(n) != "", F.col(n)).alias(n) for n in names]))


def over_limit_info(road_id: Column, max_speed_mh: Column, rank: Column) -> Column:
    return F.concat(
        F.lit('{"id":"'),
        road_id.cast("string"),
        F.lit('","maxSpd":'),
        max_speed_mh.cast("string"),
        F.lit(',"rank":'),
        rank.cast("string"),
        F.lit("}"),
    )


def rule_values(text: Column) -> Column:
    """``"-,8,-"`` in km/h to ``[-1, 8000, -1]`` in m/h; -1 means no bound."""
    return F.transform(
        F.split(text, ","),
        lambda x: F.when(x == "-", F.lit(-1)).otherwise((x.try_cast("double") * 1000).cast("int")),
    )


def merge_distinct(texts: Column) -> Column:
    """Join an array of texts, each once and in order, leaving out empty ones."""
    return F.array_join(F.array_sort(F.filter(F.array_distinct(texts), lambda t: t != "")), ",")


def merge_unless_contained(texts: Column) -> Column:
    """Join texts in order, leaving out one that already occurs inside the merged text."""
    return F.aggregate(
        F.array_sort(texts),
        F.lit(""),
        lambda merged, t: F.when(merged == "", t)
        .when((t == "") | merged.contains(t), merged)
        .otherwise(F.concat(merged, F.lit(","), t)),
    )
