"""Counters, merged texts and the statistics row of a trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.functions.codes import assist_flags, sample_flags
from tripwright.functions.ids import uuid_date
from tripwright.functions.text import merge_distinct, merge_unless_contained
from tripwright.operators.payloads import event_elements
from tripwright.schemas import COLLISION_CODES, COUNTERS, LANE_CODES, TEXTS

ASSIST = (*LANE_CODES, *COLLISION_CODES)


def counter_sums() -> list[Column]:
    """Aggregates: sum of every counter over samples with ``em``, ``ldw`` and ``fcw``."""
    return [F.expr(f"sum({flag}) AS {name}") for name, flag in sample_flags().items()]


def sample_counters(samples: DataFrame, key: str = "trip_id") -> DataFrame:
    return samples.groupBy(key).agg(F.count(F.lit(1)).alias("mtrip_cnt"), *counter_sums())


def distinct_payloads(events: DataFrame, key: str = "trip_id") -> DataFrame:
    """The different event payload texts per trip."""
    return events.where(F.col("payload").isNotNull()).select(key, "payload").distinct()


def event_counters(events: DataFrame, key: str = "trip_id") -> DataFrame:
    """Lane and collision counters over the different event payloads of a trip."""
    elements = event_elements(distinct_payloads(events, key))
    return elements.groupBy(key).agg(
        *[F.expr(f"sum({flag}) AS {name}") for name, flag in assist_flags().items()]
    )


def event_texts(events: DataFrame, key: str = "trip_id") -> DataFrame:
    """The different non-empty texts per trip, one row each: ``(key, field, text)``."""
    elements = event_elements(distinct_payloads(events, key))
    named = F.explode(
        F.array(*[F.struct(F.lit(t).alias("field"), F.col(t).alias("text")) for t in TEXTS])
    )
    return (
        elements.select(key, named.alias("_t"))
        .select(key, "_t.field", "_t.text")
        .where(F.col("text") != "")
        .distinct()
    )


def merge_texts(
    texts: DataFrame, key: str = "trip_id", by_substring: bool = False
) -> DataFrame:
    """One merged text per field and trip, from the rows of ``event_texts``.

    Texts are merged in sorted order. By default a text is left out if it is equal to an earlier
    one, with ``by_substring`` also if it occurs inside the text merged so far. Rows are distinct
    before they are collected, so an array holds no more than the result cell needs.
    """
    merge = merge_unless_contained if by_substring else merge_distinct
    return texts.groupBy(key).agg(
        *[
            merge(F.collect_list(F.when(F.col("field") == t, F.col("text")))).alias(t)
            for t in TEXTS
        ]
    )


def event_stats(
    events: DataFrame, key: str = "trip_id", by_substring: bool = False
) -> DataFrame:
    """Counters and merged texts of a trip's events in one pass over the payloads."""
    elements = event_elements(distinct_payloads(events, key))
    # First combine equal text tuples, so repeated faults do not reach the arrays.
    combined = elements.groupBy(key, *TEXTS).agg(
        *[F.expr(f"sum({flag}) AS {name}") for name, flag in assist_flags().items()]
    )
    merge = merge_unless_contained if by_substring else merge_distinct
    return combined.groupBy(key).agg(
        *[F.sum(n).alias(n) for n in ASSIST],
        *[merge(F.collect_set(F.when(F.col(t) != "", F.col(t)))).alias(t) for t in TEXTS],
    )


def stat_rows(
    facts: DataFrame,
    from_events: DataFrame,
    key: str = "trip_id",
    trip_id: str = "trip_id",
    zone: str = "UTC",
    over_limits: DataFrame | None = None,
) -> DataFrame:
    """Statistics per trip (or vehicle): sample facts plus what the events add.

    ``facts`` holds the sample counters, ``distance`` and the ids. All inputs have one row per
    key, so the joins are one to one. ``over_limits(key, overlimit)`` fills that counter.
    """
    e = from_events.select(key, *[F.col(n).alias("_e_" + n) for n in (*ASSIST, *TEXTS)])
    joined = facts.join(e, key, "left")
    if over_limits is not None:
        joined = joined.join(over_limits.select(key, "overlimit"), key, "left")
    else:
        joined = joined.withColumn("overlimit", F.lit(0))

    def counter(name: str) -> str:
        extra = f" + coalesce(_e_{name}, 0)" if name in ASSIST else ""
        return f"cast(coalesce({name}, 0){extra} AS bigint)"

    return joined.withColumns(
        {
            **{n: F.expr(counter(n)) for n in COUNTERS},
            **{t: F.expr(f"coalesce(_e_{t}, '')") for t in TEXTS},
            "date": uuid_date(F.col(trip_id), zone).cast("string"),
        }
    ).drop(*["_e_" + n for n in (*ASSIST, *TEXTS)])


def weighted(counters: DataFrame, fanout: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """Counters as the literal event fan-out would give them: each sample once per event."""
    n = F.greatest(F.coalesce(F.col("n_events"), F.lit(0)), F.lit(1))
    return (
        counters.join(fanout.select(key, "n_events"), key, "left")
        .withColumns({name: F.col(name) * n for name in names})
        .drop("n_events")
    )
