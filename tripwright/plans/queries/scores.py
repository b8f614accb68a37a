"""Queries for the score results and the tables made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.functions import text
from tripwright.operators.stats import event_stats, sample_counters
from tripwright.plans import fixtures as fx
from tripwright.plans import products, score
from tripwright.plans.oracle import (
    CODE,
    ELEMENTS,
    FX_EVENTS,
    FX_POINTS,
    FX_ROADS,
    FX_TRIPS,
    LATEST_DEVICES,
    SAMPLES,
    TAXI,
    counters,
    elements,
    merged_texts,
    moves,
    sql,
)
from tripwright.plans.queries.joined import STAT_CTES, STAT_SUMS, STAT_TEXTS
from tripwright.plans.queries.registry import query
from tripwright.schemas import COUNTERS, TEXTS

DIS = "CASE WHEN t.trip_no % 5 IN (0, 1, 4) THEN t.n * 10 END"


def _driven(key: str) -> str:
    names = ("start", "accel", "deaccel", "stop")
    counts = ", ".join(f"count(*) FILTER (event = '{n}') AS n_{n}" for n in names)
    return f"""
driven AS (SELECT {key}, {counts} FROM (SELECT *, {TAXI} AS event FROM moves) GROUP BY {key})"""


N_EVENTS = ", ".join(
    f"CASE WHEN t.device_type IN ('GPS', 'BLACKBOX') THEN coalesce(d.n_{n}, 0) ELSE 0 END AS n_{n}"
    for n in ("start", "accel", "deaccel", "stop")
)


def _result_sql(key: str, joins: str) -> str:
    return f"""SELECT t.trip_id, f.mtrip_cnt, 'v' || t.vehicle_id AS vehicle_id, t.user_id,
    t.company_id, t.sensor_id, t.device_type, {DIS} AS trip_dist,
    coalesce(l.metres, 0) AS device_dist, '2018-06-05' AS date, {STAT_SUMS},
    coalesce(l.metres, 0) AS distance, {STAT_TEXTS}, {N_EVENTS}
    {joins}
    LEFT JOIN lengths l ON l.{key} = f.{key}
    LEFT JOIN event_stat s ON s.{key} = f.{key}
    LEFT JOIN driven d ON d.{key} = f.{key}"""


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        fx.scored_trips(spark, sf_dir),
        fx.stored_microtrips(spark, sf_dir),
        fx.stored_events(spark, sf_dir),
    )


def _wide(result: DataFrame) -> DataFrame:
    return result.withColumn("trip_dist", F.col("trip_dist").cast("bigint"))


@query(
    sql(
        _result_sql("trip_id", "FROM fx_trips t JOIN facts f ON f.trip_id = t.trip_id"),
        *STAT_CTES,
        _driven("trip_id"),
    )
)
def trip_score_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(score.trip_score(*_inputs(spark, sf_dir)))


@query(
    sql(
        """SELECT t.trip_id, f.mtrip_cnt, coalesce(o.overlimit, 0) AS overlimit
        FROM fx_trips t JOIN facts f ON f.trip_id = t.trip_id LEFT JOIN (
          SELECT m.trip_id, count(*) AS overlimit FROM moves m JOIN fx_roads ON lon >= min_lon
           AND lon < max_lon AND lat >= min_lat AND lat < max_lat AND speed_mh > max_speed_mh
          GROUP BY m.trip_id) o ON o.trip_id = t.trip_id""",
        *STAT_CTES,
        FX_ROADS,
    )
)
def trip_stat_with_roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trip result counts exceeded limits where roads are given."""
    result = score.trip_score(*_inputs(spark, sf_dir), roads=fx.roads(spark, sf_dir))
    return result.select("trip_id", "mtrip_cnt", "overlimit")


@query(
    sql(
        f"""SELECT t.trip_id, {DIS} AS trip_dist, coalesce(l.metres, 0) AS device_dist,
        coalesce(l.metres, 0) - {DIS} AS excess
        FROM fx_trips t JOIN facts f ON f.trip_id = t.trip_id
        LEFT JOIN lengths l ON l.trip_id = t.trip_id""",
        *STAT_CTES,
    )
)
def distance_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = trip_score_result(spark, sf_dir)
    return result.select(
        "trip_id",
        "trip_dist",
        "device_dist",
        (F.col("device_dist") - F.col("trip_dist")).alias("excess"),
    )


def _multi_ctes(key: str) -> tuple[str, ...]:
    tie = "trip_id, micro_trip_id, pos" if key == "vehicle_id" else "micro_trip_id, pos"
    return (
        FX_POINTS,
        FX_TRIPS,
        FX_EVENTS,
        SAMPLES,
        ELEMENTS,
        LATEST_DEVICES,
        """
own AS (
  SELECT t.* FROM fx_trips t JOIN own_devices o ON o.trip_id = t.trip_id
   AND o.base_device_type = t.device_type),
matched AS (
  SELECT t.trip_id, t.start_ts, s.* EXCLUDE (trip_id) FROM own t JOIN samples s
  ON s.vehicle_id = t.vehicle_id AND s.ts BETWEEN t.start_ts AND t.end_ts),
matched_events AS (
  SELECT t.trip_id, e.* EXCLUDE (trip_id) FROM own t JOIN payloads e
  ON e.vehicle_id = t.vehicle_id AND e.event_ts BETWEEN t.start_ts AND t.end_ts)""",
        elements(key, "matched_events"),
        merged_texts(key),
        moves("matched", key, tie),
        f"""
facts AS (
  SELECT {key}, count(*) AS mtrip_cnt, arg_min(trip_id, (start_ts, trip_id)) AS first_trip,
         {counters()} FROM matched GROUP BY {key}),
lengths AS (
  SELECT {key}, CASE WHEN count(*) < 3 THEN 0 ELSE sum(trunc(step_m)::BIGINT)::BIGINT END AS metres
  FROM steps GROUP BY {key})""",
        _driven(key),
    )


@query(
    sql(
        _result_sql("vehicle_id", "FROM facts f JOIN own t ON t.trip_id = f.first_trip"),
        *_multi_ctes("vehicle_id"),
    )
)
def multi_trip_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(score.multi_trip_score(*_inputs(spark, sf_dir)))


@query(
    sql(
        _result_sql("vehicle_id", "FROM facts f JOIN own t ON t.trip_id = f.first_trip"),
        *_multi_ctes("vehicle_id"),
    )
)
def multi_trip_result_by_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result per vehicle, put together from one mergeable state per trip."""
    return _wide(score.multi_trip_score_by_states(*_inputs(spark, sf_dir)))


@query(
    sql(
        _result_sql("trip_id", "FROM facts f JOIN own t ON t.trip_id = f.trip_id"),
        *_multi_ctes("trip_id"),
    )
)
def multi_trip_result_by_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(score.multi_trip_score(*_inputs(spark, sf_dir), by="trip_id"))


STAT_JSON_PAIRS = " || ".join(
    f"CASE WHEN {c} > 0 THEN '\"{c}\":' || {c} || ',' ELSE '' END" for c in COUNTERS[:11]
)


@query(
    sql(
        f"""SELECT trip_id, '{{' || rtrim({STAT_JSON_PAIRS}, ',') || '}}' AS json FROM facts""",
        *STAT_CTES,
    )
)
def stat_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = sample_counters(score.stored_samples(fx.stored_microtrips(spark, sf_dir)))
    return counted.select("trip_id", text.counters_json(COUNTERS[:11]).alias("json"))


TEXT_JSON_PAIRS = " || ".join(
    f"CASE WHEN {t} <> '' THEN '\"{t}\":\"' || {t} || '\",' ELSE '' END" for t in TEXTS
)


@query(
    sql(
        f"""SELECT trip_id, '{{' || rtrim({TEXT_JSON_PAIRS}, ',') || '}}' AS json
        FROM event_stat""",
        FX_POINTS,
        FX_EVENTS,
        ELEMENTS,
        elements("trip_id"),
        merged_texts("trip_id"),
    )
)
def text_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = event_stats(fx.stored_events(spark, sf_dir))
    return merged.select("trip_id", text.texts_json(TEXTS).alias("json"))


SCORE_EVENT_ROWS = f"""
score_rows AS (
  SELECT 'v' || t.vehicle_id AS vehicle_id, t.user_id, m.trip_id, lon AS pos_lon, lat AS pos_lat,
         time AS event_ts, ({CODE})::BIGINT AS event_type, speed_mh, '' AS info, t.device_type,
         0::BIGINT AS created_time,
         sha256(m.trip_id || '|' || time || '|' || event || '|' || micro_trip_id || '#' || pos) AS id,
         'check_event' AS source
  FROM (SELECT *, {TAXI} AS event FROM moves) m JOIN fx_trips t ON t.trip_id = m.trip_id
  WHERE event IS NOT NULL AND t.device_type IN ('GPS', 'BLACKBOX')
  UNION ALL
  SELECT 'v' || t.vehicle_id, t.user_id, m.trip_id, lon, lat, time, 5, speed_mh,
         '{{"id":"' || road_id || '","maxSpd":' || max_speed_mh || ',"rank":' || rank || '}}',
         t.device_type, 0,
         sha256(m.trip_id || '|' || time || '|overlimit|' || micro_trip_id || '#' || pos || '#' || road_id),
         'check_over_limit'
  FROM moves m JOIN fx_roads ON lon >= min_lon AND lon < max_lon AND lat >= min_lat
   AND lat < max_lat AND speed_mh > max_speed_mh JOIN fx_trips t ON t.trip_id = m.trip_id)"""


def _score_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, microtrips, _ = _inputs(spark, sf_dir)
    return score.score_events(
        trips,
        score.stored_samples(microtrips),
        fx.roads(spark, sf_dir),
        heavy=score.heavy_tracks(microtrips, "trip_id"),
    )


@query(
    sql(
        "SELECT * FROM score_rows",
        FX_POINTS,
        FX_TRIPS,
        FX_ROADS,
        SAMPLES,
        moves("samples", tie="micro_trip_id, pos"),
        SCORE_EVENT_ROWS,
    )
)
def score_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both kinds of events of the scored trips, from the messages, with all their columns."""
    rows = _score_event_rows(spark, sf_dir)
    return rows.withColumn("event_type", F.col("event_type").cast("bigint"))


@query(
    sql(
        f"""SELECT trip_id, count(*) FILTER (source = 'check_event') AS check_event,
        count(*) FILTER (source = 'check_over_limit') AS check_over_limit,
        coalesce(string_agg(id, ',' ORDER BY id) FILTER (source = 'check_event'), '') AS event_ids,
        coalesce(string_agg(id, ',' ORDER BY id) FILTER (source = 'check_over_limit'), '') AS limit_ids
        FROM score_rows GROUP BY trip_id""",
        FX_POINTS,
        FX_TRIPS,
        FX_ROADS,
        SAMPLES,
        moves("samples", tie="micro_trip_id, pos"),
        SCORE_EVENT_ROWS,
    )
)
def trip_event_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and ids of both event lists per trip, from the nested result."""

    def ids(column: str) -> Column:
        return F.array_join(F.array_sort(F.transform(column, lambda e: e["id"])), ",")

    return score.nested_events(_score_event_rows(spark, sf_dir)).select(
        "trip_id",
        F.size("check_event").cast("bigint").alias("check_event"),
        F.size("check_over_limit").cast("bigint").alias("check_over_limit"),
        ids("check_event").alias("event_ids"),
        ids("check_over_limit").alias("limit_ids"),
    )


def _norm(value: str, low: float, high: float) -> str:
    return f"least(greatest(({value} - {low}) / {high - low}::DOUBLE, 0), 1)"


NORMS = f"""
stats AS (
  SELECT t.vehicle_id, t.user_id, t.trip_id, t.end_ts, coalesce(l.metres, 0) AS dist,
         f.accel, f.deaccel, coalesce(o.overlimit, 0) AS overlimit
  FROM fx_trips t JOIN facts f ON f.trip_id = t.trip_id
  LEFT JOIN lengths l ON l.trip_id = t.trip_id
  LEFT JOIN (
    SELECT m.trip_id, count(*) AS overlimit FROM moves m JOIN fx_roads ON lon >= min_lon
     AND lon < max_lon AND lat >= min_lat AND lat < max_lat AND speed_mh > max_speed_mh
    GROUP BY m.trip_id) o ON o.trip_id = t.trip_id),
norms AS (
  SELECT *, {_norm('dist', 10000, 320000)} AS norm_dist, {_norm('accel', 0, 10)} AS norm_accel,
         {_norm('deaccel', 0, 10)} AS norm_deaccel, {_norm('overlimit', 0, 5)} AS norm_overlimit
  FROM stats),
scored AS (
  SELECT *, 100.0 * (1.0 - (norm_accel * 0.36 + norm_deaccel * 0.36 + norm_overlimit * 0.39) / 1.11)
    AS score FROM norms)"""

ROUNDED = ("norm_dist", "norm_accel", "norm_deaccel", "norm_overlimit", "score")


def _norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = score.trip_score(*_inputs(spark, sf_dir), roads=fx.roads(spark, sf_dir))
    return products.trip_norms(stats)


@query(
    sql(
        "SELECT 'v' || vehicle_id AS vehicle_id, user_id, trip_id, dist, accel, deaccel, overlimit, "
        + ", ".join(f"round({c}, 6) AS {c}" for c in ROUNDED)
        + " FROM scored",
        *STAT_CTES,
        FX_ROADS,
        NORMS,
    )
)
def trip_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _norms(spark, sf_dir).withColumns({c: F.round(c, 6) for c in ROUNDED})


VEHICLE_SCORES = """
SELECT 'v' || vehicle_id AS vehicle_id, user_id, count(*) AS cnt, max(end_ts) AS ts,
round(avg(score), 6) AS score FROM scored GROUP BY vehicle_id, user_id"""


@query(sql(VEHICLE_SCORES, *STAT_CTES, FX_ROADS, NORMS))
def vehicle_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = fx.trips(spark, sf_dir).select("trip_id", "end_ts")
    scores = products.vehicle_scores(_norms(spark, sf_dir).join(ends, "trip_id"), F.col("end_ts"))
    return scores.withColumn("score", F.round("score", 6))
