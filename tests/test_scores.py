"""Score results do not depend on how heavy trips and vehicles are split."""

from pyspark.sql import functions as F

from tripwright.plans import fixtures as fx
from tripwright.plans import products, score


def inputs(spark, sf_dir):
    """Trips, micro-trips and events, computed once for all runs of a test."""
    frames = (fx.scored_trips, fx.stored_microtrips, fx.stored_events)
    return [make(spark, sf_dir).cache() for make in frames]


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_heavy_trips(spark, sf_dir):
    data = inputs(spark, sf_dir)
    assert rows_of(score.trip_score(*data, limit=600)) == rows_of(score.trip_score(*data))


def test_heavy_vehicles(spark, sf_dir):
    data = inputs(spark, sf_dir)
    for by in ("vehicle_id", "trip_id"):
        whole = rows_of(score.multi_trip_score(*data, by=by))
        assert whole and rows_of(score.multi_trip_score(*data, by=by, limit=900)) == whole


def test_nested_lists_in_pieces(spark, sf_dir):
    trips, microtrips, _ = inputs(spark, sf_dir)
    flat = score.score_events(trips, score.stored_samples(microtrips), fx.roads(spark, sf_dir))
    total = flat.groupBy("source").count().collect()
    nested = score.nested_events(flat, row_events=5)
    sizes = nested.select(
        F.size("check_event").alias("check_event"), F.size("check_over_limit").alias("check_over_limit")
    )
    sums = sizes.agg(*[F.sum(c).alias(c) for c in sizes.columns]).first()
    assert {r.source: r["count"] for r in total} == sums.asDict()
    assert sizes.agg(F.max(F.col("check_event") + F.col("check_over_limit"))).first()[0] < 25


def test_a_trip_sent_twice_counts_once(spark, sf_dir):
    trips, microtrips, events = inputs(spark, sf_dir)
    twice = trips.unionByName(trips.withColumn("user_id", F.lit("zz")))
    result = score.trip_score(twice, microtrips, events)
    assert result.count() == trips.count()
    assert {r.user_id for r in result.collect()} == {"zz"}


def test_norms_stay_between_zero_and_one(spark):
    stats = spark.createDataFrame(
        [("v", "u", "a", 5000, 0, 20, 0), ("v", "u", "b", 10**6, 5, 0, 9)],
        "vehicle_id string, user_id string, trip_id string, distance bigint, accel bigint, "
        "deaccel bigint, overlimit bigint",
    )
    a, b = products.trip_norms(stats).orderBy("trip_id").collect()
    assert (a.norm_dist, a.norm_accel, a.norm_deaccel, a.norm_overlimit) == (0, 0, 1, 0)
    assert (b.norm_dist, b.norm_accel, b.norm_deaccel, b.norm_overlimit) == (1, 0.5, 0, 1)
    scores = products.vehicle_scores(products.trip_norms(stats), F.lit(1)).first()
    assert scores.cnt == 2 and abs(scores.score - (a.score + b.score) / 2) < 1e-9
