"""Range joins against loops, heavy keys, fan-out."""

import random

from tripwright.operators import joins, skew

TRIPS = "trip_id string, vehicle_id string, start_ts bigint, end_ts bigint"
POINTS = "vehicle_id string, event_id bigint, ts bigint"
HOUR = 3_600_000


def data(seed):
    rng = random.Random(seed)
    trips, points = [], []
    for i in range(60):
        start = rng.randint(-5, 400) * HOUR // 4
        length = rng.choice([0, 1, HOUR, 30 * HOUR, 33 * HOUR, 600 * HOUR, 20_000 * HOUR])
        trips.append((f"t{i}", f"v{rng.randint(0, 3)}", start, start + length))
    trips.append(("back", "v0", 10, 5))
    trips.append(("open", "v0", None, 5))
    trips.append(("huge", "v1", -(2**62), 2**62))
    edges = [x for t in trips for x in t[2:] if x is not None]
    for i in range(300):
        at = rng.choice(edges) if rng.random() < 0.5 else rng.randint(0, 500 * HOUR)
        points.append((f"v{rng.choice([0, 0, 0, 1, 2, 9])}", i, at))
    points.append(("v0", 999, None))
    return trips, points


def matches(trips, points):
    return sorted(
        (t[0], p[1])
        for t in trips
        for p in points
        if t[1] == p[0] and None not in (t[2], t[3], p[2]) and t[2] <= p[2] <= t[3]
    )


def found(spark, trips, points, **settings):
    rows = joins.range_join(
        spark.createDataFrame(trips, TRIPS),
        spark.createDataFrame(points, POINTS),
        ["vehicle_id"],
        "start_ts",
        "end_ts",
        "ts",
        ["event_id"],
        **settings,
    )
    assert set(rows.columns) == {"trip_id", "vehicle_id", "start_ts", "end_ts", "event_id", "ts"}
    return sorted((r.trip_id, r.event_id) for r in rows.collect())


def test_range_join(spark):
    for seed in (1, 2):
        trips, points = data(seed)
        assert found(spark, trips, points) == matches(trips, points)


def test_range_join_with_salted_buckets(spark):
    trips, points = data(3)
    assert found(spark, trips, points, limit=5) == matches(trips, points)


def test_range_join_of_nothing(spark):
    assert found(spark, [], [("v0", 1, 1)]) == []


def test_salt_spreads_a_heavy_key(spark):
    big = spark.createDataFrame([("hot", i) for i in range(1000)] + [("cold", -1)], "k string, i bigint")
    small = spark.createDataFrame([("hot", "a"), ("hot", "b"), ("cold", "c")], "k string, x string")
    left, right, keys = skew.salted_pair(big, small, ["k"], ["i"], limit=100)
    assert keys == ["k", "_salt"]
    sizes = [r["count"] for r in left.groupBy(*keys).count().collect()]
    assert len(sizes) == 11 and max(sizes) < 200
    assert left.join(right, keys).count() == 2001


def test_left_join_keeps_trips_without_events(spark):
    trips = spark.createDataFrame([("a",), ("b",)], "trip_id string")
    events = spark.createDataFrame([("a", 1), ("a", 2), ("z", 3)], "trip_id string, e int")
    for limit in (1, 100):
        rows = joins.left_join_events(trips, events, ["e"], limit=limit).collect()
        assert sorted((r.trip_id, r.e or 0) for r in rows) == [("a", 1), ("a", 2), ("b", 0)]
    # a key that only seems heavy
    heavy = skew.HeavyKeys(spark.createDataFrame([("b", 9), ("a", 9)], "trip_id string, _rows bigint"), 2, 18)
    rows = joins.left_join_events(trips, events, ["e"], heavy=heavy).collect()
    assert sorted((r.trip_id, r.e or 0) for r in rows) == [("a", 1), ("a", 2), ("b", 0)]


def test_fanout_is_counted_without_making_it(spark):
    trips = spark.createDataFrame([("a",), ("b",), ("c",)], "trip_id string")
    samples = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2, "trip_id string")
    events = spark.createDataFrame([("a",)] * 4, "trip_id string")
    rows = joins.fanout_counts(trips, samples, events, "trip_id").collect()
    assert sorted((r.trip_id, r.n_rows) for r in rows) == [("a", 12), ("b", 2)]
