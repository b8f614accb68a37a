"""Moves and distances against plain loops."""

import math
import random

from pyspark.sql import functions as F

from tripwright.operators import kinematics as kin
from tripwright.operators.events import with_traffic_event
from tripwright.operators.rollups import collect_points, track_facts

SCHEMA = "trip_id string, sample_id bigint, time bigint, lon double, lat double"

# Eleven points a second apart that stand, drive and stand again.
GOLDEN = [37.5671, 37.5671, 37.5673, 37.5678, 37.5682, 37.5683, *[37.5684] * 5]


def golden(spark):
    rows = [("g", i, 1000 * (i + 1), 126.967, lat) for i, lat in enumerate(GOLDEN)]
    return spark.createDataFrame(rows, SCHEMA)


def km(a, b):
    dlat, dlon = math.radians(b[1] - a[1]), math.radians(b[0] - a[0])
    h = math.sin(dlat / 2) ** 2 + math.cos(math.radians(a[1])) * math.cos(math.radians(b[1])) * (
        math.sin(dlon / 2) ** 2
    )
    return 6371 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def brute_moves(points, w):
    """Moves of one track by their definition: the last w steps before each point."""
    points = sorted((t, s, lon, lat) for s, t, lon, lat in points if t is not None)
    if len(points) < 3:
        return {}
    found, last = {}, None
    for j in range(1, len(points)):
        head = max(0, j - w)
        metres = sum(km(points[i - 1][2:], points[i][2:]) * 1000.0 for i in range(head + 1, j + 1))
        ms = points[j][0] - points[head][0]
        speed = 0 if ms < 900 else int(metres) * 3600000 // ms
        prev = last[1] if last and abs(points[head][0] - last[0]) >= 900 else None
        found[points[j][1]] = (points[head][0], ms, int(metres), speed, prev)
        last = (points[head][0], speed)
    return found


def random_tracks(seed, tracks, longest):
    rng, rows, sample = random.Random(seed), [], 0
    for t in range(tracks):
        n = rng.choice([0, 1, 2, 3, 4, rng.randint(5, longest)])
        time, lon, lat = 1000, 127.0, 37.5
        for _ in range(n):
            time += rng.choice([0, 1, 300, 899, 900, 1000, 2000, 5000])
            lon += rng.choice([0, 0.00001, 0.0003])
            lat += rng.choice([0, 0.0001, -0.0002])
            unusable = rng.random() < 0.1
            rows.append((f"t{t}", sample, None if unusable else time, lon, lat))
            sample += 1
    return rows


def computed(frame, w, limit):
    cols = ("head_time", "elapsed_ms", "distance_m", "speed_mh", "prev_speed_mh")
    rows = kin.moves(frame, w, limit=limit).select("sample_id", *cols).collect()
    assert len(rows) == len({r.sample_id for r in rows})
    return {r.sample_id: tuple(r[c] for c in cols) for r in rows}


def check(spark, rows, w, limit):
    by_track = {}
    for trip, sample, time, lon, lat in rows:
        by_track.setdefault(trip, []).append((sample, time, lon, lat))
    expected = {}
    for points in by_track.values():
        expected |= brute_moves(points, w)
    assert computed(spark.createDataFrame(rows, SCHEMA), w, limit) == expected


def test_golden_track(spark):
    moved = kin.moves(golden(spark), 5).orderBy("sample_id")
    assert [r.speed_mh for r in moved.collect()] == [
        0, 39600, 92400, 109800, 95760, 103680, 87840, 47520, 15840, 7920,
    ]
    events = with_traffic_event(moved).where("event IS NOT NULL").orderBy("sample_id")
    assert [(r.sample_id, r.event) for r in events.collect()] == [
        (7, "deaccel"),
        (8, "deaccel"),
        (9, "deaccel"),
    ]


def test_golden_distance(spark):
    total = kin.with_moves(golden(spark), 1).agg(
        kin.driven_distance().alias("whole"), F.round(F.sum("step_m"), 2).alias("exact")
    )
    assert tuple(total.first()) == (143, 144.55)


def test_moves_match_their_definition(spark):
    for seed, w in ((1, 1), (2, 2), (3, 3), (4, 5), (5, 7)):
        check(spark, random_tracks(seed, 40, 30), w, limit=10_000)


def test_long_tracks_in_blocks_give_the_same_moves(spark):
    for seed, w, limit in ((11, 1, 4), (12, 5, 6), (13, 5, 7), (14, 3, 10)):
        check(spark, random_tracks(seed, 25, 60), w, limit)


def test_one_track_holds_everything(spark):
    rng = random.Random(3)
    rows = [("hot", i, rng.randint(1, 5) * 1000, 127 + i / 1e5, 37.5) for i in range(400)]
    check(spark, rows, 5, limit=50)


def test_rows_without_track_are_left_out(spark):
    rows = [(None, i, 1000 * i, 127.0, 37.5) for i in range(1, 50)]
    rows += [("t", 100 + i, 1000 * i, 127.0, 37.5) for i in range(1, 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for limit in (1000, 10, 3):
        assert kin.moves(frame, 5, limit=limit).count() == 3


def test_facts_count_unusable_samples_too(spark):
    rows = [("t", i, 1000 * i, 127.0, 37.5, i % 2, 31, 32) for i in range(1, 5)]
    rows.append(("t", 9, None, None, None, 64, None, None))
    frame = spark.createDataFrame(rows, SCHEMA + ", em int, ldw int, fcw int")
    for limit in (100, 3):
        fact = track_facts(frame, limit=limit).first()
        assert (fact.mtrip_cnt, fact.start, fact.stop, fact.lldw, fact.fcw2, fact.distance) == (
            5, 2, 1, 4, 4, 0,
        )


def test_impossible_coordinates_count_as_no_distance(spark):
    rows = [("t", i, 1000 * i, 127.0, lat) for i, lat in enumerate((37.5, 1e9, -500.0, 37.5), 1)]
    assert kin.moves(spark.createDataFrame(rows, SCHEMA), 5).count() == 3


def test_collected_pieces_are_bounded_and_whole(spark):
    rows = [("t", i, 60_000 + i % 7, 127.0, 37.5) for i in range(500)]
    pieces = collect_points(spark.createDataFrame(rows, SCHEMA), ["lon"], chunk_rows=50).collect()
    assert len(pieces) > 5 and max(p.n for p in pieces) < 150
    assert len({p.piece for p in pieces}) == len(pieces)
    assert sorted(x.sample_id for p in pieces for x in p.points) == list(range(500))
