"""States of track segments against the facts of whole tracks, for many ways to cut a track."""

import random

import pytest
from pyspark.sql import functions as F

from tripwright.operators.rollups import track_facts
from tripwright.operators.segments import (
    COUNTED,
    FOUND,
    interleaved,
    merge_segments,
    segment_facts,
    track_segments,
)

SCHEMA = (
    "vehicle_id string, sample_id bigint, time bigint, lon double, lat double, em int, ldw int, fcw int, "
    "seg bigint, `edges` string, `open` string"
)
VEHICLE = ("vehicle_id",)
FACTS = ["vehicle_id", *COUNTED, "distance", *FOUND]


def random_rows(seed):
    """Tracks of 0 to 60 samples, standing, driving and faulty, cut at random places."""
    rng, rows, sample = random.Random(seed), [], 0
    for v in range(25):
        time, lon, lat, seg, speed = 1000, 127.0, 37.5, 0, 0.0
        for _ in range(rng.choice([1, 2, 3, 4, 6, 7, 12, 13, 60])):
            time += rng.choice([0, 300, 899, 900, 1000, 1000, 2000])
            speed = rng.choice([speed, 0.0, 0.00005, 0.0002])
            lon, lat = lon + speed, lat + rng.choice([0, 0.0001, -0.0002])
            seg += rng.random() < 0.25
            usable = rng.random() < 0.9
            codes = rng.choice([None, -1, 5, 127]), rng.choice([None, 31, 32]), rng.choice([31, 32, 0])
            rows.append((f"v{v}", sample, time if usable else None, lon, lat, *codes, seg, "x", "y"))
            sample += 1
    return rows


def facts_of(frame):
    return sorted(tuple(r) for r in frame.select(*FACTS).collect())


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(random_rows(1), SCHEMA)


@pytest.fixture(scope="module")
def whole(samples):
    found = facts_of(track_facts(samples, VEHICLE))
    assert sum(sum(r[-4:]) for r in found) > 50  # there are events to lose
    return found


@pytest.mark.parametrize("cut", ["0", "seg", "div(seg, 3)", "sample_id"])
def test_facts_of_segments_are_those_of_the_track(samples, whole, cut):
    cut = samples.withColumn("seg", F.expr(cut).cast("bigint"))
    states = track_segments(cut, (*VEHICLE, "seg"))
    assert facts_of(segment_facts(states, VEHICLE)) == whole
    assert states.agg(F.max(F.size("edges"))).first()[0] <= 12


@pytest.mark.parametrize("window", [1, 2, 5])
def test_windows_of_other_lengths(samples, window):
    states = track_segments(samples, (*VEHICLE, "seg"), window=window)
    want = facts_of(track_facts(samples, VEHICLE, window=window))
    assert facts_of(segment_facts(states, VEHICLE, window=window)) == want


def test_the_combination_is_associative(samples, whole):
    single = track_segments(samples, (*VEHICLE, "seg"), firsts=["time", "sample_id"])
    at_once = merge_segments(single.drop("seg"), VEHICLE)
    for step in (2, 3):
        grouped = single.withColumn("seg", F.expr(f"div(seg, {step})"))
        halves = merge_segments(grouped, (*VEHICLE, "seg"))
        columns = at_once.columns
        twice = merge_segments(halves.drop("seg"), VEHICLE).select(*columns)
        assert sorted(map(str, twice.collect())) == sorted(map(str, at_once.collect()))
        assert facts_of(segment_facts(halves, VEHICLE)) == whole
    assert facts_of(segment_facts(at_once, VEHICLE)) == whole
    direct = track_segments(samples, VEHICLE, firsts=["time", "sample_id"])
    assert sorted(map(str, direct.select(*at_once.columns).collect())) == sorted(map(str, at_once.collect()))


def test_heavy_segments_are_cut_in_blocks(samples, whole):
    states = track_segments(samples, (*VEHICLE, "seg"), limit=5)
    assert facts_of(segment_facts(states, VEHICLE, limit=5)) == whole


def test_interleaved_segments_are_found(spark):
    rows = [("apart", k, 10 * k, 1.0, 2.0, 0, 0, 0, k // 3, "", "") for k in range(9)]
    rows += [("touch", k, 10 * (k // 2), 1.0, 2.0, 0, 0, 0, k // 3, "", "") for k in range(9)]
    rows += [("mixed", k, 10 * k, 1.0, 2.0, 0, 0, 0, k % 2, "", "") for k in range(9)]
    inner = [0, 1, 1, 0, 2]
    rows += [("inside", k, 10 * k, 1.0, 2.0, 0, 0, 0, inner[k], "", "") for k in range(5)]
    rows += [("none", 0, None, 1.0, 2.0, 0, 0, 0, 0, "", ""), (None, 1, 5, 1.0, 2.0, 0, 0, 0, 0, "", "")]
    states = track_segments(spark.createDataFrame(rows, SCHEMA), (*VEHICLE, "seg"))
    assert sorted(r[0] for r in interleaved(states, VEHICLE).collect()) == ["inside", "mixed"]
    facts = {r.vehicle_id: r for r in segment_facts(states, VEHICLE).collect()}
    assert set(facts) == {"apart", "touch", "mixed", "inside", "none"}
    assert (facts["none"].mtrip_cnt, facts["none"].distance) == (1, 0)


def test_no_samples(spark):
    states = track_segments(spark.createDataFrame([], SCHEMA), (*VEHICLE, "seg"))
    assert segment_facts(merge_segments(states, (*VEHICLE, "seg")), VEHICLE).collect() == []
    assert interleaved(states, VEHICLE).collect() == []
