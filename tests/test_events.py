"""Driving-event rules, roads and event rows."""

import pytest
from pyspark.sql import functions as F

from tripwright.functions.codes import event_code, event_name
from tripwright.operators import events as ev
from tripwright.schemas import SPEED_RULES


def event_of(spark, before, after, category="taxi", rules=SPEED_RULES):
    frame = spark.createDataFrame(
        [(before * 1000, after * 1000, category)], "prev_speed_mh bigint, speed_mh bigint, c string"
    )
    ruled = ev.with_traffic_event(frame, "c", rules).first().event
    if category == "taxi":
        assert ev.with_traffic_event(frame, None, rules).first().event == ruled
    return ruled


@pytest.mark.parametrize(
    ("before", "after", "event"),
    [
        (6, 14, "accel"),
        (50, 36, "deaccel"),
        (5, 13, "start"),
        (19, 5, "stop"),
        (20, 27, None),
        (9, 9, None),
    ],
)
def test_taxi_rules(spark, before, after, event):
    assert event_of(spark, before, after) == event


def test_other_categories(spark):
    assert event_of(spark, 6, 12, "bus") == "accel"
    assert event_of(spark, 0, 11, "etas") == "start"
    assert event_of(spark, 1, 12, "etas") == "accel"
    assert event_of(spark, 7, 0, "etas") is None
    assert event_of(spark, 8, 0, "etas") == "stop"
    assert event_of(spark, 6, 14, "unknown") == "accel"


def test_a_missing_first_rule_ends_the_search(spark):
    rules = {"taxi": {"accel": "-,8,-", "stop": "-,-14,5"}}
    assert event_of(spark, 6, 20, rules=rules) is None
    assert event_of(spark, 19, 5, rules=rules) == "stop"
    assert event_of(spark, 50, 20, rules=rules) is None


def test_sensor_rules_come_first(spark):
    frame = spark.createDataFrame([("etas", "bus"), ("GPS", "bus"), ("GPS", None)], "s string, c string")
    rows = frame.select(ev.rules_of(F.col("s"), F.col("c"))["start"].alias("r")).collect()
    assert [r.r for r in rows] == [[0, 11000, -1], [5000, 6000, -1], [5000, 8000, -1]]


def test_event_codes_and_names_agree(spark):
    names = ["start", "accel", "deaccel", "stop", "overlimit"]
    frame = spark.createDataFrame([(n,) for n in [*names, "other"]], "n string")
    rows = frame.select(event_code(F.col("n")).alias("c"), event_name(event_code(F.col("n"))).alias("n2"))
    assert [tuple(r) for r in rows.collect()] == [
        (1, "start"), (2, "accel"), (3, "deaccel"), (4, "stop"), (5, "overlimit"), (0, None),
    ]


MOVES = "trip_id string, sample_id bigint, time bigint, lon double, lat double, speed_mh bigint"
ROADS = (
    "road_id string, rank int, max_speed_mh bigint, min_lon double, max_lon double, "
    "min_lat double, max_lat double"
)


def test_over_limit_on_short_and_long_roads(spark, monkeypatch):
    moves = [("t", i, i, -10 + i * 0.37, 30 + i * 0.11, i * 1000) for i in range(120)]
    roads = [
        ("short", 1, 5000, -9.0, -8.99, 30.0, 31.0),
        ("long", 2, 20000, -10.0, 30.0, 29.0, 60.0),
        ("all", 3, 100000, -180.0, 180.0, -90.0, 90.0),
        ("edge", 4, 0, -9.63, -9.26, 30.0, 30.2),
    ]
    expected = sorted(
        (i, r[0])
        for _, i, _, lon, lat, speed in moves
        for r in roads
        if r[3] <= lon < r[4] and r[5] <= lat < r[6] and speed > r[2]
    )
    m, r = spark.createDataFrame(moves, MOVES), spark.createDataFrame(roads, ROADS)
    found = ev.over_limit(m, r, ["sample_id"]).collect()
    assert sorted((x.sample_id, x.road_id) for x in found) == expected
    # The same with a shuffled and salted grid.
    monkeypatch.setattr(ev, "BROADCAST_BYTES", 0)
    salted = ev.over_limit(m, r, ["sample_id"], limit=7).collect()
    assert sorted((x.sample_id, x.road_id) for x in salted) == expected


def test_event_rows_have_stable_ids(spark):
    frame = spark.createDataFrame(
        [("v", "u", "t", 127.0, 37.5, 9, "stop", 100, "GPS", 1)],
        "vehicle_id string, user_id string, trip_id string, lon double, lat double, time bigint, "
        "event string, speed_mh bigint, device_type string, sample_id bigint",
    )
    one, two = (ev.event_rows(frame, F.col("sample_id")).first() for _ in range(2))
    assert one == two and one.event_type == 4 and one.info == "" and len(one.id) == 64
