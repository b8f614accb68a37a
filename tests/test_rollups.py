"""Roll-ups and dates of faulty samples."""

from pyspark.sql import functions as F

from tripwright.functions.ids import millis_date
from tripwright.operators.rollups import collect_points, trip_rollup
from tripwright.plans import score


def test_a_sample_without_time_gives_no_first_values(spark):
    rows = [("t", None, 1, "vBAD"), ("t", 20, 2, "vLATE"), ("t", 10, 3, "vEARLY"), ("u", None, 4, "vONLY")]
    frame = spark.createDataFrame(rows, "trip_id string, time bigint, sample_id bigint, vehicle_id string")
    found = {r.trip_id: r for r in trip_rollup(frame, firsts=("vehicle_id",), tie=("sample_id",)).collect()}
    assert (found["t"].vehicle_id, found["t"].first_time, found["t"].mtrip_cnt) == ("vEARLY", 10, 3)
    assert (found["u"].vehicle_id, found["u"].first_time) == ("vONLY", None)


def test_times_outside_the_calendar_have_no_date(spark):
    rows = [(0,), (2**62,), (-(2**62),), (253402300799999,), (None,)]
    frame = spark.createDataFrame(rows, "ms bigint")
    assert [str(r[0]) for r in frame.select(millis_date(F.col("ms"))).collect()] == [
        "1970-01-01", "None", "None", "9999-12-31", "None",
    ]


def test_pieces_hold_consecutive_points(spark):
    rows = [(1, "t", k, k) for k in range(95)]
    frame = spark.createDataFrame(rows, "vehicle_id bigint, trip_id string, time bigint, sample_id bigint")
    pieces = collect_points(frame, [], chunk_rows=10).orderBy("piece").collect()
    assert [r.n for r in pieces] == [10] * 9 + [5]
    assert [p.time for r in pieces for p in r.points] == list(range(95))


def test_few_long_messages_make_a_heavy_track(spark):
    payload = "[" + ",".join('{"clt": %d, "lon": 1.0, "lat": 2.0}' % k for k in range(300)) + "]"
    frame = spark.createDataFrame([("t", payload), ("u", "{}"), ("u", None)], "trip_id string, payload string")
    heavy = score.heavy_tracks(frame, "trip_id", 100)
    assert [(r.trip_id, r._rows) for r in heavy.frame.collect()] == [("t", 300)]


def test_latest_trip_by_number(spark):
    rows = [("t", "9", "old"), ("t", "10", "new"), ("t", "no number", "bad")]
    frame = spark.createDataFrame(rows, "trip_id string, trip_created_time string, user_id string")
    assert [r.user_id for r in score.latest_trips(frame).collect()] == ["new"]
