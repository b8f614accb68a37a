"""Messages, payloads and devices."""

import json

from pyspark.sql import functions as F

from tripwright.operators import devices, payloads, points
from tripwright.operators import messages as m
from tripwright.schemas import SCORE_KEY
from tripwright.sources.streams import text_messages

KV = "key string, value string"


def trip_message(**data):
    body = {"data": {"tripId": "t1", "startTs": 1528163784000, "endTs": 1528163790000, **data}}
    body |= {"latestTrip": [{"deviceType": "GPS", "id": None}], "msgType": "trip"}
    return json.dumps(body, separators=(",", ":"))


def test_numbers_keep_their_text(spark):
    frame = spark.createDataFrame([("sf-trip", trip_message(updated=3))], KV)
    data = m.parse_trips(frame).select("data.*").first()
    assert (data.startTs, data.updated, data.payload) == ("1528163784000", "3", None)
    typed = m.trip_rows(m.parse_trips(frame)).first()
    assert typed.start_ts == 1528163784000
    assert m.flatten_trips(m.parse_trips(frame)).first().date == "2018-06-05"


def test_bad_numbers_become_null(spark):
    frame = spark.createDataFrame([("sf-trip", trip_message(startTs="soon"))], KV)
    assert m.trip_rows(m.parse_trips(frame)).first().start_ts is None
    assert m.flatten_trips(m.parse_trips(frame)).first().date is None


def test_lines_are_routed_by_kind(spark):
    lines = [
        '{"data":{},"msgType":"microtrip"}',
        'sf-trip | {"data":{},"msgType":"trip"}',
        '{"data":{},"msgType":"event"}',
        "nothing",
    ]
    routed = m.route_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r.key for r in routed] == ["sf-microtrip", "sf-trip", "sf-event", "none"]
    assert routed[1].value == '{"data":{},"msgType":"trip"}' and routed[3].value == "nothing"


def test_recorded_lines_are_read_as_messages(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text(trip_message() + "\nsf-trip | " + trip_message() + "\n\nother\n")
    recorded = text_messages(spark, str(path))
    assert sorted(r.key for r in recorded.collect()) == ["none", "none", "sf-trip", "sf-trip"]
    parsed = m.trip_rows(m.parse_trips(recorded)).collect()
    assert [r.trip_id for r in parsed] == ["t1", "t1"]


def test_forwarded_trips_parse_under_the_score_key(spark):
    frame = spark.createDataFrame([("sf-trip", trip_message()), ("sf-event", "{}")], KV)
    forwarded = m.to_score(frame)
    assert [r.key for r in forwarded.collect()] == [SCORE_KEY]
    assert m.parse_trips(forwarded, SCORE_KEY).count() == 1


def samples_of(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    return payloads.explode_samples(frame).orderBy("id", "pos").collect()


def test_sample_payload_forms(spark):
    rows = samples_of(
        spark,
        "",
        None,
        "text",
        "[1,2]",
        '{"lon":1.0,"lat":2.0,"clt":3,"tid":9}',
        '[{"lon":1.0,"sp":10.2,"em":4},{"clt":5}]',
        "[]",
    )
    assert [(r.id, r.pos, r.lon, r.clt, r.sp, r.em) for r in rows] == [
        (4, 0, 1.0, 3, None, None),
        (5, 0, 1.0, None, None, 4),
        (5, 1, None, 5, None, None),
    ]


def test_trip_payload_end_position_under_both_names(spark):
    frame = spark.createDataFrame(
        [('{"dis":5,"edlat":1.5,"edlon":2.5}',), ('{"dis":6,"endlat":3.5,"endlon":4.5}',), ("",)],
        "p string",
    )
    rows = [r.p for r in frame.select(payloads.parse_trip_payload(F.col("p")).alias("p")).collect()]
    assert [r and (r.dis, r.endlat, r.endlon) for r in rows] == [(5, 1.5, 2.5), (6, 3.5, 4.5), None]


def test_event_payload_forms(spark):
    texts = [
        "",
        None,
        "text",
        "[1,2]",
        "5",
        '{"dtcc":"P1","wbv":3,"ldw":31}',
        '[1,{"dtcc":7,"wbv":10.2,"fcw":"31"},"s",null,{"dclon":1.5,"dclat":2.5}]',
        '{"plon":1.5}',
    ]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, payload string")
    rows = payloads.event_elements(frame).orderBy("id", "cwdrv").collect()
    assert [(r.id, r.dtcc, r.bw, r.ldw, r.fcw, r.cwdrv, r.cwprk) for r in rows] == [
        (5, "P1", "3", 31, 0, "", ""),
        (6, "", "", 0, 0, "", ""),
        (6, "", "", 0, 0, "{lon:1.5,lat:2.5}", ""),
        (7, "", "", 0, 0, "", ""),
    ]
    assert [r.id for r in payloads.rejected(frame).orderBy("id").collect()] == [0, 2]


def test_base_device(spark):
    cases = [
        (["GPS", "OBD"], "OBD"),
        (["BLACKBOX", "ADAS", "GPS"], "ADAS"),
        (["BLACKBOX"], "BLACKBOX"),
        (["OTHER", None], None),
        ([], None),
        (None, None),
    ]
    rows = [(i, None if c is None else [(d, None) for d in c]) for i, (c, _) in enumerate(cases)]
    frame = spark.createDataFrame(rows, "i int, latest_trip array<struct<deviceType string, id string>>")
    found = frame.select(devices.base_device(F.col("latest_trip")).alias("d")).collect()
    assert [r.d for r in found] == [d for _, d in cases]


def test_point_cleaning(spark):
    rows = [
        (2, 2, 2.0, 2.0, "id_2"),
        (1, 1, 1.0, 1.0, "id_1"),
        (3, 3, 3.0, 3.0, "id_3"),
        (0, 0, 0.0, 0.0, "id_4"),
        (None, 9, 1.0, 1.0, "id_5"),
        (9, None, 1.0, 1.0, "id_6"),
        (9, 9, None, 1.0, "id_7"),
        (9, 9, 1.0, 1.0, None),
    ]
    frame = spark.createDataFrame(rows, "clt bigint, ts bigint, lon double, lat double, trip_id string")
    clean = points.clean_points(frame).orderBy("time").collect()
    assert [(r.trip_id, r.time) for r in clean] == [("id_1", 1), ("id_2", 2), ("id_3", 3), ("id_5", 9)]


def test_serialized_lines_parse_again(spark):
    frame = spark.createDataFrame([("sf-trip", trip_message(payload='{"dis":"x"}', deviceType="GPS"))], KV)
    trip = m.trip_rows(m.parse_trips(frame))
    line = trip.select(m.trip_line().alias("value")).first().value
    topic, body = line.split(",", 1)
    assert topic == "sf-trip"
    assert json.loads(body)["latestTrip"] == [{"deviceType": "GPS", "id": None}]
    again = m.trip_rows(m.parse_trips(m.route_lines(spark.createDataFrame([(line,)], "value string"))))
    same = ["trip_id", "start_ts", "end_ts", "trip_payload_str", "device_type"]
    assert again.select(same).first() == trip.select(same).first()
