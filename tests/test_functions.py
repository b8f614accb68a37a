"""Scalar functions."""

import math

from pyspark.sql import functions as F

from tripwright.functions import codes, geo, ids, text
from tripwright.operators import stats


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_uuid_time(spark):
    uuid = F.lit("a88e7700-6863-11e8-96b3-bf7af28e956c")
    assert one(spark, ids.uuid_millis(uuid)) == 1528163787376
    assert str(one(spark, ids.uuid_date(uuid))) == "2018-06-05"
    assert str(one(spark, ids.uuid_date(uuid, "America/Los_Angeles"))) == "2018-06-04"


def test_uuid_date_does_not_depend_on_the_session_zone(spark):
    uuid = F.lit("a88e7700-6863-11e8-96b3-bf7af28e956c")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert str(one(spark, ids.uuid_date(uuid))) == "2018-06-05"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_other_ids_have_no_time(spark):
    for bad in ("a88e7700-6863-41e8-96b3-bf7af28e956c", "null", "", "a88e7700"):
        assert one(spark, ids.uuid_ticks(F.lit(bad))) is None


def test_latest_uuid_on_equal_times_and_order(spark):
    rows = [
        ("a", "00000005-6863-11e8-96b3-bf7af28e956c"),
        ("a", "00000001-6864-11e8-96b3-bf7af28e956c"),
        ("a", "ffffffff-0000-11e8-96b3-bf7af28e956c"),
    ]
    frame = spark.createDataFrame(rows, "k string, u string")
    assert frame.groupBy("k").agg(ids.latest_uuid(F.col("u")).alias("u")).first().u == rows[1][1]


def test_haversine_and_bearing(spark):
    a, b = (F.lit(126.967), F.lit(37.5671)), (F.lit(126.967), F.lit(37.5684))
    assert math.isclose(one(spark, geo.haversine_km(*a, *b)), 0.14455, rel_tol=1e-4)
    here = (F.lit(0.0), F.lit(0.0))
    for lon, lat, degrees in ((0, 1, 0), (1, 0, 90), (0, -1, 180), (-1, 0, 270)):
        assert one(spark, geo.bearing(*here, F.lit(float(lon)), F.lit(float(lat)))) == degrees


def test_masks(spark):
    rows = [(m,) for m in (2, 4, 8, 16, 32, 64)]
    frame = spark.createDataFrame(rows, "em int").withColumns({"ldw": F.lit(0), "fcw": F.lit(0)})
    total = frame.agg(*stats.counter_sums()).first()
    assert total.start == 0
    names = ("lturn", "rturn", "uturn", "deaccel", "accel", "stop")
    assert [total[n] for n in names] == [1] * 6
    for mask in (None, -1, 0, 128):
        low = spark.createDataFrame([(mask,)], "em int")
        flags = codes.mask_flags().values()
        assert list(low.select(*[F.expr(f) for f in flags]).first()) == [0] * 7


def test_text_merges(spark):
    def merged(function, *texts):
        return one(spark, function(F.array(*[F.lit(t) for t in texts])))

    assert merged(text.merge_distinct, "P2502", "P2502") == "P2502"
    assert merged(text.merge_distinct, "P2503", "", "P2502") == "P2502,P2503"
    assert merged(text.merge_distinct, "") == ""
    assert merged(text.merge_unless_contained, "P2502", "P2502") == "P2502"
    assert merged(text.merge_unless_contained, "13", "3") == "13"
    assert merged(text.merge_distinct, "13", "3") == "13,3"


def test_texts(spark):
    assert one(spark, text.lon_lat_text(F.lit(127.5), F.lit(37.25))) == "{lon:127.5,lat:37.25}"
    assert one(spark, text.lon_lat_text(F.lit(None), F.lit(37.25))) is None
    assert one(spark, text.rule_values(F.lit("-,-7.5,0"))) == [-1, -7500, 0]
    frame = spark.createDataFrame([(2, 0, 'a"b', "")], "accel int, stop int, dtcc string, bw string")
    assert frame.select(text.counters_json(["accel", "stop"])).first()[0] == '{"accel":2}'
    assert frame.select(text.texts_json(["dtcc", "bw"])).first()[0] == '{"dtcc":"a\\"b"}'
