"""Stored tables."""

from pyspark.sql import functions as F

from tripwright.operators import tables
from tripwright.plans.queries.stored import upserted
from tripwright.sources import tables as stored
from tripwright.streaming.sinks import upsert_batch


def event(i, payload, created="1", trip="00000001-6863-11e8-96b3-bf7af28e956c", ts="1528163787376"):
    return {"key1": f"e{i}", "event_id": f"e{i}", "payload": payload, "created_time": created,
            "trip_id": trip, "event_ts": ts, "vehicle_id": "v", "device_type": "GPS"}


def events(spark, *rows):
    schema = ", ".join(f"{c} string" for c in rows[0])
    return stored.conform(spark.createDataFrame([tuple(r.values()) for r in rows], schema), "sf_event")


def test_later_batches_win_and_repeats_change_nothing(spark, tmp_path):
    root = str(tmp_path)
    first = events(spark, event(1, "a"), event(2, "b"), event(3, "old", "9"), event(3, "new", "10"))
    upsert_batch(first, root, "sf_event", 0)
    second = events(spark, event(2, "c"), event(4, "d", trip="bad id"))
    for _ in range(2):
        upsert_batch(second, root, "sf_event", 1)
    expected = {"e1": "a", "e2": "c", "e3": "new", "e4": "d"}

    def current(folder):
        return {r.key1: r.payload for r in stored.load_table(spark, folder, "sf_event").collect()}

    assert current(root) == expected
    versions = spark.read.parquet(f"{root}/sf_event")
    assert versions.count() == 5
    days = {str(r.part_day) for r in versions.select("part_day").distinct().collect()}
    assert days == {"2018-06-05", "none"}
    new_root = str(tmp_path / "compact")
    stored.compact(spark, root, "sf_event", new_root)
    assert current(new_root) == expected
    assert spark.read.parquet(f"{new_root}/sf_event").count() == 4
    upsert_batch(events(spark, event(1, "z")), new_root, "sf_event", 2)
    assert current(new_root) == {**expected, "e1": "z"}


def test_days_are_folders(spark, tmp_path):
    root = str(tmp_path)
    rows = [event(1, "a"), event(2, "b", ts="1528250187376"), event(3, "c", ts="later")]
    upsert_batch(events(spark, *rows), root, "event_by_vehicle", 0)
    chosen = stored.load_table(spark, root, "event_by_vehicle", F.col("part_day") == "2018-06-06")
    assert [r.key1 for r in chosen.collect()] == ["e2"]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_day" in plan


def test_days_of_a_frame_prune_and_keys_filter_below_the_versions(spark, tmp_path):
    root = str(tmp_path)
    rows = [event(1, "a"), event(2, "b", ts="1528250187376"), event(3, "c", ts=str(2**62))]
    upsert_batch(events(spark, *rows), root, "event_by_vehicle", 0)
    days = spark.createDataFrame([("2018-06-06",), ("none",)], "part_day string")
    chosen = stored.load_table(spark, root, "event_by_vehicle", days=days)
    assert sorted(r.key1 for r in chosen.collect()) == ["e2", "e3"]
    own = stored.Among(spark.createDataFrame([("v",)], "vehicle_id string"), "vehicle_id")
    plan = stored.load_table(spark, root, "event_by_vehicle", days=days, among=own)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("Aggregate") < text.rindex("vehicle_id")
    assert len(plan.collect()) == 2


def test_a_repeated_batch_leaves_nothing_of_its_first_attempt(spark, tmp_path):
    root = str(tmp_path)
    for ts in ("1528163787376", "1528250187376"):
        upsert_batch(events(spark, event(1, ts, ts=ts)), root, "event_by_vehicle", 0)
    kept = stored.load_table(spark, root, "event_by_vehicle").collect()
    assert [r.payload for r in kept] == ["1528250187376"]


def test_view_of_a_stored_table(spark, tmp_path):
    upsert_batch(events(spark, event(1, "a")), str(tmp_path), "sf_event", 0)
    stored.load_table(spark, str(tmp_path), "sf_event", as_view=True)
    assert spark.sql("SELECT payload FROM sf_event").first().payload == "a"


def test_latest_per_key_of_many_copies(spark):
    rows = spark.range(5000).selectExpr("'k' AS k", "id % 100 AS version", "id % 3 AS x")
    assert tables.latest_per_key(rows, ["k"], ["version"]).collect()[0].version == 99


def test_cursor(spark):
    rows = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "k string, x int")
    keys, last = [], None
    while True:
        last = tables.next_key(rows, "k", last).first().next_key
        if last is None:
            break
        keys.append((last, tables.rows_with_key(rows, "k", last).count()))
    assert keys == [("a", 1), ("b", 2)]


def test_rekeyed_rows_are_sorted_and_complete(spark):
    rows = [("u1", "v2", 1), ("u0", "v1", 2), (None, "v0", 3), ("u0", None, 4)]
    frame = spark.createDataFrame(rows, "user_id string, vehicle_id string, x int")
    assert [r.x for r in tables.rekey(frame, "score_by_user", 1).collect()] == [2, 1]


def test_upserts_of_any_batch_number_count(spark, tmp_path):
    rows = [("a", -2, 9, 1.0), ("a", 0, 1, 2.0), ("b", -2, 1, 3.0), ("b", -2, 8, 4.0), ("c", 0, 5, 5.0), ("c", 7, 2, 6.0), ("c", 7, 6, 7.0)]
    writes = spark.createDataFrame(rows, "key1 string, batch_id long, event_id long, value double")
    got = upserted(spark, str(tmp_path), writes)
    assert sorted(map(tuple, got.collect())) == [("a", 0, 1, 2.0), ("b", -2, 8, 4.0), ("c", 7, 6, 7.0)]
    versions = spark.read.parquet(f"{tmp_path}/writes")
    assert versions.select("batch_id").distinct().count() == 6 and versions.count() == 7
    assert upserted(spark, f"{tmp_path}/none", writes.limit(0)).count() == 0
