"""Ingest and score applications on file streams."""

import json

from tripwright.operators.messages import to_score
from tripwright.plans import fixtures as fx
from tripwright.plans import products, score
from tripwright.sources.streams import drop_resent, file_messages
from tripwright.streaming import ingest
from tripwright.streaming import score as app
from tripwright.streaming.sinks import folder_forward, print_rows, progress_state, start_key_counts

NOW = {"availableNow": True}
KV = "key string, value string"


def send(spark, folder, rows, name):
    frame = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, KV)
    frame.coalesce(1).write.parquet(f"{folder}/{name}")


def rows_of(frame, *drop):
    return sorted((tuple(r) for r in frame.drop(*drop).collect()), key=repr)


def run_ingest(spark, base):
    query = ingest.start_ingest(
        file_messages(spark, f"{base}/topic/*", files_per_batch=1),
        f"{base}/tables",
        f"{base}/checkpoint",
        folder_forward(f"{base}/score"),
        trigger=NOW,
    )
    assert query.awaitTermination(300)


def run_score(spark, base, start=app.start_score, **settings):
    query = start(
        file_messages(spark, f"{base}/score/*", files_per_batch=1),
        f"{base}/tables",
        f"{base}/gold",
        f"{base}/checkpoint",
        trigger=NOW,
        **settings,
    )
    assert query.awaitTermination(300)


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    # Two batches that mix all kinds of messages.
    whole = fx.messages(spark, sf_dir)
    for part in range(2):
        some = whole.where(f"pmod(hash(value), 2) = {part}")
        send(spark, f"{base}/topic", some, f"p{part}")
    run_ingest(spark, base)
    run_score(spark, base)
    run_score(spark, base, app.start_multi_score, by="trip_id")

    trips = fx.scored_trips(spark, sf_dir)
    microtrips = fx.stored_microtrips(spark, sf_dir)
    events = fx.stored_events(spark, sf_dir)
    single = app.current_results(spark, f"{base}/gold", "trip_stat", "trip_id")
    expected = score.trip_score(trips, microtrips, events)
    assert rows_of(single.select(*expected.columns)) == rows_of(expected)
    scores = app.current_scores(spark, f"{base}/gold")
    wanted = products.trip_norms(expected)
    assert rows_of(scores.select(*wanted.columns)) == rows_of(wanted)
    by_vehicle = app.current_vehicle_scores(spark, f"{base}/gold")
    assert by_vehicle.agg({"cnt": "sum"}).first()[0] == wanted.count()
    multi = app.current_results(spark, f"{base}/gold", "ms_trip_stat", "trip_id")
    expected = score.multi_trip_score(trips, microtrips, events, by="trip_id")
    assert rows_of(multi.select(*expected.columns)) == rows_of(expected)

    found = app.current_events(spark, f"{base}/gold", "gps_event", "trip_stat")
    expected = score.score_events(trips, score.stored_samples(microtrips))
    assert rows_of(found.select(*expected.columns)) == rows_of(expected)
    history = spark.read.parquet(f"{base}/tables/streaming_history")
    assert sorted(r.batch for r in history.collect()) == [0, 1]
    assert [(r.profile, r.batch) for r in progress_state(spark, f"{base}/tables").collect()] == [
        ("ingest", 1)
    ]

    # A second start finds nothing new.
    before = spark.read.parquet(f"{base}/tables/sf_microtrip").count()
    run_ingest(spark, base)
    assert spark.read.parquet(f"{base}/tables/sf_microtrip").count() == before


TRIP = "a88e7700-6863-11e8-96b3-bf7af28e956c"
START = 1528163784000


def sample_message(i, trip=TRIP, device="GPS", at=None):
    ts = START + 2000 * i if at is None else at
    payload = json.dumps([{"lon": 127 + i / 1000, "lat": 37.5, "clt": ts, "em": 2}])
    data = {"microTripId": f"m{device}{i}", "tripId": trip, "vehicleId": "v1", "ts": ts,
            "payload": payload, "deviceType": device, "createdTime": ts}
    return ("sf-microtrip", json.dumps({"data": data, "msgType": "microtrip"}))


def trip_message(trip=TRIP, device="GPS", latest=("GPS",), start=START, end=START + 100_000):
    data = {"tripId": trip, "vehicleId": "v1", "userId": "u", "startTs": start, "endTs": end,
            "deviceType": device, "createdTime": end, "payload": '{"dis":7}'}
    devices = [{"deviceType": d, "id": None} for d in latest]
    return ("sf-trip", json.dumps({"data": data, "latestTrip": devices, "msgType": "trip"}))


def test_resent_trips_and_late_samples(spark, tmp_path):
    base = str(tmp_path)
    send(spark, f"{base}/topic", [sample_message(i) for i in range(6)] + [trip_message()], "a")
    run_ingest(spark, base)
    run_score(spark, base)

    def result():
        return app.current_results(spark, f"{base}/gold", "trip_stat", "trip_id").collect()

    (one,) = result()
    assert (one.mtrip_cnt, one.lturn, one.trip_dist, one.date) == (6, 6, 7, "2018-06-05")
    # The trip comes again, with samples that were late and one that is a repeat.
    late = [sample_message(6), sample_message(7), sample_message(0)]
    send(spark, f"{base}/topic", [*late, trip_message()], "b")
    run_ingest(spark, base)
    run_score(spark, base)
    (two,) = result()
    assert (two.mtrip_cnt, two.batch_id) == (8, 1)
    assert two.device_dist > one.device_dist
    events = app.current_events(spark, f"{base}/gold", "gps_event", "trip_stat")
    assert events.count() == len({r.id for r in events.collect()})


def test_messages_behind_the_broker_time_reach_their_batch(spark, tmp_path):
    """A lagging partition: first arrivals ten minutes behind what came before."""
    times = ("10:10:00", "10:00:00", "10:20:00", "10:10:01")
    for n, at in enumerate(times):
        frame = spark.createDataFrame([(f"2024-01-01 {at}", "k", str(n))], f"timestamp string, {KV}")
        rows = frame.withColumn("timestamp", frame.timestamp.cast("timestamp"))
        send(spark, f"{tmp_path}/score", rows, f"p{n}")
        stream = file_messages(spark, f"{tmp_path}/score/*", timestamp=True, files_per_batch=1)
        seen = []
        query = app._start(
            stream, "late", f"{tmp_path}/cp", NOW, lambda batch, _, seen=seen: seen.extend(batch.collect())
        )
        assert query.awaitTermination(100)
        assert [r.value for r in seen] == [str(n)]


def test_vehicle_result_covers_earlier_trips(spark, tmp_path):
    base = str(tmp_path)
    later = "b88e7700-6863-11e8-96b3-bf7af28e956c"
    other = "c88e7700-6863-11e8-96b3-bf7af28e956c"
    send(
        spark,
        f"{base}/topic",
        [sample_message(i) for i in range(5)]
        + [sample_message(i, other, "BLACKBOX", START + 500 + i) for i in range(3)]
        + [trip_message(latest=("BLACKBOX", "GPS")), trip_message(other, "BLACKBOX", ("GPS", "BLACKBOX"))],
        "a",
    )
    run_ingest(spark, base)
    run_score(spark, base, app.start_multi_score)

    def result():
        return app.current_results(spark, f"{base}/gold", "ms_trip_stat", "vehicle_id").collect()

    (one,) = result()
    # Samples of every device in the time range of the representative device's trip.
    assert (one.trip_id, one.device_type, one.mtrip_cnt) == (TRIP, "GPS", 8)
    start = START + 200_000
    rows = [sample_message(i + 100, later) for i in range(4)]
    send(spark, f"{base}/topic", [*rows, trip_message(later, start=start, end=start + 50_000)], "b")
    run_ingest(spark, base)
    run_score(spark, base, app.start_multi_score)
    (two,) = result()
    assert (two.trip_id, two.mtrip_cnt) == (TRIP, 12)


def test_a_bad_end_time_leaves_other_vehicles_alone(spark, tmp_path):
    """A trip that ends outside the calendar reads to the last day; the others read their own days."""
    base = str(tmp_path)
    other = "c88e7700-6863-11e8-96b3-bf7af28e956c"

    def of_vehicle(message, vehicle):
        return (message[0], message[1].replace('"v1"', f'"{vehicle}"').replace('"mGPS', f'"m{vehicle}'))

    rows = [sample_message(i) for i in range(10)] + [trip_message()]
    bad = [sample_message(i, other, at=START + 2000 * i + 86_400_000 * (i > 6)) for i in range(10)]
    bad += [trip_message(other, end=2**62)]
    send(spark, f"{base}/topic", rows + [of_vehicle(m, "v2") for m in bad], "a")
    run_ingest(spark, base)
    run_score(spark, base, app.start_multi_score)
    got = app.current_results(spark, f"{base}/gold", "ms_trip_stat", "vehicle_id").collect()
    assert {(r.vehicle_id, r.mtrip_cnt) for r in got} == {("v1", 10), ("v2", 10)}
    ranges = [(START, START + 1), (-(2**62), START), (START, 2**62), (-(2**62), 2**62)]
    days = spark.createDataFrame([("2018-06-04",), ("2018-06-05",), ("2018-06-06",), ("none",)], "part_day string")
    for picked, want in (([0], 1), ([0, 1], 3), ([2], 3), ([3], 4), ([], 0)):
        trips = spark.createDataFrame([ranges[k] for k in picked], "start_ts bigint, end_ts bigint")
        assert days.where(app.days_of_ranges(trips)).count() == want


def test_key_counts_and_console(spark, tmp_path):
    send(spark, f"{tmp_path}/topic", [("a", "1"), ("a", "2"), ("b", "3"), (None, "4")], "x")
    stream = file_messages(spark, f"{tmp_path}/topic/*", files_per_batch=1)
    counts = start_key_counts(stream, "key_counts", "memory", str(tmp_path / "cp"))
    counts.processAllAvailable()
    counts.stop()
    assert {r.key: r["count"] for r in spark.table("key_counts").collect()} == {"a": 2, "b": 1, None: 0}
    shown = print_rows(stream, 3, "shown")
    shown.processAllAvailable()
    shown.stop()
    print_rows(spark.table("key_counts"), 3)


def test_messages_that_come_again_are_dropped(spark, tmp_path):
    times = ("2024-01-01 00:00:00", "2024-01-01 00:00:01", "2024-01-01 00:00:01")
    rows = [(t, "a", v) for t, v in zip(times, ("1", "1", "2"), strict=True)]
    frame = spark.createDataFrame(rows, "timestamp string, key string, value string")
    frame.selectExpr("timestamp(timestamp) AS timestamp", "key", "value").write.parquet(f"{tmp_path}/t/x")
    stream = drop_resent(file_messages(spark, f"{tmp_path}/t/*", timestamp=True, files_per_batch=1))
    query = stream.writeStream.format("memory").queryName("once").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("once").count() == 2


def test_forwarded_messages_keep_their_value(spark, sf_dir):
    trips = fx.trip_messages(spark, sf_dir)
    assert rows_of(to_score(trips), "key") == rows_of(trips, "key")
