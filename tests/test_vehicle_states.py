"""The vehicle results from stored states, batch by batch, against those over everything."""

import pytest
from test_streaming import (
    START,
    TRIP,
    rows_of,
    run_ingest,
    run_score,
    sample_message,
    send,
    trip_message,
)

from tripwright.plans import fixtures as fx
from tripwright.plans import score
from tripwright.streaming import score as app

LATER = "b88e7700-6863-11e8-96b3-bf7af28e956c"


def results(spark, base):
    return app.current_results(spark, f"{base}/gold", "vehicle_stat", "vehicle_id")


@pytest.mark.parametrize("parts", [1, 3])
def test_batches_of_trips_equal_the_whole(spark, sf_dir, tmp_path, parts):
    base = str(tmp_path)
    send(spark, f"{base}/topic", fx.messages(spark, sf_dir).where("key != 'sf-trip'"), "all")
    run_ingest(spark, base)
    trips = fx.trip_messages(spark, sf_dir)
    for part in range(parts):
        some = trips.where(f"pmod(hash(value), {parts}) = {part}")
        send(spark, f"{base}/score", some.selectExpr("'sf-score' AS key", "value"), f"p{part}")
    run_score(spark, base, app.start_vehicle_score)
    tables = fx.scored_trips(spark, sf_dir), fx.stored_microtrips(spark, sf_dir), fx.stored_events(spark, sf_dir)
    wanted = score.multi_trip_score(*tables)
    assert rows_of(results(spark, base).select(*wanted.columns)) == rows_of(wanted)


def test_a_batch_reads_its_own_trips_only(spark, tmp_path):
    base = str(tmp_path)
    end = START + 50_000
    second = START + 200_000
    rows = [sample_message(i) for i in range(8)] + [trip_message(end=end)]
    send(spark, f"{base}/topic", rows, "a")
    run_ingest(spark, base)
    run_score(spark, base, app.start_vehicle_score)
    (one,) = results(spark, base).collect()
    assert (one.trip_id, one.mtrip_cnt) == (TRIP, 8)

    # Two late samples of the first trip are not read with the second one, but with the first.
    rows = [sample_message(i) for i in (8, 9)] + [sample_message(i + 100, LATER) for i in range(4)]
    send(spark, f"{base}/topic", [*rows, trip_message(LATER, start=second, end=second + 50_000)], "b")
    run_ingest(spark, base)
    run_score(spark, base, app.start_vehicle_score)
    (two,) = results(spark, base).collect()
    assert (two.trip_id, two.mtrip_cnt) == (TRIP, 12)
    assert two.distance > one.distance
    send(spark, f"{base}/topic", [trip_message(end=end)], "c")
    run_ingest(spark, base)
    run_score(spark, base, app.start_vehicle_score)
    (three,) = results(spark, base).collect()
    assert (three.mtrip_cnt, three.batch_id) == (14, 2)

    # The first trip ends before its samples now: nothing of it is left but the trip after it.
    send(spark, f"{base}/topic", [trip_message(start=START - 9000, end=START - 8000)], "d")
    run_ingest(spark, base)
    run_score(spark, base, app.start_vehicle_score)
    (four,) = results(spark, base).collect()
    assert (four.trip_id, four.mtrip_cnt) == (LATER, 4)


def test_trips_that_interleave(spark, tmp_path):
    """The second trip lies inside the first; their samples are taken in order of time, each trip's."""
    base = str(tmp_path)
    send(spark, f"{base}/topic", [sample_message(i) for i in range(20)] + [trip_message()], "a")
    run_ingest(spark, base)
    run_score(spark, base, app.start_vehicle_score)
    send(spark, f"{base}/topic", [trip_message(LATER, start=START + 9000, end=START + 19_000)], "b")
    run_ingest(spark, base)
    run_score(spark, base, app.start_vehicle_score)
    run_score(spark, base, app.start_multi_score)
    wanted = app.current_results(spark, f"{base}/gold", "ms_trip_stat", "vehicle_id").drop("batch_id")
    assert rows_of(results(spark, base).select(*wanted.columns)) == rows_of(wanted)
    assert wanted.first().mtrip_cnt == 25
