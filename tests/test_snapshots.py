"""Nested messages: flattening, repeats, and what is in one."""

from railpulse.operators import snapshots, trace
from railpulse.schema import SNAPSHOT_SCHEMA

from conftest import BASE, frame, row


def stop(stop_id, arrival, departure=0, relationship=0, ext=("1", "2")):
    return (stop_id, (arrival,), (departure,), relationship, ext)


def trip_entity(name, trip_id, stops, ext=("train", True, 1)):
    return (name, ((trip_id, "A", "20260310", ext), stops), None, None)


def message(header, fetched, entities=(), feed="ace"):
    return (feed, float(fetched), (header,), list(entities))


def test_flatten_carries_the_tree_down(spark):
    found = snapshots.flatten(spark.createDataFrame([message(BASE, BASE + 3.9, [
        trip_entity("1", "t1", [stop("127N", BASE + 60), stop("", 0, BASE + 90, 9, ("", "")), stop("129N", 5, 5, 1, None)],
                    ("", False, 7)),
        trip_entity("2", "", [stop("R65N", BASE + 70)], None),
        ("3", None, ("127N",), None),
        ("4", None, None, ("delays",)),
        trip_entity("5", "t5", []),
    ])], SNAPSHOT_SCHEMA)).collect()
    by_position = {(r.trip_id, r.stop_sequence): r for r in found}
    assert sorted(by_position, key=str) == sorted([("t1", 0), ("t1", 1), ("t1", 2), (None, 0)], key=str)
    first, second, third, bare = (by_position[k] for k in [("t1", 0), ("t1", 1), ("t1", 2), (None, 0)])
    assert (first.observed_at, first.fetched_at, first.direction, first.train_id) == (BASE, BASE + 3, None, None)
    assert (first.predicted_arrival, first.predicted_departure, first.actual_track) == (BASE + 60, None, "2")
    assert (second.stop_id, second.predicted_arrival, second.schedule_relationship) == (None, None, "SCHEDULED")
    assert (second.scheduled_track, third.scheduled_track, third.schedule_relationship) == (None, None, "SKIPPED")
    assert (bare.is_assigned, bare.direction) == (None, None)


def test_only_consecutive_repeats_are_dropped(spark):
    day = 86_400
    headers = [BASE, BASE, BASE + 30, BASE, BASE, 0, BASE]
    rows = [message(h, BASE + 10 * n) for n, h in enumerate(headers)]
    rows += [message(BASE, BASE + day), message(BASE + 9, BASE + day + 5), message(BASE, BASE + 5, feed="g")]
    kept = snapshots.suppress_repeats(spark.createDataFrame(rows, SNAPSHOT_SCHEMA))
    assert sorted((r.feed_id, r.fetched_at - BASE) for r in kept.collect()) == [
        ("ace", 0.0), ("ace", 20.0), ("ace", 30.0), ("ace", day + 5.0), ("g", 5.0)]


def test_rows_of_one_fetch_and_header_leave_one(spark):
    rows = [message(BASE, BASE + 1, [trip_entity(str(n % 2), "t", [stop("1N", BASE)])]) for n in range(6)]
    rows += [message(BASE + 30, BASE + 31), message(BASE + 30, BASE + 31, feed=None)]
    found = snapshots.suppress_repeats(spark.createDataFrame(rows, SNAPSHOT_SCHEMA))
    kept = found.collect()
    assert sorted((r.feed_id or "", r.fetched_at - BASE) for r in kept) == [("", 31.0), ("ace", 1.0), ("ace", 31.0)]
    assert found.columns == SNAPSHOT_SCHEMA.fieldNames()


def test_messages_are_read_once_and_not_sorted(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "snapshots")
    spark.createDataFrame([message(BASE + n, BASE + n) for n in range(20)], SNAPSHOT_SCHEMA).write.parquet(path)
    stored = spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)
    plan = snapshots.changed_headers(stored)._jdf.queryExecution().executedPlan().toString()
    assert "entity" not in plan
    for many in (False, True):
        if many:
            monkeypatch.setattr(snapshots, "measured", lambda df: None)
        plan = snapshots.suppress_repeats(stored)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line and "entity" in line.split("ReadSchema")[1]]
        assert len(scans) == 1
        assert not [line for line in plan.splitlines() if "Sort [" in line and "entity" in line]


def test_profile_shows_the_first_of_the_longest_trips(spark):
    rows = [message(BASE, BASE + 4.2, [
        trip_entity("1", "000100_A", [stop("1N", BASE)]),
        trip_entity("2", "064750_A", [stop(f"{i}N", BASE + i, ext=("3", "")) for i in range(7)]),
        trip_entity("3", "later", [stop(f"{i}S", BASE) for i in range(7)]),
        ("4", None, ("1N",), ("both",)), ("5", None, None, ("alert",)),
    ]), message(BASE, BASE, [])]
    found = {r.entities: r for r in snapshots.snapshot_profile(spark.createDataFrame(rows, SNAPSHOT_SCHEMA)).collect()}
    busy, empty = found[5], found[0]
    assert (busy.age_seconds, busy.trip_updates, busy.vehicles, busy.alerts) == (4, 3, 1, 1)
    assert (busy.trip_id, busy.origin, busy.stops_remaining, busy.direction) == ("064750_A", "10:47", 7, "NORTH")
    assert busy.next_stops.split("; ")[0] == "0N 05:00:00 (none) 3" and busy.next_stops.count(";") == 4
    assert (empty.trip_id, empty.direction, empty.stops_remaining) == (None, None, None)


def test_a_prediction_converges_and_vanishes(spark):
    rows = frame(spark, [
        row("t", "1N", BASE + 50, BASE), row("t", "2N", BASE + 150, BASE, stop_sequence=1),
        row("t", "2N", BASE + 140, BASE + 60), row("u", "1N", BASE + 90, BASE),
        row("t", "3N", None, BASE + 60),
    ])
    states = {(r.trip_id, r.stop_id): (r.state, r.arrival_clock, r.polls) for r in trace.prediction_trace(rows).collect()}
    assert states == {("t", "1N"): ("passed", "05:00:50", 1), ("t", "2N"): ("still ahead", "05:02:20", 2),
                      ("u", "1N"): ("passed", "05:01:30", 1)}
    matrix = trace.trace_matrix(rows, trace.busiest_trips(rows), 2).orderBy("observed_at").collect()
    assert [(r.trip_id, r.feed_time, r.stop_1, r.stop_2) for r in matrix] == [
        ("t", "00:00", "00:50", "02:30"), ("t", "01:00", None, "02:20")]
