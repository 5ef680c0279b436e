"""The progress table: what an update reads, what a stopped run leaves, and cutoffs by feed."""

from pathlib import Path

import pytest
from conftest import BASE, arrivals_of, frame, row
from test_incremental import AN_HOUR, NO_OVERLAP, different, rebuilt

from railpulse.plans import warehouse as module
from railpulse.plans.warehouse import Warehouse

DAY = 86_400


def seen(feed, trip, second, ahead=20):
    return row(trip, "K01S", BASE + second + ahead, BASE + second, feed_id=feed)


def spoil(warehouse, kept_days):
    """Make the files of all other days unreadable; returns how many days that were."""
    spoilt = 0
    for folder in Path(warehouse.root, "stg_stop_time_updates").glob("observed_date=*"):
        if folder.name.split("=")[1] not in kept_days:
            spoilt += 1
            for file in folder.glob("*.parquet"):
                file.write_bytes(b"not parquet")
                Path(folder, f".{file.name}.crc").unlink(missing_ok=True)
    return spoilt


def days_of(spark, *seconds):
    return {str(r[0]) for r in spark.sql(
        "select to_date(timestamp_seconds(s)) from values " + ", ".join(f"({BASE + s})" for s in seconds) + " as t(s)"
    ).collect()}


def test_an_update_opens_no_file_of_the_history(spark, tmp_path):
    """Two months of one feed, then one that fell silent after the first day: neither is read again."""
    history = [seen("busy", f"b{d}", d * DAY) for d in range(0, 60, 5)] + [seen("quiet", "q", 0), seen("quiet", "q2", 30)]
    new = [seen("busy", "late", 56 * DAY)]
    warehouse = Warehouse(spark, str(tmp_path / "parts"), AN_HOUR)
    warehouse.rebuild(frame(spark, history))
    assert spoil(warehouse, days_of(spark, 55 * DAY)) == 11
    warehouse.update_observations(frame(spark, new), any_age=True)
    warehouse.update_sightings()
    assert arrivals_of(rebuilt(spark, tmp_path / "whole", history + new, AN_HOUR), "b55") == 1
    assert warehouse.sightings().where("trip_id in ('b55', 'late')").count() == 2
    assert warehouse.sightings().where("trip_id = 'b55' and has_vanished").count() == 1
    assert warehouse.sightings().where("trip_id = 'q2' and not has_vanished").count() == 1


def test_a_stream_batch_opens_no_file_of_the_history(spark, tmp_path):
    history = [seen("busy", f"b{d}", d * DAY) for d in range(10)]
    warehouse = Warehouse(spark, str(tmp_path), NO_OVERLAP)
    warehouse.rebuild(frame(spark, history))
    spoil(warehouse, days_of(spark, 9 * DAY))
    batch = frame(spark, [seen("busy", "x", 9 * DAY + 40)])
    warehouse.update_sightings(warehouse.update_observations(batch, any_age=True))
    assert warehouse.sightings().where("trip_id = 'b9' and has_vanished").count() == 1


def test_a_feed_that_is_back_reads_the_days_it_was_seen(spark, tmp_path):
    history = [seen("busy", f"b{d}", d * DAY) for d in range(20)] + [seen("quiet", "q", 0)]
    new = [seen("quiet", "q", 19 * DAY + 60), seen("quiet", "r", 19 * DAY + 90)]
    warehouse = Warehouse(spark, str(tmp_path / "parts"), NO_OVERLAP)
    warehouse.rebuild(frame(spark, history))
    assert spoil(warehouse, days_of(spark, 0, 19 * DAY)) == 18
    warehouse.update_observations(frame(spark, new))
    warehouse.update_sightings()
    whole = rebuilt(spark, tmp_path / "whole", history + new)
    columns = "trip_id, observations_of_pair, last_seen_at, has_vanished"
    pick = lambda w: sorted(w.sightings().selectExpr(*columns.split(", ")).collect())
    assert pick(warehouse) == pick(whole)


@pytest.mark.parametrize("at", ["_write_changes", "staged", "sighted"])
def test_a_run_stopped_anywhere_is_taken_up(spark, tmp_path, monkeypatch, at):
    first = [seen("a", f"t{k}", 60 * k) for k in range(5)] + [seen("b", "u", 0)]
    second = [seen("a", "t4", 300), seen("b", "u", 3000), seen("b", "v", 3000)]
    third = [seen("a", "w", 4000)]
    warehouse = Warehouse(spark, str(tmp_path / "parts"), AN_HOUR)
    warehouse.update(frame(spark, first))

    class Stopped(RuntimeError):
        pass

    def stop(self, *rows):
        if at == "_write_changes":
            plain(self, *rows)
        raise Stopped

    owner = module.Warehouse if at == "_write_changes" else module.Progress
    plain = getattr(owner, at)
    with monkeypatch.context() as patched, pytest.raises(Stopped):
        patched.setattr(owner, at, stop)
        warehouse.update(frame(spark, first + second))
    # The next run is only given what is newer.
    Warehouse(spark, warehouse.root, AN_HOUR).update(frame(spark, third))
    assert different(warehouse, rebuilt(spark, tmp_path / "whole", first + second + third)) == {}


def test_the_cutoff_of_each_feed(spark, tmp_path):
    first = [seen("fast", "f", 5 * 3600), seen("slow", "s", 0)]
    late = [seen("slow", "s2", 1800), seen("new", "n", 60), seen("fast", "too-late", 1800)]
    landed = first + late
    by_all, by_feed = (Warehouse(spark, str(tmp_path / n), AN_HOUR) for n in ("all", "feed"))
    for warehouse, per_feed in ((by_all, False), (by_feed, True)):
        warehouse.update(frame(spark, first))
        warehouse.update(frame(spark, landed), per_feed=per_feed)
    trips = lambda w: {r[0] for r in w.staged().select("trip_id").collect()}
    assert trips(by_all) == {"f", "s"}
    assert trips(by_feed) == {"f", "s", "s2", "n"}


STOPS = "stop_id string, stop_name string, stop_lat string, stop_lon string, location_type string, parent_station string"
ROUTES = ("route_id string, route_short_name string, route_long_name string, route_desc string, "
          "route_color string, route_text_color string")


def test_dimensions_follow_without_the_lists_and_without_the_history(spark, tmp_path):
    stops = spark.createDataFrame([("K01", "Kay", "1", "2", "1", ""), ("K09", "Nine", "1", "2", "1", "")], STOPS)
    routes = spark.createDataFrame([("Q", "Q", "Quick", "", "", ""), ("Z", "Z", "None", "", "", "")], ROUTES)
    history = [seen("a", f"t{d}", d * DAY) for d in range(6)]
    # A row of the newest day is replaced by an earlier fetch that says another route.
    new = [
        row("t5", "K01S", BASE + 5 * DAY + 20, BASE + 5 * DAY, route="Z", feed_id="a", fetched_at=BASE + 5 * DAY + 1),
        row("n", "M07N", BASE + 5 * DAY + 90, BASE + 5 * DAY + 50, feed_id="a"),
    ]
    warehouse = Warehouse(spark, str(tmp_path / "parts"), AN_HOUR)
    warehouse.rebuild(frame(spark, history), stops, routes)
    spoil(warehouse, days_of(spark, 5 * DAY))
    warehouse.update(frame(spark, new))
    whole = Warehouse(spark, str(tmp_path / "whole"), AN_HOUR)
    whole.rebuild(frame(spark, history + new), stops, routes)
    for name in ("dim_stations", "dim_routes"):
        assert sorted(warehouse.dimension(name).collect(), key=str) == sorted(whole.dimension(name).collect(), key=str)
    assert {r.route_id: r.trips_observed for r in warehouse.dimension("dim_routes").collect()} == {"Q": 6, "Z": 1}
    warehouse.register_views()
    assert spark.sql("select count(*) from dim_stations").first()[0] == 3


def test_views_without_lists(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), AN_HOUR)
    warehouse.rebuild(frame(spark, [seen("a", "t", 0)]))
    warehouse.register_views()
    assert "dim_stations" not in warehouse.tables()


def test_nothing_intermediate_is_left(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), AN_HOUR)
    warehouse.update(frame(spark, [seen("a", "t", 0)]))
    warehouse.update(frame(spark, [seen("a", "t", 0), seen("a", "t", 60)]))
    assert not list(Path(tmp_path, "_work").glob("*"))
