"""From landing files to the marts, on a platform whose answers are worked by hand."""

import pytest
from conftest import BASE, frame, row, watched_platform

from railpulse.operators import quality
from railpulse.operators.arrivals import fct_arrivals, infer_arrivals
from railpulse.operators.sightings import last_sightings
from railpulse.operators.staging import stage
from railpulse.plans.warehouse import Warehouse
from railpulse.sources.landing import read_landing, write_landing

STOPS = "stop_id string, stop_name string, stop_lat string, stop_lon string, location_type string, parent_station string"
ROUTES = ("route_id string, route_short_name string, route_long_name string, route_desc string, "
          "route_color string, route_text_color string")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    write_landing(frame(spark, watched_platform()), str(folder / "landing"))
    warehouse = Warehouse(spark, str(folder / "warehouse"))
    stops = spark.createDataFrame([
        ("R30", "Thirtieth", "40.75", "-73.98", "1", ""), ("R30N", "Thirtieth", "40.75", "-73.98", "", "R30"),
        ("R30S", "Thirtieth", "40.75", "-73.98", "", "R30"), ("R99", "Ninety-ninth", "bad", "", "1", ""),
    ], STOPS)
    routes = spark.createDataFrame([
        ("Q", "Q", "Broadway", "", "FCCC0A", ""), ("Z", "Z", "Never seen", "", None, "FFFFFF"),
    ], ROUTES)
    warehouse.rebuild(read_landing(spark, str(folder / "landing")), stops, routes)
    return warehouse


def test_a_train_that_arrives_is_an_arrival(built):
    found = built.fact("fct_arrivals").where("stop_id = 'R14S'").collect()
    assert [r.trip_id for r in found] == ["early"]
    assert found[0].lead_seconds == 10 and found[0].observations_of_pair == 11


def test_the_arrival_is_the_last_prediction(built):
    found = built.fact("fct_arrivals").where("trip_id = 'early'").selectExpr(
        "unix_seconds(inferred_arrival) as at", "unix_seconds(last_seen_at) as seen",
        "cast(arrival_local as string) as local", "hour_of_day", "day_of_week").first()
    assert (found.at, found.seen) == (BASE + 210, BASE + 200)
    assert (found.local, found.hour_of_day, found.day_of_week) == ("2026-06-17 05:03:30", 5, 3)


@pytest.mark.parametrize("trip", ["taken-off", "far-out"])
def test_pulled_and_pending_trains_are_not_arrivals(built, trip):
    assert built.fact("fct_arrivals").where(f"trip_id = '{trip}'").isEmpty()


def test_headways_are_gaps_between_consecutive_trains(built):
    gaps = built.fact("fct_headways").where("stop_id = 'R30S'").orderBy("inferred_arrival")
    assert [r.headway_minutes for r in gaps.collect()] == [5.0, 7.0, 11.0, 5.0]


def test_excess_wait_is_the_hand_worked_figure(built):
    wait = built.fact("fct_excess_wait").where("stop_id = 'R30S'").first()
    assert wait.headways == 4
    assert wait.mean_headway_minutes == pytest.approx(7)
    assert wait.rider_wait_minutes == pytest.approx(220 / 56)
    assert wait.even_wait_minutes == pytest.approx(3.5)
    assert wait.excess_wait_minutes == pytest.approx(3 / 7)


def test_even_service_has_no_excess_wait(spark):
    from railpulse.operators.headways import excess_wait, headways
    rows = [row(f"t{i}", "X1N", BASE + i * 600, BASE + i * 600) for i in range(5)]
    rows.append(row("last", "X2N", BASE + 9000, BASE + 6000))
    arrived = fct_arrivals(infer_arrivals(last_sightings(stage(frame(spark, rows)))))
    assert excess_wait(headways(arrived)).first().excess_wait_minutes == pytest.approx(0, abs=1e-12)


def test_unpublished_stations_are_kept_and_flagged(built):
    stations = {r.station_id: r for r in built.dimension("dim_stations").collect()}
    assert not stations["R14"].is_published and stations["R14"].station_name is None
    assert stations["R30"].is_published and stations["R30"].platform_count == 2
    assert stations["R99"].latitude is None and stations["R99"].observations == 0
    assert quality.orphans(
        built.fact("fct_arrivals"), "station_id", built.dimension("dim_stations"), "station_id"
    ).isEmpty()


def test_routes_keep_the_published_ones(built):
    routes = {r.route_id: r for r in built.dimension("dim_routes").collect()}
    assert routes["Q"].route_color == "#FCCC0A" and routes["Q"].route_text_color is None
    assert routes["Q"].trips_observed == 8 and routes["Q"].feed_id == "nqrw"
    assert routes["Z"].trips_observed == 0 and routes["Z"].first_observed_at is None


def test_every_assertion_holds_but_for_the_unreadable_position(built):
    """The stop list publishes R99 with a position that is no number."""
    report = quality.quality_report(built.tables())
    assert report.count() == 59
    found = {(r.table_name, r.column_name): r.violations for r in report.where("violations > 0").collect()}
    assert found == {("dim_stations", "latitude"): 1, ("dim_stations", "longitude"): 1}


def test_tables_answer_sql_by_name(spark, built):
    built.register_views()
    assert spark.sql("""select count(*) as n from fct_arrivals a
        join dim_stations s using (station_id) where not s.is_published""").first().n == 1


def test_a_skipped_stop_counts_as_gone_after_its_last_prediction(spark):
    rows = [
        row("t", "X1N", BASE + 40, BASE), row("t", "X1N", BASE + 45, BASE + 30),
        row("t", "X1N", BASE + 45, BASE + 60, schedule_relationship="SKIPPED"),
    ]
    seen = last_sightings(stage(frame(spark, rows))).first()
    assert seen.has_vanished and seen.observations_of_pair == 2 and seen.lead_seconds == 15


def test_the_earliest_fetch_of_an_observation_is_kept(spark):
    rows = [
        row("t", "X1N", BASE + 99, BASE, fetched_at=BASE + 60),
        row("t", "X1N", BASE + 40, BASE, fetched_at=BASE + 3),
        row("t", "X1N", BASE + 50, BASE, fetched_at=None),
    ]
    kept = stage(frame(spark, rows)).selectExpr("unix_seconds(predicted_arrival) as at").collect()
    assert [r.at for r in kept] == [BASE + 40]
