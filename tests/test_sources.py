"""Files in and out."""

import json
from datetime import date

import pytest
from conftest import BASE, frame, row, watched_platform

from railpulse.schema import LANDING_COLUMNS, ROUTE_COLUMNS, STOP_COLUMNS
from railpulse.sources import history, landing, reference_files

DAY = 86_400


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    rows = [row("t", "1N", BASE + 60, BASE), row("u", "2N", None, BASE + DAY, start_date=None),
            row("v", "3N", BASE + 60, BASE - 6 * 3600)]  # 03:00Z is still the day before in New York
    landing.write_landing(frame(spark, rows), root)
    return root, rows


def test_landing_comes_back_as_written(spark, zone):
    root, rows = zone
    found = landing.read_landing(spark, root)
    assert sorted(found.select(*LANDING_COLUMNS).collect(), key=str) == sorted(frame(spark, rows).collect(), key=str)
    assert sorted((str(r.dt), r.hour) for r in found.collect()) == [
        ("2026-06-16", 23), ("2026-06-17", 5), ("2026-06-18", 5)]


def test_a_cutoff_skips_directories(spark, zone):
    recent = landing.landed_since(landing.read_landing(spark, zone[0]), BASE + DAY)
    assert [r.trip_id for r in recent.collect()] == ["u"]
    plan = recent._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "(dt#" in plan
    assert landing.landed_since(landing.read_landing(spark, zone[0]), None).count() == 3


def test_a_malformed_row_fails_the_read(spark, tmp_path):
    folder = tmp_path / "dt=2026-06-17" / "hour=10"
    folder.mkdir(parents=True)
    import gzip
    with gzip.open(folder / "ace-1.ndjson.gz", "wt") as file:
        file.write('{"feed_id": "ace", "observed_at": "not a number"}\n')
    (folder / "ace-2.ndjson.tmp").write_text("half a fi")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        landing.read_landing(spark, str(tmp_path)).select("observed_at").collect()


def test_the_plan_lists_files_and_bytes(spark, zone):
    plan = {r.day: r for r in history.load_plan(spark, zone[0]).collect()}
    assert sorted(plan) == ["2026-06-16", "2026-06-17", "2026-06-18"]
    assert all(r.files == 1 and r.bytes > 0 for r in plan.values())
    assert [r.day for r in history.load_plan(spark, zone[0], "2026-06-17").collect()] == ["2026-06-17"]
    with pytest.raises(ValueError):
        history.load_plan(spark, zone[0], "10 March")


def test_days_are_replaced_one_by_one(spark, zone, tmp_path):
    path, rows = str(tmp_path / "history"), frame(spark, zone[1])
    history.replace_days(rows, path)
    history.replace_days(rows, path)
    assert history.read_history(spark, path, date(2026, 6, 1)).count() == 3
    # Both rows of 10 March by UTC become one, 11 March stays.
    history.replace_days(rows.where("trip_id <> 'v'"), path, date(2026, 6, 17))
    left = history.read_history(spark, path, last=date(2026, 6, 30))
    assert sorted(r.trip_id for r in left.collect()) == ["t", "u"]
    with pytest.raises(ValueError, match="first or a last day"):
        history.read_history(spark, path)


def test_reference_lists_keep_what_is_published(spark, tmp_path):
    published = tmp_path / "routes.txt"
    published.write_text("agency_id,route_id,route_long_name,route_color\nX,01,First,\nX,A,Eighth,0062CF\n")
    rows = reference_files.read_published(spark, str(published), ROUTE_COLUMNS)
    assert rows.columns == ["route_id", "route_long_name", "route_color"]
    assert sorted(map(tuple, rows.collect())) == [("01", "First", ""), ("A", "Eighth", "0062CF")]
    with pytest.raises(ValueError, match="empty"):
        reference_files.project_published(rows.where("false"), ROUTE_COLUMNS)


def test_stop_lists_round_trip_as_strings(spark, tmp_path):
    rows = spark.createDataFrame([("007", "Bond, St", "40.70", "-73.9", "1", "")], list(STOP_COLUMNS))
    reference_files.write_reference(rows, str(tmp_path / "stops"))
    found = reference_files.read_stops(spark, str(tmp_path / "stops")).na.fill("")
    assert found.columns == list(STOP_COLUMNS) and tuple(found.first()) == tuple(rows.first())


def test_weather_arrays_become_hours(spark, tmp_path):
    (tmp_path / "w.json").write_text(json.dumps({"latitude": 40.8, "hourly": {
        "time": ["2026-03-08T01:00", "2026-03-08T02:00", "2026-03-08T03:00"], "precipitation": [0.0, 1.5, None],
        "temperature_2m": [3.0, 2.5, 2.0], "wind_speed_10m": [10.0, 11.0, 12.0]}}, indent=1))
    rows = reference_files.read_weather(spark, str(tmp_path / "w.json")).orderBy("service_hour").collect()
    # A wall-clock hour that the clocks skip is kept as written.
    assert [(str(r.service_hour)[11:13], r.precip_mm, r.is_wet) for r in rows] == [
        ("01", 0.0, False), ("02", 1.5, True), ("03", None, False)]
