"""Facts are kept by service date: a run writes the dates it changed and leaves the files of the others."""

import pytest
from conftest import BASE, arrivals_of, frame, row
from test_incremental import NO_OVERLAP, different, rebuilt

from railpulse.params import Params
from railpulse.plans import stale, tables
from railpulse.plans.warehouse import FACTS, Warehouse

DAY = 86_400
DATES = ("20260617", "20260618", None)


def trains(number):
    """Trains five minutes apart on the service date of that number, seen and then gone."""
    at = BASE + number * DAY
    rows = [
        row(name, "R30S", at + 300 * i + 20, at + 300 * i, start_date=DATES[number]) for i, name in enumerate("abc")
    ]
    return rows + [row("last", "R99S", at + 9000, at + 3000, start_date=DATES[number])]


def one_more():
    """A train of the second date, after all others."""
    at = BASE + DAY
    return [
        row("d", "R30S", at + 3320, at + 3300, start_date=DATES[1]),
        row("last", "R99S", at + 9000, at + 3600, start_date=DATES[1]),
    ]


def files(warehouse):
    """Per fact and service date, the files it lies in."""
    found = {}
    for name in FACTS:
        stored = warehouse._stored_fact(name).selectExpr("service_date_raw", "_metadata.file_path as path").distinct()
        for r in stored.collect():
            found.setdefault((name, r["service_date_raw"]), set()).add(r["path"])
    return found


@pytest.fixture
def two_dates(spark, tmp_path):
    # The root has a blank: folders are removed by what file metadata calls them.
    warehouse = Warehouse(spark, str(tmp_path / "the warehouse"), NO_OVERLAP)
    landed = trains(0) + trains(1)
    warehouse.update(frame(spark, landed))
    return warehouse, landed


def test_untouched_dates_keep_their_files(spark, tmp_path, two_dates):
    warehouse, landed = two_dates
    before = files(warehouse)
    landed = landed + one_more()
    warehouse.update(frame(spark, landed))
    after = files(warehouse)
    for name in FACTS:
        assert after[name, DATES[0]] == before[name, DATES[0]]
        assert after[name, DATES[1]] != before[name, DATES[1]]
    assert different(warehouse, rebuilt(spark, tmp_path / "whole", landed, NO_OVERLAP)) == {}
    assert warehouse.fact("fct_headways").where("service_date_raw = '20260618'").count() == 3


def test_a_run_without_news_writes_no_fact(spark, two_dates):
    warehouse, landed = two_dates
    warehouse.update(frame(spark, landed))
    before = files(warehouse)
    warehouse.update(frame(spark, landed))
    assert files(warehouse) == before and stale.noted(spark, warehouse.root) is None


def test_a_date_that_loses_its_last_fact_goes(spark, tmp_path, two_dates):
    """All trains of a date turn up again, far from their platforms."""
    warehouse, landed = two_dates
    at = BASE + DAY + 4000
    back = [row(n, "R30S", at + 9000, at, start_date=DATES[0]) for n in "abc"]
    landed = landed + back
    assert arrivals_of(warehouse, "a") == 2
    warehouse.update(frame(spark, landed))
    assert {date for _, date in files(warehouse)} == {DATES[1]}
    assert different(warehouse, rebuilt(spark, tmp_path / "whole", landed, NO_OVERLAP)) == {}


def test_rows_without_a_service_date(spark, tmp_path, two_dates):
    warehouse, landed = two_dates
    before = files(warehouse)
    landed = landed + trains(2)
    warehouse.update(frame(spark, landed))
    after = files(warehouse)
    assert ("fct_arrivals", None) in after and after["fct_arrivals", DATES[0]] == before["fct_arrivals", DATES[0]]
    assert different(warehouse, rebuilt(spark, tmp_path / "whole", landed, NO_OVERLAP)) == {}


def test_other_thresholds_write_every_date(spark, tmp_path, two_dates):
    warehouse, landed = two_dates
    narrow = Params(max_headway_minutes=4, incremental_lookback_hours=0)
    changed = Warehouse(spark, warehouse.root, narrow)
    changed.update(frame(spark, landed))
    assert changed.fact("fct_headways").isEmpty()
    assert different(changed, rebuilt(spark, tmp_path / "whole", landed, narrow)) == {}


@pytest.mark.parametrize("stop_at", ["int_last_sightings", "fct_headways"])
def test_a_run_stopped_at_any_table_heals(spark, tmp_path, two_dates, monkeypatch, stop_at):
    warehouse, landed = two_dates
    landed = landed + one_more()
    write = tables.replace_partitions

    def stopping(df, path, by):
        if path.endswith(stop_at):
            raise RuntimeError("stopped")
        write(df, path, by)

    monkeypatch.setattr(tables, "replace_partitions", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        warehouse.update(frame(spark, landed))
    assert stale.noted(spark, warehouse.root) is not None
    monkeypatch.undo()
    Warehouse(spark, warehouse.root, NO_OVERLAP).update(frame(spark, landed))
    assert stale.noted(spark, warehouse.root) is None
    assert different(warehouse, rebuilt(spark, tmp_path / "whole", landed, NO_OVERLAP)) == {}


def test_a_whole_build_that_was_stopped_is_followed_by_a_whole_one(spark, tmp_path, two_dates, monkeypatch):
    warehouse, landed = two_dates
    write = tables.overwrite

    def stopping(df, path, by=None):
        if path.endswith("fct_headways"):
            raise RuntimeError("stopped")
        write(df, path, by)

    monkeypatch.setattr(tables, "overwrite", stopping)
    with pytest.raises(RuntimeError, match="stopped"):
        warehouse.rebuild(frame(spark, landed + trains(2)))
    monkeypatch.undo()
    assert not stale.built_with(spark, warehouse.root, NO_OVERLAP)
    warehouse.update(frame(spark, landed + trains(2)))
    assert different(warehouse, rebuilt(spark, tmp_path / "whole", landed + trains(2), NO_OVERLAP)) == {}
