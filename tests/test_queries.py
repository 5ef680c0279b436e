"""Registered queries against their SQL in another engine, on the sample tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="sample tables are not here")

# The rest differ only in what they are composed of; all of them are compared
# outside the unit tests.
COMPARED = ["identifier_functions", "clock_functions", "last_sightings", "fct_excess_wait", "dim_stations",
            "dim_routes", "touched_pairs", "snapshots_to_landing", "weather_rows", "prediction_trace",
            "stream_snapshots", "incremental_fact_dates"]


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for name in ("events", "nation", "region"):
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return str(value)
    return f"{float(value):.6f}"


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, engine, name):
    df = entry_points.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    answer = engine.execute(entry_points.oracle_sql()[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == columns
    expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in answer.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == expected


def test_every_query_is_checked_but_one():
    own = set(entry_points.registered())
    assert own - set(entry_points.oracle()) == {"load_plan"}
    assert own <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
