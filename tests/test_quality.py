"""Assertions find what was planted."""

from conftest import BASE, frame, row

from railpulse.operators import quality
from railpulse.operators.difference import table_difference, warehouse_difference
from railpulse.operators.staging import shape


def test_row_assertions_find_planted_violations(spark):
    staged = shape(frame(spark, [
        row("t", "1N", BASE, BASE, feed="bus"), row(None, "2N", BASE, BASE, fetched_at=BASE + 601),
        row("u", "3N", BASE, BASE, start_date=None, schedule_relationship="LATE", fetched_at=BASE - 61),
        row("v", "4N", BASE, BASE, fetched_at=BASE + 600),
    ]))
    report = quality.row_report({"stg_stop_time_updates": staged}, quality.row_checks())
    found = {(r.check_kind, r.column_name): r.violations for r in report.collect() if r.violations}
    assert found == {("accepted_values", "feed_id"): 1, ("not_null", "trip_id"): 1, ("not_null", "service_date_raw"): 1,
                     ("accepted_values", "schedule_relationship"): 1, ("feed_lag", "feed_lag_seconds"): 2}


def test_conditions_on_one_column(spark):
    df = spark.createDataFrame([(0.4, True, None), (0.5, True, "x"), (60.0, False, None), (60.1, True, "y"), (None, True, "z")],
                               "h double, is_published boolean, name string")
    count = lambda condition: quality.violations(df, condition).count()
    assert count(quality.is_outside("h", 0.5, 60)) == 2
    assert count(quality.is_missing("name")) == 2
    assert count(quality.is_missing("name", "is_published")) == 1
    assert count(quality.is_unaccepted("name", ["x", "y"])) == 1


def test_keys_and_orphans(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2)], "k string, n int")
    assert [(r.k, r.records) for r in quality.repeated_values(df, "k").collect()] == [("a", 2)]
    assert quality.repeated_keys(df, ["k", "n"]).count() == 2
    parent = spark.createDataFrame([("b",), ("b",)], "id string")
    assert [tuple(r) for r in quality.orphans(df, "k", parent, "id").collect()] == [("a", 2)]


def test_differences_as_sets_and_as_bags(spark):
    left = spark.createDataFrame([("a", 0.1 + 0.2), ("a", 0.3), ("b", 1.0), (None, None)], "k string, v double")
    right = spark.createDataFrame([("a", 0.3), ("c", 1.0), (None, None)], "k string, v double")
    assert {r.k for r in table_difference(left, right).collect()} == {"b", "c"}
    assert {r.k for r in table_difference(left, right, duplicates=True).collect()} == {"a", "b", "c"}
    report = warehouse_difference({"t": left}, {"t": right}).first()
    assert (report.only_left, report.only_right) == (1, 1)
    bags = warehouse_difference({"t": left}, {"t": right}, duplicates=True).first()
    assert (bags.only_left, bags.only_right) == (2, 1)
