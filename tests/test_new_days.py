"""Days that hold nothing take in their rows without a join to what is held."""

from conftest import BASE, frame, row

from railpulse.operators.difference import warehouse_difference
from railpulse.plans import tables as t
from railpulse.plans.warehouse import Warehouse

DAY = 86_400


def test_rows_of_new_days_are_not_looked_for(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "grown"))
    first = [row("a", "S", BASE + 600, BASE), row("b", "S", BASE + 30 + 600, BASE + 30)]
    later = [row("a", "S", BASE + 2 * DAY + 600, BASE + 2 * DAY), row("c", "S", BASE + 3 * DAY + 600, BASE + 3 * DAY)]
    warehouse.update_observations(frame(spark, first), any_age=True)
    warehouse.update_observations(frame(spark, later), any_age=True)
    assert t.read_table(spark, warehouse._work("changes"), None) is None

    # Some days held and some not, a row that is held and an earlier fetch of one.
    mixed = [first[0], row("b", "S", BASE + 30 + 600, BASE + 30, fetched_at=BASE + 32), row("d", "S", BASE + DAY + 600, BASE + DAY), row("e", "S", BASE + 5 * DAY + 600, BASE + 5 * DAY)]
    warehouse.update_observations(frame(spark, mixed), any_age=True)
    whole = Warehouse(spark, str(tmp_path / "whole"))
    whole.rebuild_observations(frame(spark, first + later + mixed))
    report = warehouse_difference({"staged": warehouse.staged()}, {"staged": whole.staged()}, duplicates=True).first()
    assert (report.only_left, report.only_right) == (0, 0)
    assert warehouse.staged().count() == 6
