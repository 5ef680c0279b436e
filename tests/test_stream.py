"""The stream keeps the warehouse a rebuild would."""

import pytest
from conftest import BASE, BATCHES, EXPECTED, all_batches, arrivals_of, batch, frame, row
from test_incremental import NO_OVERLAP, different, rebuilt

from railpulse.plans.warehouse import Warehouse
from railpulse.sources.landing import stream_landing, write_landing
from railpulse.streaming.ingest import follow_landing, stale_rows


def test_files_batch_by_batch_and_a_restart(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "warehouse", "checkpoint"))
    warehouse = Warehouse(spark, root, NO_OVERLAP)
    withdrawn = []
    for number in range(BATCHES):
        write_landing(frame(spark, batch(number)), landing)
        follow_landing(spark, landing, root, checkpoint, NO_OVERLAP).awaitTermination()
        withdrawn.append(arrivals_of(warehouse, "back"))
    assert withdrawn == EXPECTED["back"]
    # Started again with nothing new, it changes nothing.
    follow_landing(spark, landing, root, checkpoint, NO_OVERLAP).awaitTermination()
    assert different(warehouse, rebuilt(spark, tmp_path / "whole", all_batches())) == {}


def test_stale_feeds_show_on_the_stream(spark, tmp_path):
    landing = str(tmp_path / "landing")
    rows = frame(spark, batch(0))
    late = rows.withColumn("fetched_at", rows.observed_at + 601)
    write_landing(late, landing)
    query = (
        stale_rows(stream_landing(spark, landing)).writeStream.format("memory")
        .queryName("stale").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("stale").count() == rows.count()
    assert stale_rows(rows).isEmpty()


@pytest.mark.parametrize("max_files", [1, 2, None])
def test_a_backlog_in_any_order_and_batch_size(spark, tmp_path, max_files):
    """Files a day apart, the newest written first: no row is too late for a stream that sees each file once."""
    day = 86_400
    landed = []
    for days in (2, 0, 1, 3):
        at = BASE + days * day
        rows = [
            row(f"x{days}", "K01S", at + 15, at), row("daily", "K02S", at + 20, at), row("other", "K03S", at + 900, at + 400),
        ]
        write_landing(frame(spark, rows), str(tmp_path / "landing"))
        landed += rows
    root = str(tmp_path / "warehouse")
    follow_landing(spark, str(tmp_path / "landing"), root, str(tmp_path / "checkpoint"), max_files=max_files).awaitTermination()
    assert Warehouse(spark, root).staged().count() == len(landed)
    assert different(Warehouse(spark, root), rebuilt(spark, tmp_path / "whole", landed)) == {}
