"""Snapshots as a stream leave the landing rows of one pass."""

from collections import Counter

import pytest
from conftest import BASE
from test_snapshots import message, stop, trip_entity

from railpulse.operators import snapshots
from railpulse.plans import queries
from railpulse.schema import LANDING_COLUMNS, SNAPSHOT_SCHEMA
from railpulse.sources.landing import read_landing, write_landing
from railpulse.streaming.collect import Collector, follow_snapshots

# Headers in order of fetching: repeats side by side, an older one that comes back, none at all, a second feed.
HEADERS = [0, 0, 30, 30, 0, None, 0, 60, 60, 60]


def messages():
    found = []
    for n, header in enumerate(HEADERS):
        at = 0 if header is None else BASE + header
        entities = [trip_entity("1", f"t{n}", [stop("1N", BASE + 100 + n), stop("2N", BASE + 200 + n)])]
        found.append(message(at, BASE + 10 * n, entities))
        if n % 3 == 0:
            found.append(message(BASE + 5, BASE + 10 * n + 1, entities, feed="g"))
    return found


def landed(spark, root):
    return Counter(tuple(r) for r in read_landing(spark, root).select(*LANDING_COLUMNS).collect())


def whole(spark):
    rows = spark.createDataFrame(messages(), SNAPSHOT_SCHEMA)
    return Counter(tuple(r) for r in snapshots.to_landing(rows).select(*LANDING_COLUMNS).collect())


@pytest.mark.parametrize("portion", [3, 20])
def test_batches_equal_one_pass(spark, tmp_path, portion):
    """Portions arrive one after the other, each absorbed by a stream that is started again."""
    source, root, checkpoint = (str(tmp_path / n) for n in ("messages", "landing", "checkpoint"))
    rows = messages()
    for i in range(0, len(rows), portion):
        frame = spark.createDataFrame(rows[i:i + portion], SNAPSHOT_SCHEMA)
        frame.coalesce(1).write.mode("append").json(source)
        follow_snapshots(spark, source, root, checkpoint, max_files=1).awaitTermination()
    assert landed(spark, root) == whole(spark)


def test_a_batch_that_is_repeated_lands_once(spark, tmp_path):
    collector, root = Collector(spark, str(tmp_path / "kept")), str(tmp_path / "landing")
    rows = messages()
    first, second = (spark.createDataFrame(r, SNAPSHOT_SCHEMA) for r in (rows[:4], rows[4:]))
    collector.absorb(first, 0, root)
    collector.absorb(first, 0, root)
    # Stopped between its rows and its headers.
    write_landing(snapshots.to_landing(second, collector.before(1)), root, batch=f"{collector.name()}-1")
    Collector(spark, collector.folder).absorb(second, 1, root)
    assert landed(spark, root) == whole(spark)


def test_headers_that_are_missing_stop_the_stream(spark, tmp_path):
    collector = Collector(spark, str(tmp_path / "kept"))
    with pytest.raises(LookupError, match="batch 6"):
        collector.absorb(spark.createDataFrame(messages()[:1], SNAPSHOT_SCHEMA), 7, str(tmp_path / "landing"))


def test_a_feed_that_is_silent_keeps_its_header(spark):
    one = spark.createDataFrame([message(BASE, BASE, feed="g"), message(BASE, BASE + 1), message(0, BASE + 2)], SNAPSHOT_SCHEMA)
    two = spark.createDataFrame([message(BASE + 30, BASE + 31), message(BASE, BASE + 40, feed=None)], SNAPSHOT_SCHEMA)
    last = snapshots.last_headers(two, snapshots.last_headers(one))
    assert {(r.feed_id, r.fetched_at - BASE, r._header - BASE) for r in last.collect()} == {
        ("g", 0.0, 0), ("ace", 31.0, 30), (None, 40.0, 0)}


def counted(spark, rows):
    """Messages and how often one of them was made, all readings together."""
    made = spark.sparkContext.accumulator(0)

    def make(row):
        made.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(make), SNAPSHOT_SCHEMA, verifySchema=False), made


@pytest.mark.parametrize("copied", [False, True])
def test_a_batch_is_read_for_its_headers_and_its_messages(spark, tmp_path, copied):
    """Rows of one fetch and header have the messages read once more, as one of them has to be chosen."""
    rows = [message(BASE + n // 2, BASE + n, [trip_entity("1", f"t{n}", [stop("1N", BASE + 100)])]) for n in range(20)]
    rows += [message(BASE, BASE, [trip_entity("1", "u", [stop("1N", BASE + 100)])])] * copied
    collector, root = Collector(spark, str(tmp_path / "kept")), str(tmp_path / "landing")
    batch, made = counted(spark, rows)
    collector.absorb(batch, 0, root)
    assert made.value == (3 if copied else 2) * len(rows)
    assert sum(landed(spark, root).values()) == 10
    batch, made = counted(spark, rows)
    assert snapshots.suppress_repeats(batch).count() == 10
    assert made.value == (3 if copied else 2) * len(rows)


def test_portions_are_cut_from_messages_made_once(spark, monkeypatch):
    first, last = queries._SITTINGS
    rows = [message(BASE + n, at, [trip_entity("1", f"t{n}", [stop("1N", BASE)])])
            for n, at in enumerate((first - 1, first, first + 1, last, last + 1))]
    batch, made = counted(spark, rows)
    monkeypatch.setattr(queries.samples, "snapshots", lambda spark, sf_dir: batch)
    found = queries.stream_snapshots(spark, "").collect()
    assert sorted(r.trip_id for r in found) == ["t0", "t1", "t2", "t3", "t4"]
    assert made.value == len(rows)
