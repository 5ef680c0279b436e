"""One small session, and landing rows with answers known by construction."""

from __future__ import annotations

import sys
from dataclasses import dataclass
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from railpulse.schema import LANDING_SCHEMA  # noqa: E402
from railpulse.session import local_session  # noqa: E402

BASE = 1_781_686_800  # Wednesday 17 June 2026, 09:00 UTC, five in the morning in New York
POLL = 20  # seconds from one snapshot to the next


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "railpulse-tests", **{
        "spark.sql.shuffle.partitions": "2",
        "spark.default.parallelism": "2",
        "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "5000",
    })
    yield session
    session.stop()


@dataclass(frozen=True)
class Train:
    """A train on a snapshot from one second to another (since BASE), its arrival promised for a third."""

    trip: str
    stop: str
    since: int
    until: int
    promised: int
    feed: str = "nqrw"
    route: str = "Q"

    def listed(self, second: int) -> list[tuple]:
        if not self.since <= second <= self.until:
            return []
        return [row(self.trip, self.stop, BASE + self.promised, BASE + second, self.feed, self.route)]


def row(trip, stop, arrival, observed, feed="nqrw", route="Q", **changes):
    """A landing row; ``changes`` overrides any of its columns."""
    usual = dict.fromkeys(LANDING_SCHEMA.fieldNames()) | {
        "feed_id": feed, "route_id": route, "trip_id": trip, "stop_id": stop, "start_date": "20260617",
        "observed_at": observed, "fetched_at": observed + 8, "predicted_arrival": arrival,
        "direction": "SOUTH", "train_id": f"0{route} {trip}", "is_assigned": False, "stop_sequence": 0,
        "schedule_relationship": "SCHEDULED", "scheduled_track": "2",
    }
    if arrival is not None:
        usual["predicted_departure"] = arrival + 25
    return tuple((usual | changes)[name] for name in LANDING_SCHEMA.fieldNames())


def frame(spark, rows):
    return spark.createDataFrame(rows, LANDING_SCHEMA)


def snapshots(trains, begin, end):
    return [r for second in range(begin, end, POLL) for train in trains for r in train.listed(second)]


# Five trains at one platform, 5, 7, 11 and 5 minutes apart, each listed until it is there.
SPACED = [Train(f"spaced-{m}", "R30S", 0, 60 * m, 60 * m) for m in (1, 6, 13, 24, 29)]
MORNING = [
    Train("early", "R14S", 0, 200, 210),
    Train("taken-off", "R17S", 0, 60, 1500),
    Train("far-out", "R20S", 0, 10_000, 7000),
    *SPACED,
]


def watched_platform():
    """Forty minutes of one feed."""
    return snapshots(MORNING, 0, 2400)


# What lands, batch by batch; the feed "si" is polled in the first and the last only.
CUTS = (0, 300, 900, 1500, 2100)
BATCHES = len(CUTS) - 1
MAINLAND = [
    Train("done", "D10S", 0, 240, 250),
    Train("crossing", "D11S", 0, 280, 310),
    Train("back", "D12S", 0, 100, 110),
    Train("back", "D12S", 1000, 1040, 1900),
    Train("taken-off", "D13S", 0, 40, 800),
    Train("still-coming", "D14S", 0, 10_000, 9000),
    *SPACED,
]
ISLAND = [
    Train("isle-done", "S20S", 0, 200, 215, "si", "SI"),
    Train("isle-crossing", "S21S", 0, 280, 290, "si", "SI"),
    Train("isle-later", "S22S", 1500, 1700, 1720, "si", "SI"),
    Train("isle-coming", "S23S", 0, 10_000, 9000, "si", "SI"),
]
# Arrivals of a trip after each batch.
EXPECTED = {
    "done": [1, 1, 1, 1],
    "crossing": [0, 1, 1, 1],
    "back": [1, 1, 0, 0],
    "isle-done": [1, 1, 1, 1],
    "isle-crossing": [0, 0, 0, 1],
}


def batch(number: int):
    polled = MAINLAND + (ISLAND if number in (0, BATCHES - 1) else [])
    return snapshots(polled, CUTS[number], CUTS[number + 1])


def all_batches():
    return [r for number in range(BATCHES) for r in batch(number)]


def arrivals_of(warehouse, trip):
    return warehouse.fact("fct_arrivals").where(f"trip_id = '{trip}'").count()
