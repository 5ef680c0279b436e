"""Arrivals, read off disappearances."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railpulse.functions import clock
from railpulse.params import DEFAULTS, Params
from railpulse.schema import ARRIVALS_SCHEMA

_CARRIED = [
    "service_date_raw", "feed_id", "route_id", "trip_id", "train_id", "stop_id",
    "station_id", "platform_direction", "direction",
]
_EVIDENCE = ["last_seen_at", "lead_seconds", "observations_of_pair", "scheduled_track", "actual_track"]


def infer_arrivals(sightings: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Pairs that have gone, and were about to come true when they went.

    A strongly negative lead is a train already overdue; it still arrived.
    """
    return sightings.where(
        F.col("has_vanished") & (F.col("lead_seconds") <= params.arrival_grace_seconds)
    ).select(*_CARRIED, F.col("last_predicted_arrival").alias("inferred_arrival"), *_EVIDENCE)


def local_clock(instant: str, params: Params) -> dict:
    """The four wall-clock columns that follow from an instant."""
    local = clock.to_local(F.col(instant), params.service_zone)
    return {
        "arrival_local": local,
        "service_hour": clock.hour_floor(local),
        "hour_of_day": clock.hour_of_day(local),
        "day_of_week": clock.day_of_week(local),
    }


def fct_arrivals(inferred: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    derived = local_clock("inferred_arrival", params)
    return inferred.select(*[
        derived.get(c, F.col(c)).alias(c) for c in ARRIVALS_SCHEMA.fieldNames()
    ])
