"""Landing rows made usable: types, names, and one row per observation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from railpulse.functions import clock, identifiers
from railpulse.functions.values import safe_cast
from railpulse.operators.keyed import first_per_key

NATURAL_KEY = ["feed_id", "observed_at", "trip_id", "stop_id"]

# Of several copies of one observation the earliest fetch is kept. The other
# columns only make the choice total when two copies were fetched together.
PREFERENCE = [
    "fetched_at", "route_id", "service_date_raw", "direction", "train_id", "is_assigned",
    "stop_sequence", "predicted_arrival", "predicted_departure", "scheduled_track",
    "actual_track", "schedule_relationship",
]


def shape(landing: DataFrame) -> DataFrame:
    """Typed and named, nothing filtered. A narrow projection."""
    stop, trip = F.col("stop_id"), F.col("trip_id")
    return landing.select(
        "feed_id",
        "trip_id",
        "stop_id",
        identifiers.station_of(stop).alias("station_id"),
        identifiers.direction_of(stop).alias("platform_direction"),
        "route_id",
        safe_cast(F.col("start_date"), "string").alias("service_date_raw"),
        clock.epoch_to_timestamp(F.col("observed_at")).alias("observed_at"),
        clock.epoch_to_timestamp(F.col("fetched_at")).alias("fetched_at"),
        clock.epoch_to_timestamp(F.col("predicted_arrival")).alias("predicted_arrival"),
        clock.epoch_to_timestamp(F.col("predicted_departure")).alias("predicted_departure"),
        (F.col("fetched_at") - F.col("observed_at")).alias("feed_lag_seconds"),
        "direction",
        "train_id",
        "is_assigned",
        "stop_sequence",
        "scheduled_track",
        "actual_track",
        "schedule_relationship",
        identifiers.trip_origin_minutes(trip).alias("trip_origin_minutes"),
    )


def preference_key(row: str | None = None) -> Column:
    """A comparable struct: smaller is preferred, nulls come last."""
    name = (lambda c: f"{row}.{c}") if row else (lambda c: c)
    parts = []
    for column in PREFERENCE:
        parts += [
            F.col(name(column)).isNull().alias(f"no_{column}"),
            F.col(name(column)).alias(column),
        ]
    return F.struct(*parts)


def stage(landing: DataFrame) -> DataFrame:
    """One row per feed, snapshot, trip and stop.

    Copies are dropped on the raw columns, so that the derived ones are not
    carried through the shuffle.
    """
    raw = {"service_date_raw": "start_date"}
    order = [F.col(raw.get(c, c)).asc_nulls_last() for c in PREFERENCE]
    return shape(first_per_key(landing, NATURAL_KEY, order))
