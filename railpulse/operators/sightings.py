"""The last time each trip was seen ahead of each stop, and whether it has gone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from railpulse.functions import clock, identifiers
from railpulse.operators.keyed import join_lookup
from railpulse.schema import SIGHTINGS_SCHEMA

PAIR = ["service_date_raw", "trip_id", "stop_id"]

# What the last observation says of a pair, besides its prediction.
_TRAITS = ["feed_id", "route_id", "train_id", "direction", "scheduled_track", "actual_track"]


def can_arrive() -> Column:
    """A row that predicts an arrival. SKIPPED and NO_DATA say there is none."""
    return F.col("predicted_arrival").isNotNull() & (
        F.col("schedule_relationship") == "SCHEDULED"
    )


def feed_watermark(observations: DataFrame) -> DataFrame:
    """How far each feed has been watched, by all of its rows.

    Copies do not move a maximum, so landing rows serve as well as staged ones
    as long as their ``observed_at`` is an instant.
    """
    return observations.groupBy("feed_id").agg(F.max("observed_at").alias("observed_through"))


def landing_watermark(landing: DataFrame) -> DataFrame:
    """``feed_watermark`` straight from landing: two columns, no deduplication."""
    return landing.groupBy("feed_id").agg(
        clock.epoch_to_timestamp(F.max("observed_at")).alias("observed_through")
    )


def latest_by_pair(observations: DataFrame, touched: Column | None = None) -> DataFrame:
    """The last observation of every pair, and how many there were.

    One aggregation and one shuffle. Each input partition folds the
    observations it has of a pair (there are about 170 in all) before anything
    is shuffled, however many rows a single pair has. The smallest struct is the
    latest observation; of two at one instant, the one with the smaller feed
    id. The hash of the pair leads the grouping so that the sort under it
    compares numbers and seldom strings.
    """
    mark = F.max(touched) if touched is not None else F.lit(True)
    latest = F.min(F.struct(
        (-F.unix_micros("observed_at")).alias("recency"),
        *_TRAITS,
        F.col("predicted_arrival").alias("last_predicted_arrival"),
    ))
    return (
        observations.where(can_arrive())
        .groupBy(F.xxhash64(*PAIR).alias("_hash"), *PAIR)
        .agg(
            latest.alias("latest"),
            F.min("observed_at").alias("first_seen_at"),
            F.count(F.lit(1)).alias("observations_of_pair"),
            mark.alias("touched"),
        )
        .select(*PAIR, "latest.*", "first_seen_at", "observations_of_pair", "touched")
        .withColumn("last_seen_at", F.timestamp_micros(-F.col("recency")))
        .drop("recency")
    )


def describe(latest: DataFrame, watermark: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add what follows from the last observation and the feed's progress."""
    stop = F.col("stop_id")
    joined = join_lookup(latest, watermark, ["feed_id"])
    derived = {
        "station_id": identifiers.station_of(stop),
        "platform_direction": identifiers.direction_of(stop),
        "lead_seconds": clock.seconds_between(
            F.col("last_seen_at"), F.col("last_predicted_arrival")
        ),
        "has_vanished": F.col("last_seen_at") < F.col("observed_through"),
    }
    return joined.select(
        *[derived.get(c, F.col(c)).alias(c) for c in SIGHTINGS_SCHEMA.fieldNames()], *keep
    )


def last_sightings(staged: DataFrame, watermark: DataFrame | None = None) -> DataFrame:
    """One row per pair, whatever became of it.

    Pass ``watermark`` when it is known from elsewhere (landing rows give the
    same one); otherwise it is read from ``staged``, which should then be a
    stored table and not a plan that would run twice.
    """
    progress = watermark if watermark is not None else feed_watermark(staged)
    return describe(latest_by_pair(staged), progress)


def previous_progress(sightings: DataFrame) -> DataFrame:
    """How far the run that wrote ``sightings`` had watched each feed.

    Pairs still pending are stored too, so the newest sighting says it.
    """
    return sightings.groupBy("feed_id").agg(F.max("last_seen_at").alias("seen_through"))


def touched_since(lookback_hours: int) -> Column:
    """Seen at or after the previous progress of its feed, less the lookback.

    A feed with nothing stored is new and counts in full.
    """
    return F.col("seen_through").isNull() | (
        F.col("observed_at") >= clock.shift(F.col("seen_through"), hours=-lookback_hours)
    )


def touched_pairs(staged: DataFrame, held: DataFrame, lookback_hours: int) -> DataFrame:
    """The pairs whose answer may have changed since ``held`` was written."""
    observed = join_lookup(
        staged.where(can_arrive()), previous_progress(held), ["feed_id"], "left"
    )
    return observed.where(touched_since(lookback_hours)).select(*PAIR).distinct()
