"""Predictions of a trip as they converge, and vanish."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from railpulse.functions.clock import clock_text
from railpulse.operators.keyed import join_lookup
from railpulse.params import DEFAULTS, Params

_TRIP = ["feed_id", "trip_id"]


def predicted(landing: DataFrame) -> DataFrame:
    return landing.where(F.col("predicted_arrival").isNotNull())


def prediction_trace(landing: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Per trip and stop: the last prediction, when it was made, and if it has gone.

    A stop is passed when the newest snapshot of its feed no longer has it. That
    covers a trip that has left the feed altogether.
    """
    newest = landing.groupBy("feed_id").agg(F.max("observed_at").alias("newest"))
    last = predicted(landing).groupBy(*_TRIP, "stop_id").agg(
        F.count(F.lit(1)).alias("polls"),
        F.max(F.struct("observed_at", "predicted_arrival")).alias("last"),
    )
    zone = params.service_zone
    return join_lookup(last, newest, ["feed_id"]).select(
        *_TRIP, "stop_id", "polls",
        F.col("last.predicted_arrival").alias("predicted_arrival"),
        F.col("last.observed_at").alias("last_seen_at"),
        clock_text(F.col("last.predicted_arrival"), zone, "--:--:--").alias("arrival_clock"),
        clock_text(F.col("last.observed_at"), zone, "--:--:--").alias("seen_clock"),
        F.when(F.col("last.observed_at") < F.col("newest"), "passed")
        .otherwise("still ahead").alias("state"),
    )


def busiest_trips(landing: DataFrame, stops: int = 6) -> DataFrame:
    """Each feed's trip with the most stops, and the first few of them.

    Stops are in the order of their position at the trip's first sight of them.
    """
    seen = predicted(landing).groupBy(*_TRIP, "stop_id").agg(
        F.min(F.struct("observed_at", "stop_sequence", "stop_id")).alias("first"),
        F.count(F.lit(1)).alias("polls"),
    )
    trips = seen.groupBy(*_TRIP).agg(
        F.count(F.lit(1)).alias("stops"), F.sum("polls").alias("polls")
    )
    best = trips.groupBy("feed_id").agg(
        F.min(F.struct((-F.col("stops")).alias("s"), (-F.col("polls")).alias("p"), "trip_id")).alias("best")
    ).select("feed_id", F.col("best.trip_id").alias("trip_id"))
    order = Window.partitionBy(*_TRIP).orderBy("first")
    return (
        seen.join(best, _TRIP)
        .withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= stops)
        .select(*_TRIP, "stop_id", "position")
    )


def trace_matrix(
    landing: DataFrame, watched: DataFrame, stops: int = 6, params: Params = DEFAULTS
) -> DataFrame:
    """Poll by stop: what a trip predicts for each stop it is watched at.

    ``watched`` has (feed, trip, stop, position). Cells are ``mm:ss`` and null
    once the stop is no longer predicted. A poll is fetched again at times; the
    latest prediction of a poll stands.
    """
    rows = join_lookup(predicted(landing), watched, [*_TRIP, "stop_id"])
    cells = rows.groupBy(*_TRIP, "observed_at").agg(*[
        _cell(i, params).alias(f"stop_{i}") for i in range(1, stops + 1)
    ])
    return cells.select(
        *_TRIP, "observed_at",
        F.right(clock_text(F.col("observed_at"), params.service_zone), F.lit(5)).alias("feed_time"),
        *[f"stop_{i}" for i in range(1, stops + 1)],
    )


def _cell(position: int, params: Params) -> Column:
    at = F.max(F.when(F.col("position") == position, F.col("predicted_arrival")))
    return F.when(at.isNotNull(), F.right(clock_text(at, params.service_zone), F.lit(5)))
