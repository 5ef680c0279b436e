"""Gaps between consecutive trains, and what they cost a rider."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from railpulse.functions import clock, identifiers
from railpulse.operators.arrivals import local_clock
from railpulse.params import DEFAULTS, Params
from railpulse.schema import HEADWAYS_SCHEMA

PLATFORM = ["service_date_raw", "route_id", "stop_id"]
HOUR = [
    "service_date_raw", "route_id", "stop_id", "station_id", "platform_direction",
    "service_hour", "hour_of_day", "day_of_week",
]
_DAY = 86_400


def sequence_arrivals(
    arrivals: DataFrame, params: Params = DEFAULTS, by: Sequence[str] = ()
) -> DataFrame:
    """Arrivals at each platform in order, each with the one before it.

    Ordered by arrival, then trip id, nulls last. Two things keep a platform
    with very many arrivals from becoming one very large task, and neither
    changes a headway:

    * As long as the smallest headway counted is above zero, trains of one
      second at one platform are folded before the ordering: the first of them
      closes the gap, the last of them opens the next, and those in between
      have a gap of zero. ``arrivals`` says how many were folded.
    * A platform is ordered in stretches of a day (or the largest headway, if
      longer). An arrival near the end of a stretch also enters the next one
      as context, so every gap that can be counted is seen. A predecessor
      further back than the largest headway reads as none.
    """
    trip = F.struct(F.col("trip_id").isNull().alias("unknown"), F.col("trip_id").alias("id"))
    keys = [*by, *PLATFORM]
    if params.min_headway_minutes > 0:
        moments = arrivals.groupBy(
            F.xxhash64(*keys, "inferred_arrival").alias("_hash"), *keys, "inferred_arrival"
        ).agg(
            F.min(trip).alias("first"),
            F.max(trip).alias("last"),
            F.count(F.lit(1)).alias("arrivals"),
        ).drop("_hash")
    else:
        moments = arrivals.select(
            *keys, "inferred_arrival", trip.alias("first"), trip.alias("last"),
            F.lit(1).cast("long").alias("arrivals"),
        )

    reach = math.ceil(params.max_headway_minutes * 60)
    width = max(_DAY, reach)
    second = F.unix_seconds("inferred_arrival")
    own = F.floor(second / width)
    in_reach_of_next = F.pmod(second, F.lit(width)) >= width - reach
    sliced = moments.select(
        "*",
        own.alias("own"),
        F.explode(F.when(in_reach_of_next, F.array(own, own + 1)).otherwise(F.array(own))).alias("slice"),
    ).withColumn("_hash", F.xxhash64(*keys, "slice"))
    order = Window.partitionBy("_hash", *keys, "slice").orderBy("inferred_arrival", "first")
    return (
        sliced.select(
            "*",
            F.lag("inferred_arrival").over(order).alias("previous_arrival"),
            F.lag("last").over(order).alias("previous"),
        )
        .where(F.col("slice") == F.col("own"))
        .select(
            *keys,
            F.col("first.id").alias("trip_id"),
            F.col("previous.id").alias("previous_trip_id"),
            "previous_arrival",
            "inferred_arrival",
            "arrivals",
        )
    )


def _gap_seconds() -> Column:
    return clock.seconds_between(F.col("previous_arrival"), F.col("inferred_arrival"))


def is_headway(params: Params) -> Column:
    """Closed by another trip than opened it, and within the range.

    Applied after the ordering: a gap that is too short is not added to the
    next one.
    """
    minutes = _gap_seconds() / F.lit(60.0)
    return (F.col("previous_trip_id") != F.col("trip_id")) & minutes.between(
        params.min_headway_minutes, params.max_headway_minutes
    )


def _placed(sequenced: DataFrame, params: Params, by: Sequence[str], keep: Sequence[Column]) -> DataFrame:
    derived = {
        "station_id": identifiers.station_of(F.col("stop_id")),
        "platform_direction": identifiers.direction_of(F.col("stop_id")),
        **local_clock("inferred_arrival", params),
        "headway_minutes": _gap_seconds() / F.lit(60.0),
    }
    return sequenced.select(
        *by, *[derived.get(c, F.col(c)).alias(c) for c in HEADWAYS_SCHEMA.fieldNames()], *keep
    )


def headways(arrivals: DataFrame, params: Params = DEFAULTS, by: Sequence[str] = ()) -> DataFrame:
    """Per platform and not per station, and never across a service date.

    A headway belongs to the local hour of the train that closes it.
    """
    sequenced = sequence_arrivals(arrivals, params, by).where(is_headway(params))
    return _placed(sequenced, params, by, [])


def arrivals_with_headways(
    arrivals: DataFrame, params: Params = DEFAULTS, by: Sequence[str] = ()
) -> DataFrame:
    """As ``headways``, with every arrival kept and its headway null if none.

    ``arrivals`` counts the trains behind a row, ``counts`` marks the headways.
    """
    sequenced = sequence_arrivals(arrivals, params, by)
    return _placed(
        sequenced, params, by,
        [F.col("arrivals"), F.coalesce(is_headway(params), F.lit(False)).alias("counts")],
    )


def wait_measures(counted: Column | None = None) -> dict[str, Column]:
    """Aggregates over the headways of a group.

    Sums run over whole seconds, so the result does not depend on the order in
    which partitions are merged.
    """
    gap = _gap_seconds() if counted is None else F.when(counted, _gap_seconds())
    number, total, squares = F.count(gap), F.sum(gap), F.sum(gap * gap)
    mean = total / number / F.lit(60.0)
    rider = squares / (F.lit(120.0) * total)
    even = mean / F.lit(2.0)
    return {
        "headways": number,
        "mean_headway_minutes": mean,
        "min_headway_minutes": F.min(gap) / F.lit(60.0),
        "max_headway_minutes": F.max(gap) / F.lit(60.0),
        "rider_wait_minutes": rider,
        "even_wait_minutes": even,
        "excess_wait_minutes": rider - even,
    }


def excess_wait(gaps: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Length-weighted mean wait against that of an even service, per hour.

    Riders walk into long gaps more often: E[H^2] / (2 E[H]) against E[H] / 2.
    """
    return gaps.groupBy(*by, *HOUR).agg(
        *[measure.alias(name) for name, measure in wait_measures().items()]
    )
