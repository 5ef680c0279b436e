"""How far the headline figures move with the grace threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from railpulse.operators.headways import HOUR, arrivals_with_headways, wait_measures
from railpulse.operators.summary import MIN_HEADWAYS_PER_HOUR
from railpulse.params import DEFAULTS, Params

DEFAULT_GRACES = (30, 60, 120, 240, 480)
BASELINE_GRACE = 120


def arrivals_by_grace(sightings: DataFrame, graces: Sequence[int]) -> DataFrame:
    """Every vanished pair once per threshold that accepts it.

    Pairs no threshold accepts are dropped first, so the fan-out is at most
    the number of thresholds.
    """
    accepted = F.filter(F.lit(list(graces)), lambda g: F.col("lead_seconds") <= g)
    return sightings.where(
        F.col("has_vanished") & (F.col("lead_seconds") <= max(graces))
    ).select(
        "service_date_raw", "route_id", "stop_id", "trip_id",
        F.col("last_predicted_arrival").alias("inferred_arrival"),
        F.explode(accepted).alias("grace"),
    )


def sensitivity_sweep(
    sightings: DataFrame,
    graces: Sequence[int] = DEFAULT_GRACES,
    params: Params = DEFAULTS,
) -> DataFrame:
    """The figures for each threshold, from one pass over the sightings.

    The threshold joins every key of the headway and excess-wait steps, which
    replaces a rebuild per threshold.
    """
    graces = sorted(set(graces))
    rows = arrivals_with_headways(arrivals_by_grace(sightings, graces), params, by=["grace"])
    measures = wait_measures(F.col("counts"))
    hours = rows.groupBy("grace", *HOUR).agg(
        F.sum("arrivals").alias("arrivals"),
        *[measures[m].alias(m) for m in ("headways", "mean_headway_minutes", "excess_wait_minutes")],
    )
    enough = F.col("headways") >= MIN_HEADWAYS_PER_HOUR
    measured = hours.groupBy("grace").agg(
        F.sum("arrivals").alias("arrivals"),
        F.sum("headways").alias("headways"),
        F.count_if(enough).alias("route_hours"),
        F.avg(F.when(enough, F.col("mean_headway_minutes"))).alias("mean_headway"),
        F.avg(F.when(enough, F.col("excess_wait_minutes"))).alias("excess_wait"),
    )
    # A threshold that accepts nothing still has its row, with zero counts.
    every = sightings.sparkSession.createDataFrame([(g,) for g in graces], "grace int")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in ("arrivals", "headways", "route_hours")]
    return every.join(measured, "grace", "left").select(
        "grace", *counts, "mean_headway", "excess_wait"
    ).orderBy("grace")


def sensitivity_swing(
    sweep: DataFrame, baseline_grace: int = BASELINE_GRACE, otherwise: int | None = None
) -> DataFrame:
    """Range of excess wait over the sweep, relative to the baseline.

    The baseline is the value at ``baseline_grace``. If that was not swept it is
    the value at ``otherwise``, or at the smallest threshold where none is
    named. Null with fewer than two values.
    """
    waits = F.col("excess_wait")
    at_baseline = F.max(F.when(F.col("grace") == baseline_grace, F.lit(True)))
    base = F.when(
        at_baseline, F.max(F.when(F.col("grace") == baseline_grace, waits))
    ).otherwise(
        F.min_by(waits, F.col("grace")) if otherwise is None
        else F.max(F.when(F.col("grace") == otherwise, waits))
    )
    swing = F.when(
        (F.count(waits) > 1) & (base != 0), (F.max(waits) - F.min(waits)) / base
    )
    return sweep.agg(base.alias("baseline"), swing.alias("swing"))
