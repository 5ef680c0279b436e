"""What rain costs a rider, per route, with the interval attached.

The model is ``excess_wait_minutes ~ precip_mm + hour of day`` with standard
errors robust to unequal variance (HC3). With one regressor and a set of hour
dummies it has a closed form: centre both variables within the hour of day,
and the slope, the leverages and the robust variance are sums.

Rain is the same on all platforms of a route in one hour, so the platforms can
be summed out first. What is left is a row per route and hour of history, and
no step after that sees a route's observations in one place.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from railpulse.functions.clock import hour_floor
from railpulse.functions.normal import two_sided_p
from railpulse.operators.summary import MIN_HEADWAYS_PER_HOUR

# Below these no slope is reported.
MIN_OBSERVATIONS = 60
MIN_WET_HOURS = 8

# Half-width of a 95% interval in standard errors, normal distribution.
Z95 = 1.959963984540054

_CELL = ["route_id", "hour_of_day"]


def wait_cells(waits: DataFrame, min_headways: int) -> DataFrame:
    """Count, mean and squared deviation of the wait, by route and hour."""
    wait = F.col("excess_wait_minutes")
    return (
        waits.where(F.col("headways") >= min_headways)
        .groupBy("route_id", hour_floor(F.col("service_hour")).alias("service_hour"), "hour_of_day")
        .agg(
            F.count(wait).alias("n"),
            F.avg(wait).alias("y"),
            (F.var_pop(wait) * F.count(wait)).alias("within"),
        )
    )


def rain_sample(
    waits: DataFrame, weather: DataFrame, min_headways: int = MIN_HEADWAYS_PER_HOUR
) -> DataFrame:
    """The cells joined to the weather of their hour."""
    rain = weather.select("service_hour", F.col("precip_mm").alias("x"), "is_wet")
    return wait_cells(waits, min_headways).join(rain, "service_hour")


def _support(cells: DataFrame) -> DataFrame:
    return cells.groupBy("route_id").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_wet"), F.col("n")).otherwise(0)).alias("wet_hours"),
        F.min("x").alias("least"),
        F.max("x").alias("most"),
    )


def _or_nothing(deviation: Column) -> Column:
    """Rain is told in tenths of a millimetre; less than this is rounding."""
    return F.when(F.abs(deviation) < 1e-9, F.lit(0.0)).otherwise(deviation)


def _fit(cells: DataFrame) -> DataFrame:
    """Slope, robust standard error and R squared per route.

    Windows run per route and hour of day (or route) over the cells: one row
    per hour of history each.
    """
    cells = cells.where(F.col("x").isNotNull())
    hour = Window.partitionBy(*_CELL)
    route = Window.partitionBy("route_id")
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    centred = (
        cells.withColumn("n_hour", F.sum(n).over(hour))
        .withColumn("dx", _or_nothing(x - F.sum(n * x).over(hour) / F.col("n_hour")))
        .withColumn("dy", y - F.sum(n * y).over(hour) / F.col("n_hour"))
        .withColumn("y_route", F.sum(n * y).over(route) / F.sum(n).over(route))
        .withColumn("sxx", F.sum(n * F.col("dx") * F.col("dx")).over(route))
        .withColumn("sxy", F.sum(n * F.col("dx") * F.col("dy")).over(route))
        .withColumn("slope", F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")))
    )
    dx = F.col("dx")
    miss = F.col("dy") - F.col("slope") * dx
    squared = F.col("within") + n * miss * miss
    leverage = F.lit(1.0) / F.col("n_hour") + F.try_divide(dx * dx, F.col("sxx"))
    # A row whose rain is the mean of its hour weighs nothing, including one
    # alone in its hour, whose leverage is 1. Any other row with a leverage of
    # 1 decides the slope by itself, and the error is unbounded.
    weight = F.try_divide(dx * dx * squared, F.pow(F.lit(1.0) - leverage, F.lit(2)))
    robust = F.when(dx != 0, F.coalesce(weight, F.lit(math.inf))).otherwise(0.0)
    off = y - F.col("y_route")
    return centred.groupBy("route_id").agg(
        F.first("slope").alias("slope"),
        F.try_divide(F.sqrt(F.sum(robust)), F.first("sxx")).alias("std_error"),
        (
            F.lit(1.0) - F.try_divide(F.sum(squared), F.sum(F.col("within") + n * off * off))
        ).alias("r_squared"),
    )


def rain_effect(
    waits: DataFrame,
    weather: DataFrame,
    min_headways: int = MIN_HEADWAYS_PER_HOUR,
    min_observations: int = MIN_OBSERVATIONS,
    min_wet_hours: int = MIN_WET_HOURS,
) -> DataFrame:
    """Per route a slope with its interval, or the reason there is none.

    The reasons are tried in a fixed order. The last one is for rain that
    differs between hours of the day and never within one.
    """
    cells = rain_sample(waits, weather, min_headways)
    n, wet = F.col("n"), F.col("wet_hours")
    why = (
        F.when(n < min_observations, F.concat(n.cast("string"), F.lit(" route-hours")))
        .when(wet < min_wet_hours, F.concat(wet.cast("string"), F.lit(" wet hours")))
        .when(F.coalesce(F.col("least") == F.col("most"), F.lit(True)), F.lit("no variation in rainfall"))
        .when(F.col("slope").isNull(), F.lit("no variation within hours"))
    )
    judged = _support(cells).join(_fit(cells), "route_id", "left").withColumn("why", why)
    fitted = F.col("why").isNull()
    low, high = F.col("slope") - Z95 * F.col("std_error"), F.col("slope") + Z95 * F.col("std_error")
    only = lambda column: F.when(fitted, column)
    return judged.select(
        "route_id",
        F.when(fitted, "fitted").otherwise("insufficient").alias("status"),
        "why",
        only(F.col("slope")).alias("minutes_per_mm"),
        only(F.col("std_error")).alias("std_error"),
        only(low).alias("ci_low"),
        only(high).alias("ci_high"),
        "n",
        only(wet).alias("wet_hours"),
        only(F.col("r_squared")).alias("r_squared"),
        only((low <= 0) & (high >= 0)).alias("straddles_zero"),
    )


def with_p_values(effect: DataFrame) -> DataFrame:
    """Two-sided normal p-values of the slopes; null where there is no slope."""
    return effect.withColumn("p_value", two_sided_p(F.col("minutes_per_mm") / F.col("std_error")))
