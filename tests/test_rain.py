"""The closed form against the dense matrix formula, and the refusals."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from pyspark.sql import functions as F

from railpulse.functions.normal import error_function_complement, two_sided_p
from railpulse.operators.rain import Z95, rain_effect, with_p_values

START = datetime(2026, 3, 1)
WAITS = "route_id string, service_hour timestamp_ntz, hour_of_day long, headways long, excess_wait_minutes double"
WEATHER = "service_hour timestamp_ntz, precip_mm double, is_wet boolean"


def history(seed=5, hours=24 * 9, platforms=3):
    generator = random.Random(seed)
    rain = {START + timedelta(hours=h): (generator.choice([0.4, 1.2, 3.0]) if generator.random() < .3 else 0.0)
            for h in range(hours)}
    waits = []
    for at, mm in rain.items():
        if at.hour == 4 and at.day > 1:
            continue  # one row alone in its hour of day, per platform
        waits += [("A", at, at.hour, 3, 1 + .3 * mm + at.hour / 24 + generator.random() * (1 + mm))
                  for _ in range(platforms)]
    return waits, [(at, mm, mm > 0) for at, mm in rain.items()]


def dense(waits, weather):
    rain = {at: mm for at, mm, _ in weather}
    hours = sorted({w[2] for w in waits})
    design = np.array([[1.0, rain[w[1]], *[float(w[2] == h) for h in hours[1:]]] for w in waits])
    y = np.array([w[4] for w in waits])
    inverse = np.linalg.inv(design.T @ design)
    beta = inverse @ design.T @ y
    residual = y - design @ beta
    leverage = np.einsum("ij,jk,ik->i", design, inverse, design)
    meat = (design * (residual / (1 - leverage))[:, None] ** 2).T @ design
    error = math.sqrt((inverse @ meat @ inverse)[1, 1])
    return beta[1], error, 1 - residual @ residual / ((y - y.mean()) @ (y - y.mean()))


def frames(spark, waits, weather):
    return spark.createDataFrame(waits, WAITS), spark.createDataFrame(weather, WEATHER)


def test_slope_error_and_fit_equal_the_matrix_formula(spark):
    waits, weather = history()
    slope, error, fit = dense(waits, weather)
    found = with_p_values(rain_effect(*frames(spark, waits, weather))).first()
    assert found.status == "fitted" and found.n == len(waits)
    assert found.minutes_per_mm == pytest.approx(slope, rel=1e-9)
    assert found.std_error == pytest.approx(error, rel=1e-9)
    assert found.r_squared == pytest.approx(fit, rel=1e-9)
    assert found.ci_low == pytest.approx(slope - Z95 * error)
    assert found.p_value == pytest.approx(math.erfc(abs(slope / error) / math.sqrt(2)))


def test_too_little_is_refused_in_a_fixed_order(spark):
    waits, weather = history()
    few = [("few", *w[1:]) for w in waits[:59]]
    dry_hours = {at for at, _, wet in weather if not wet}
    dry = [("dry", *w[1:]) for w in waits if w[1] in dry_hours]
    # Rain at one hour of the day only, and always as much.
    steady = [(at, 2.0 if at.hour == 9 else 0.0, at.hour == 9) for at, _, _ in weather]
    reasons = {r.route_id: r for r in rain_effect(*frames(spark, few + dry, weather)).collect()}
    assert reasons["few"].why == "59 route-hours"
    assert reasons["dry"].why == "0 wet hours" and reasons["dry"].minutes_per_mm is None
    same = rain_effect(*frames(spark, waits, steady)).first()
    assert same.why == "no variation within hours"
    flat = rain_effect(*frames(spark, waits, [(at, 1.0, True) for at, _, _ in weather])).first()
    assert flat.why == "no variation in rainfall"


def test_thin_hours_are_left_out(spark):
    waits, weather = history()
    thin = [(*w[:3], 2, w[4]) for w in waits]
    assert rain_effect(*frames(spark, thin, weather)).isEmpty()


def test_the_normal_tail(spark):
    xs = [0.0, 1e-9, 0.3, 1.0, 2.4999, 2.5, 2.5001, 4.0, 9.0, 26.0, 40.0]
    found = spark.createDataFrame([(x,) for x in xs], "x double").select(error_function_complement(F.col("x"))).collect()
    for x, (value,) in zip(xs, found):
        assert value == pytest.approx(math.erfc(x), rel=1e-9, abs=1e-300)
    assert spark.range(1).select(two_sided_p(F.lit(None).cast("double"))).first()[0] is None
