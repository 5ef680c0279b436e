"""Headways in stretches and folded seconds against a plain ordered walk."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from railpulse.operators.headways import excess_wait, headways
from railpulse.operators.sensitivity import sensitivity_swing, sensitivity_sweep
from railpulse.params import Params

DAY = 86_400


def arrivals(seed):
    """Two platforms around day boundaries, many arrivals in one second, a null trip."""
    generator = random.Random(seed)
    seconds = [20_000 * DAY - 4000 + generator.randrange(8000) // 20 * 20 for _ in range(150)]
    seconds += [20_001 * DAY - 3600, 20_001 * DAY, 20_003 * DAY]
    rows = [("20241004", "A", "X1N" if n % 3 else "X2S", f"t{n:03d}", s) for n, s in enumerate(seconds)]
    return rows + [("20241004", "A", "X1N", None, seconds[5] + 7)]


def walk(rows, params):
    platforms = defaultdict(list)
    for date, route, stop, trip, at in rows:
        platforms[date, route, stop].append((at, trip is None, trip or "", trip))
    found = []
    for key, passed in platforms.items():
        passed.sort()
        for (before, _, _, opener), (at, _, _, closer) in zip(passed, passed[1:]):
            minutes = (at - before) / 60
            if opener and closer and opener != closer \
                    and params.min_headway_minutes <= minutes <= params.max_headway_minutes:
                found.append((*key, opener, closer, at, minutes))
    return sorted(found)


@pytest.mark.parametrize("params", [
    Params(), Params(min_headway_minutes=0.0), Params(max_headway_minutes=2000.0),
])
def test_headways_equal_an_ordered_walk(spark, params):
    rows = arrivals(11)
    df = spark.createDataFrame(rows, "service_date_raw string, route_id string, stop_id string, trip_id string, at long") \
        .withColumn("inferred_arrival", F.timestamp_seconds("at"))
    found = headways(df, params).withColumn("at", F.unix_seconds("inferred_arrival"))
    got = sorted((r.service_date_raw, r.route_id, r.stop_id, r.previous_trip_id, r.trip_id, r["at"], r.headway_minutes)
                 for r in found.collect())
    assert got == walk(rows, params)
    assert len(got) > 20


def test_the_sweep_equals_a_run_per_threshold(spark):
    rows = [(f"t{n:03d}", 20_000 * DAY + n * 97, n * 7 % 300 - 20, n % 11 > 0) for n in range(200)]
    seen = spark.createDataFrame(rows, "trip_id string, at long, lead_seconds long, has_vanished boolean").select(
        F.lit("20241004").alias("service_date_raw"), F.lit("A").alias("route_id"), F.lit("X1N").alias("stop_id"),
        "trip_id", F.timestamp_seconds("at").alias("last_predicted_arrival"), "lead_seconds", "has_vanished")
    graces = (-100, 30, 120, 300)
    sweep = {r.grace: r for r in sensitivity_sweep(seen, graces).collect()}
    assert sorted(sweep) == sorted(graces)
    for grace in graces:
        arrived = seen.where((F.col("lead_seconds") <= grace) & F.col("has_vanished")) \
            .withColumnRenamed("last_predicted_arrival", "inferred_arrival")
        waits = excess_wait(headways(arrived)).where("headways >= 3").collect()
        assert sweep[grace].arrivals == sum(1 for r in rows if r[2] <= grace and r[3])
        assert sweep[grace].route_hours == len(waits)
        if waits:
            mean = sum(w.excess_wait_minutes for w in waits) / len(waits)
            assert sweep[grace].excess_wait == pytest.approx(mean)
        else:
            assert sweep[grace].excess_wait is None


def test_the_swing_is_relative_to_the_baseline(spark):
    sweep = spark.createDataFrame([(30, 0.5), (120, 0.4), (480, 0.3)], "grace int, excess_wait double")
    assert sensitivity_swing(sweep).first().swing == pytest.approx(0.5)
    assert sensitivity_swing(sweep.where("grace <> 120")).first().baseline == 0.5
    assert sensitivity_swing(sweep.where("grace <> 120"), otherwise=480).first().baseline == 0.3
    assert sensitivity_swing(sweep.where("grace = 120")).first().swing is None
