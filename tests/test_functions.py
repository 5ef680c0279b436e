from datetime import datetime

import pytest
from pyspark.sql import functions as F

from railpulse.functions import clock, identifiers, values

NY = "America/New_York"


def evaluate(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("stop, station, side", [
    ("127N", "127", "N"), ("127S", "127", "S"), ("127", "127", None), ("R65N", "R65", "N"),
    ("", "", None), (None, None, None), ("N", "", "N"), ("12n", "12n", None),
])
def test_stations_and_sides(spark, stop, station, side):
    stop = F.lit(stop).cast("string")
    assert evaluate(spark, identifiers.station_of(stop)) == station
    assert evaluate(spark, identifiers.direction_of(stop)) == side


@pytest.mark.parametrize("trip, minutes, text", [
    ("064750_A..N00R", 647.5, "10:47"), ("000000_1", 0.0, "00:00"), ("abc_1", None, None),
    ("", None, None), (None, None, None), ("144050_x", 1440.5, "24:00"), ("064750", 647.5, "10:47"),
])
def test_trip_origin(spark, trip, minutes, text):
    origin = identifiers.trip_origin_minutes(F.lit(trip).cast("string"))
    assert evaluate(spark, origin) == minutes
    assert evaluate(spark, identifiers.origin_clock(origin)) == text


@pytest.mark.parametrize("epoch, local, hour, day", [
    # 06:30Z is 01:30 before the clocks go forward, 07:30Z is 03:30 after.
    (1772951400, datetime(2026, 3, 8, 1, 30), 1, 0),
    (1772955000, datetime(2026, 3, 8, 3, 30), 3, 0),
    # The hour from one to two happens twice when they go back.
    (1793511000, datetime(2026, 11, 1, 1, 30), 1, 0),
    (1793514600, datetime(2026, 11, 1, 1, 30), 1, 0),
    (1773151200, datetime(2026, 3, 10, 10, 0), 10, 2),
])
def test_the_local_clock_follows_daylight_saving(spark, epoch, local, hour, day):
    naive = clock.to_local(clock.epoch_to_timestamp(F.lit(epoch)), NY)
    assert evaluate(spark, naive) == local
    assert evaluate(spark, clock.hour_floor(naive)) == local.replace(minute=0)
    assert evaluate(spark, clock.hour_of_day(naive)) == hour
    assert evaluate(spark, clock.day_of_week(naive)) == day


def test_instants_move_and_subtract(spark):
    instant = clock.epoch_to_timestamp(F.lit(1_000_000))
    later = clock.shift(instant, hours=-3, seconds=30)
    assert evaluate(spark, clock.timestamp_to_epoch(later)) == 1_000_000 - 3 * 3600 + 30
    assert evaluate(spark, clock.seconds_between(instant, later)) == -3 * 3600 + 30
    text = F.lit("2026-03-10 14:00:00.9").cast("timestamp"), F.lit("2026-03-10 14:00:02.1").cast("timestamp")
    assert evaluate(spark, clock.seconds_between(*text)) == 2


def test_clock_text_and_landing_directories(spark):
    assert evaluate(spark, clock.clock_text(F.lit(0), NY)) == "(none)"
    assert evaluate(spark, clock.clock_text(F.lit(1773151200), NY)) == "10:00:00"
    assert str(evaluate(spark, clock.landing_date(F.lit(1773115200), NY))) == "2026-03-10"
    assert str(evaluate(spark, clock.landing_date(F.lit(1773111600), NY))) == "2026-03-09"
    assert evaluate(spark, clock.landing_hour(F.lit(1773111600), NY)) == "23"


def test_absent_values(spark):
    assert evaluate(spark, values.zero_to_null(F.lit(0))) is None
    assert evaluate(spark, values.empty_to_null(F.lit(""))) is None
    assert evaluate(spark, values.safe_cast(F.lit("x"), "float")) is None
    assert evaluate(spark, values.zero_if_null(F.lit(None).cast("long"))) == 0
    assert evaluate(spark, values.is_wet(F.lit(None).cast("double"))) is False
    assert evaluate(spark, identifiers.colour(F.lit(""))) is None
    assert evaluate(spark, identifiers.colour(F.lit("0062CF"))) == "#0062CF"
    assert evaluate(spark, identifiers.relationship_label(F.lit(9))) == "SCHEDULED"
    assert evaluate(spark, identifiers.direction_label(F.lit(9))) is None
