"""Instants, wall clocks and the arithmetic between them.

Every function maps columns to columns and stays inside generated code. The
session zone is UTC (see ``railpulse.session.prepare``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_to_timestamp(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def timestamp_to_epoch(instant: Column) -> Column:
    return F.unix_seconds(instant)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, counted by second boundaries."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def shift(instant: Column, *, hours: Column | int = 0, seconds: Column | int = 0) -> Column:
    """``instant`` moved by hours and seconds; negative amounts move it back."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return instant + F.make_dt_interval(
        F.lit(0), as_column(hours), F.lit(0), as_column(seconds)
    )


def to_local(instant: Column, zone: str) -> Column:
    """The naive wall-clock reading of an instant, daylight saving included."""
    return F.from_utc_timestamp(instant, zone).cast("timestamp_ntz")


def hour_floor(local: Column) -> Column:
    return F.date_trunc("hour", local).cast("timestamp_ntz")


def hour_of_day(local: Column) -> Column:
    return F.hour(local).cast("long")


def day_of_week(local: Column) -> Column:
    """Sunday is 0."""
    return (F.dayofweek(local) - 1).cast("long")


def landing_date(epoch: Column, zone: str) -> Column:
    return F.to_date(to_local(epoch_to_timestamp(epoch), zone))


def landing_hour(epoch: Column, zone: str) -> Column:
    return F.date_format(to_local(epoch_to_timestamp(epoch), zone), "HH")


def clock_text(epoch: Column, zone: str, missing: str = "(none)") -> Column:
    """``HH:mm:ss`` on the local clock, or a marker where there is no time."""
    known = F.nullif(epoch, F.lit(0))
    return F.coalesce(
        F.date_format(to_local(epoch_to_timestamp(known), zone), "HH:mm:ss"),
        F.lit(missing),
    )
