"""What the feed packs into strings and codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from railpulse.schema import DIRECTION_CODES, RELATIONSHIP_CODES


def station_of(stop_id: Column) -> Column:
    """The station of a platform: the id without its N or S, where it has one."""
    return F.when(
        F.right(stop_id, F.lit(1)).isin("N", "S"),
        F.left(stop_id, F.length(stop_id) - 1),
    ).otherwise(stop_id)


def direction_of(stop_id: Column) -> Column:
    last = F.right(stop_id, F.lit(1))
    return F.when(last.isin("N", "S"), last)


def trip_origin_minutes(trip_id: Column) -> Column:
    """Minutes after midnight at the origin, from the hundredths in a trip id.

    Text before the first underscore that is no number gives null; a fraction
    of a hundredth is rounded.
    """
    number = F.split_part(trip_id, F.lit("_"), F.lit(1)).try_cast("decimal(38,18)")
    return F.round(number, 0).try_cast("int").cast("double") / F.lit(100.0)


def origin_clock(minutes: Column) -> Column:
    """Minutes after midnight as ``HH:MM``."""
    return F.when(
        minutes.isNotNull(),
        F.format_string(
            "%02d:%02d",
            F.floor(minutes / 60).cast("int"),
            F.floor(F.pmod(minutes, F.lit(60.0))).cast("int"),
        ),
    )


def _label(code: Column, labels: dict[int, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for value, text in labels.items():
        chosen = F.when(code == value, F.lit(text)).otherwise(chosen)
    return chosen


def direction_label(code: Column) -> Column:
    return _label(code, DIRECTION_CODES)


def relationship_label(code: Column) -> Column:
    """An unknown code counts as SCHEDULED; so does no code at all."""
    return F.coalesce(_label(code, RELATIONSHIP_CODES), F.lit("SCHEDULED"))


def colour(code: Column) -> Column:
    return F.when(code != "", F.concat(F.lit("#"), code))


def effective_track(actual: Column, scheduled: Column) -> Column:
    return F.coalesce(actual, scheduled, F.lit(""))
