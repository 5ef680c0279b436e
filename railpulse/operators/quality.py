"""Assertions over the tables. Each one returns what violates it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from railpulse.operators.keyed import join_lookup
from railpulse.operators.sightings import feed_watermark
from railpulse.params import DEFAULTS, Params
from railpulse.schema import FEED_IDS, GRAIN

# Bounds of the assertions.
MAX_LAG_SECONDS = 600
MIN_LAG_SECONDS = -60
MIN_LEAD_SECONDS = -86_400
EXCESS_WAIT_TOLERANCE = -1e-9


# -- conditions a row violates --------------------------------------------------

def is_missing(column: str, where: str | None = None) -> Column:
    missing = F.col(column).isNull()
    return missing & F.expr(where) if where else missing


def is_outside(column: str, lower: float, upper: float) -> Column:
    """Null is not outside; whether it may be null is another question."""
    return F.coalesce((F.col(column) < lower) | (F.col(column) > upper), F.lit(False))


def is_unaccepted(column: str, values: Sequence[Any]) -> Column:
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def is_stale() -> Column:
    """A feed that stopped regenerating, or a clock of ours behind the feed's."""
    return is_outside("feed_lag_seconds", MIN_LAG_SECONDS, MAX_LAG_SECONDS)


def is_beyond_grace(params: Params = DEFAULTS) -> Column:
    return F.coalesce(F.col("lead_seconds") > params.arrival_grace_seconds, F.lit(False))


def is_negative_wait() -> Column:
    """A variance below zero is a fault; the tolerance is for floating point."""
    return F.coalesce(F.col("excess_wait_minutes") < EXCESS_WAIT_TOLERANCE, F.lit(False))


# -- violating rows ------------------------------------------------------------

def violations(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)


def repeated_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys with more than one row. Null counts as a value of its own."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("records")).where(F.col("records") > 1)


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    return repeated_keys(df.where(F.col(column).isNotNull()), [column])


def orphans(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Values without a parent, and how many rows have them.

    Rows are counted per value first, so the anti join sees distinct values and
    a value most rows share is no burden.
    """
    counted = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("records"))
    )
    return counted.join(
        parent.select(F.col(field).alias(column)).distinct(), column, "left_anti"
    )


def arrivals_from_newest_snapshot(arrivals: DataFrame, staged: DataFrame) -> DataFrame:
    """Arrivals that were not seen to vanish."""
    return join_lookup(arrivals, feed_watermark(staged), ["feed_id"]).where(
        F.col("last_seen_at") >= F.col("observed_through")
    ).select("feed_id", "trip_id", "stop_id", "last_seen_at", "observed_through")


# -- the whole list --------------------------------------------------------------

@dataclass(frozen=True)
class RowCheck:
    """An assertion that can be judged row by row."""

    table: str
    kind: str
    column: str
    condition: Column


@dataclass(frozen=True)
class Relationship:
    table: str
    column: str
    parent: str
    field: str


def row_checks(params: Params = DEFAULTS, feeds: Sequence[str] = FEED_IDS) -> list[RowCheck]:
    checks: list[RowCheck] = []

    def required(table: str, *columns: str, where: str | None = None) -> None:
        checks.extend(RowCheck(table, "not_null", c, is_missing(c, where)) for c in columns)

    def accepted(table: str, column: str, values: Sequence[Any]) -> None:
        checks.append(RowCheck(table, "accepted_values", column, is_unaccepted(column, values)))

    def between(table: str, column: str, lower: float, upper: float) -> None:
        checks.append(RowCheck(table, "between", column, is_outside(column, lower, upper)))

    staged = "stg_stop_time_updates"
    required(staged, "feed_id", "trip_id", "stop_id", "station_id", "service_date_raw",
             "observed_at", "fetched_at")
    accepted(staged, "feed_id", feeds)
    accepted(staged, "platform_direction", ["N", "S"])
    accepted(staged, "schedule_relationship", ["SCHEDULED", "SKIPPED", "NO_DATA", "UNSCHEDULED"])
    checks.append(RowCheck(staged, "feed_lag", "feed_lag_seconds", is_stale()))

    required("int_last_sightings", "service_date_raw", "feed_id", "trip_id", "stop_id",
             "last_predicted_arrival", "last_seen_at", "lead_seconds", "observations_of_pair",
             "has_vanished")

    inferred = "int_inferred_arrivals"
    required(inferred, "inferred_arrival", "last_seen_at", "lead_seconds", "observations_of_pair")
    between(inferred, "lead_seconds", MIN_LEAD_SECONDS, params.arrival_grace_seconds)

    arrivals = "fct_arrivals"
    required(arrivals, "route_id", "trip_id", "stop_id", "station_id", "inferred_arrival")
    accepted(arrivals, "hour_of_day", list(range(24)))
    checks.append(RowCheck(arrivals, "within_grace", "lead_seconds", is_beyond_grace(params)))

    required("fct_headways", "previous_arrival", "headway_minutes")
    between("fct_headways", "headway_minutes",
            params.min_headway_minutes, params.max_headway_minutes)

    waits = "fct_excess_wait"
    required(waits, "headways", "mean_headway_minutes", "excess_wait_minutes")
    checks.append(RowCheck(waits, "non_negative", "excess_wait_minutes", is_negative_wait()))

    required("dim_stations", "station_id", "is_published")
    required("dim_stations", "station_name", "latitude", "longitude", where="is_published")
    required("dim_routes", "route_id", "route_long_name")
    return checks


RELATIONSHIPS = [
    Relationship("fct_arrivals", "route_id", "dim_routes", "route_id"),
    Relationship("fct_arrivals", "station_id", "dim_stations", "station_id"),
    Relationship("fct_headways", "station_id", "dim_stations", "station_id"),
    Relationship("fct_excess_wait", "route_id", "dim_routes", "route_id"),
]


def _report(table: str, kind: str, column: str, counted: DataFrame) -> DataFrame:
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(kind).alias("check_kind"),
        F.lit(column).alias("column_name"), F.col("violations").cast("long").alias("violations"),
    )


def row_report(
    tables: Mapping[str, DataFrame], checks: Sequence[RowCheck], kinds: Sequence[str] | None = None
) -> DataFrame:
    """Violations per check: each table is read once for all of its checks."""
    chosen = [c for c in checks if c.table in tables and (kinds is None or c.kind in kinds)]
    reports = []
    for table in dict.fromkeys(c.table for c in chosen):
        mine = [c for c in chosen if c.table == table]
        counts = tables[table].agg(*[F.count_if(c.condition).alias(f"c{i}") for i, c in enumerate(mine)])
        lines = F.array(*[
            F.struct(
                F.lit(c.kind).alias("check_kind"), F.lit(c.column).alias("column_name"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, c in enumerate(mine)
        ])
        reports.append(
            counts.select(F.inline(lines)).select(F.lit(table).alias("table_name"), "*")
        )
    return reduce(DataFrame.unionByName, reports)


def unique_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys that repeat, per table, on the grain the table promises."""
    def counted(table: str, grain: tuple[str, ...]) -> DataFrame:
        repeated = (
            repeated_values(tables[table], grain[0]) if len(grain) == 1
            else repeated_keys(tables[table], grain)
        )
        return repeated.agg(F.count(F.lit(1)).alias("violations"))

    return reduce(DataFrame.unionByName, [
        _report(table, "unique", ", ".join(grain), counted(table, grain))
        for table, grain in GRAIN.items() if table in tables
    ])


def relationship_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        _report(
            r.table, "relationships", r.column,
            orphans(tables[r.table], r.column, tables[r.parent], r.field).agg(
                F.coalesce(F.sum("records"), F.lit(0)).alias("violations")
            ),
        )
        for r in RELATIONSHIPS
    ])


def vanish_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    found = arrivals_from_newest_snapshot(tables["fct_arrivals"], tables["stg_stop_time_updates"])
    return _report(
        "fct_arrivals", "observed_to_vanish", "last_seen_at",
        found.agg(F.count(F.lit(1)).alias("violations")),
    )


def quality_report(
    tables: Mapping[str, DataFrame], params: Params = DEFAULTS, feeds: Sequence[str] = FEED_IDS
) -> DataFrame:
    """One line per assertion. A warehouse is sound when all counts are zero."""
    return (
        row_report(tables, row_checks(params, feeds))
        .unionByName(unique_report(tables))
        .unionByName(relationship_report(tables))
        .unionByName(vanish_report(tables))
    )
