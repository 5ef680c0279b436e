"""Stations and routes: what is published, and what was observed of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railpulse.functions.identifiers import colour
from railpulse.functions.values import safe_cast, zero_if_null


def published_stations(stops: DataFrame) -> DataFrame:
    """Rows of the stop list that are stations and not platforms in one."""
    return stops.where(safe_cast(F.col("location_type"), "int") == 1).select(
        F.col("stop_id").alias("station_id"),
        F.col("stop_name").alias("station_name"),
        safe_cast(F.col("stop_lat"), "float").alias("latitude"),
        safe_cast(F.col("stop_lon"), "float").alias("longitude"),
    )


def platform_counts(stops: DataFrame) -> DataFrame:
    return (
        stops.where(F.col("parent_station") != "")
        .groupBy(F.col("parent_station").alias("station_id"))
        .agg(F.count(F.lit(1)).alias("platform_count"))
    )


def station_parts(staged: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows per station and route: a handful for each station (and day, if that is in ``by``)."""
    return (
        staged.where(F.col("station_id").isNotNull())
        .groupBy(*by, "station_id", "route_id")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _count_stations(per_route: DataFrame) -> DataFrame:
    return per_route.groupBy("station_id").agg(
        F.sum("rows").alias("observations"),
        F.count("route_id").alias("routes_observed"),
    )


def observed_stations(staged: DataFrame) -> DataFrame:
    """Rows and distinct routes per station, exactly: one hash aggregation over the observations."""
    return _count_stations(station_parts(staged))


def fold_stations(parts: DataFrame) -> DataFrame:
    """``observed_stations`` from the parts of all days."""
    return _count_stations(parts.groupBy("station_id", "route_id").agg(F.sum("rows").alias("rows")))


def dim_stations(stops: DataFrame, staged: DataFrame) -> DataFrame:
    return described_stations(stops, observed_stations(staged))


def described_stations(stops: DataFrame, observed: DataFrame) -> DataFrame:
    """Every published station and every station the feed referred to.

    One that is not published gets no name and no position. Joins run at
    station grain; Spark picks their strategy by measured size.
    """
    published = published_stations(stops).withColumn("is_published", F.lit(True))
    unpublished = observed.join(published, "station_id", "left_anti").select(
        "station_id",
        F.lit(None).cast("string").alias("station_name"),
        F.lit(None).cast("float").alias("latitude"),
        F.lit(None).cast("float").alias("longitude"),
        F.lit(False).alias("is_published"),
    )
    return (
        published.unionByName(unpublished)
        .join(platform_counts(stops), "station_id", "left")
        .join(observed, "station_id", "left")
        .select(
            "station_id", "station_name", "latitude", "longitude", "is_published",
            zero_if_null(F.col("platform_count")).alias("platform_count"),
            zero_if_null(F.col("observations")).alias("observations"),
            zero_if_null(F.col("routes_observed")).alias("routes_observed"),
        )
    )


def trip_parts(staged: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """First and last observation of every trip of a route and feed (on a day, if that is in ``by``)."""
    return staged.groupBy(*by, "route_id", "feed_id", "trip_id").agg(
        F.min("observed_at").alias("first"), F.max("observed_at").alias("last")
    )


def fold_routes(parts: DataFrame) -> DataFrame:
    """Per route: feed, distinct trips, first and last observation, from parts of any cut."""
    per_trip = parts.where(F.col("route_id").isNotNull()).groupBy("route_id", "trip_id").agg(
        F.min("feed_id").alias("feed_id"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    return per_trip.groupBy("route_id").agg(
        F.min("feed_id").alias("feed_id"),
        F.count("trip_id").alias("trips_observed"),
        F.min("first").alias("first_observed_at"),
        F.max("last").alias("last_observed_at"),
    )


def observed_routes(staged: DataFrame) -> DataFrame:
    """``fold_routes`` of all observations; trips are counted exactly.

    None of this changes when an observation is there twice, so staged rows
    with copies in them give the same answer.
    """
    return fold_routes(trip_parts(staged))


def dim_routes(routes: DataFrame, staged: DataFrame) -> DataFrame:
    return described_routes(routes, observed_routes(staged))


def described_routes(routes: DataFrame, observed: DataFrame) -> DataFrame:
    """Published routes only, with what was observed of each."""
    return routes.join(observed, "route_id", "left").select(
        "route_id",
        "route_short_name",
        "route_long_name",
        colour(F.col("route_color")).alias("route_color"),
        colour(F.col("route_text_color")).alias("route_text_color"),
        "feed_id",
        zero_if_null(F.col("trips_observed")).alias("trips_observed"),
        "first_observed_at",
        "last_observed_at",
    )
