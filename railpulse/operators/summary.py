"""What is in the warehouse, as small tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from railpulse.functions import clock

MIN_HEADWAYS_PER_HOUR = 3


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def observation_span(staged: DataFrame) -> DataFrame:
    """First and last snapshot, the minutes between, and the feeds seen."""
    per_feed = staged.groupBy("feed_id").agg(
        F.min("observed_at").alias("first"), F.max("observed_at").alias("last")
    )
    span = per_feed.agg(
        F.min("first").alias("observed_from"),
        F.max("last").alias("observed_to"),
        F.count("feed_id").alias("feeds"),
    )
    seconds = clock.seconds_between(F.col("observed_from"), F.col("observed_to"))
    return span.withColumn("minutes", seconds / F.lit(60.0))


def unpublished_stations(stations: DataFrame) -> DataFrame:
    return stations.where(~F.col("is_published")).agg(F.count(F.lit(1)).alias("stations"))


def top_routes(arrivals: DataFrame, k: int = 6) -> DataFrame:
    """The routes with the most arrivals; ties by route id."""
    return (
        arrivals.groupBy("route_id")
        .agg(F.count(F.lit(1)).alias("arrivals"))
        .orderBy(F.desc("arrivals"), F.asc_nulls_last("route_id"))
        .limit(k)
    )


def worst_excess_wait(waits: DataFrame, stations: DataFrame, k: int = 5) -> DataFrame:
    """The hours with the worst excess wait and enough gaps to mean it.

    The k rows are found first and named afterwards. Equal waits are told apart
    at nine places, then by their grain.
    """
    worst = (
        waits.where(F.col("headways") >= MIN_HEADWAYS_PER_HOUR)
        .orderBy(
            F.round("excess_wait_minutes", 9).desc(),
            F.asc_nulls_last("service_date_raw"), F.asc_nulls_last("route_id"),
            F.asc_nulls_last("stop_id"), F.asc("service_hour"),
        )
        .limit(k)
    )
    names = stations.select("station_id", "station_name")
    return worst.join(names, "station_id", "left").select(
        "service_date_raw", "route_id", "stop_id", "service_hour",
        F.coalesce("station_name", F.lit("(unpublished)")).alias("station_name"),
        "headways", "mean_headway_minutes", "excess_wait_minutes",
    )
