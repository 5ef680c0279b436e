"""Hourly weather, one row per local hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from railpulse.functions.values import is_wet

# Fixed value: how the hours are written in the source.
HOUR_FORMAT = "yyyy-MM-dd'T'HH:mm"


def weather_rows(documents: DataFrame) -> DataFrame:
    """Parallel arrays to rows. ``service_hour`` is a naive local hour."""
    hourly = documents.select(F.inline(F.arrays_zip(
        F.col("hourly.time").alias("time"),
        F.col("hourly.precipitation").alias("precipitation"),
        F.col("hourly.temperature_2m").alias("temperature_2m"),
        F.col("hourly.wind_speed_10m").alias("wind_speed_10m"),
    )))
    return hourly.select(
        F.expr(f"""to_timestamp_ntz(time, "{HOUR_FORMAT}")""").alias("service_hour"),
        F.col("precipitation").alias("precip_mm"),
        F.col("temperature_2m").alias("temperature_c"),
        F.col("wind_speed_10m").alias("wind_kmh"),
        is_wet(F.col("precipitation")).alias("is_wet"),
    )


def weather_summary(weather: DataFrame) -> DataFrame:
    hours, wet = F.count(F.lit(1)), F.count_if("is_wet")
    return weather.agg(
        hours.alias("hours"),
        wet.alias("wet_hours"),
        (wet / F.greatest(hours, F.lit(1))).alias("wet_share"),
        F.coalesce(F.sum("precip_mm"), F.lit(0.0)).alias("total_mm"),
    )
