"""The sample tables shaped as this package's inputs.

``events`` becomes landing rows, nested snapshots and weather hours; ``nation``
and ``region`` become the stop and route lists. All of it is derived by Spark
from whole tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from railpulse.functions import clock
from railpulse.schema import LANDING_COLUMNS

ZONE = "America/New_York"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with whole seconds and whole values."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"),
        F.floor("value").cast("long").alias("v"),
    )


def _trip() -> Column:
    hundredths = F.pmod(F.col("user_id") * 137, F.lit(144000)).cast("string")
    return F.concat(F.lpad(hundredths, 6, "0"), F.lit("_"), F.col("event_type"))


def _start_date() -> Column:
    return F.date_format(F.timestamp_seconds(F.col("t") - 14400), "yyyyMMdd")


def _stop() -> Column:
    e = F.col("event_id")
    return (
        F.when(e % 23 == 0, "R65N")
        .when(e % 5 == 0, "127")
        .when((e % 5).isin(1, 2), "127N")
        .otherwise("127S")
    )


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one predicted stop; each seventh one was fetched twice."""
    e = F.col("event_id")
    predicted = F.when(e % 17 != 0, F.col("t") + F.col("v") * 4 - 60)
    columns = {
        "feed_id": F.col("event_type"),
        "observed_at": F.col("t"),
        "fetched_at": F.col("t") + e % 97,
        "trip_id": _trip(),
        "route_id": F.col("event_type"),
        "start_date": _start_date(),
        "direction": F.when(e % 4 == 0, "SOUTH").otherwise("NORTH"),
        "train_id": F.concat(F.lit("train-"), F.col("user_id").cast("string")),
        "is_assigned": e % 3 == 0,
        "stop_id": _stop(),
        "stop_sequence": e % 20,
        "predicted_arrival": predicted,
        "predicted_departure": predicted + 30,
        "scheduled_track": (e % 4).cast("string"),
        "actual_track": F.when(e % 2 == 0, (e % 4).cast("string")),
        "schedule_relationship": F.when(e % 11 == 0, "SKIPPED")
        .when(e % 13 == 0, "NO_DATA")
        .otherwise("SCHEDULED"),
    }
    copies = F.when(e % 7 == 0, F.array(F.lit(0), F.lit(60))).otherwise(F.array(F.lit(0)))
    return (
        _events(spark, sf_dir)
        .select(*[columns[c].alias(c) for c in LANDING_COLUMNS], copies.alias("copies"))
        .withColumn("later", F.explode("copies"))
        .withColumn("fetched_at", F.col("fetched_at") + F.col("later"))
        .select(*LANDING_COLUMNS)
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station and two platforms per nation, all columns strings."""
    nation = table(spark, sf_dir, "nation")
    station = (F.lit(120) + F.col("n_nationkey")).cast("string")
    place = F.explode(F.array(F.lit(""), F.lit("N"), F.lit("S"))).alias("side")
    lat = F.round(F.lit(40.5) + F.col("n_nationkey") / F.lit(100.0), 2)
    lon = F.round(F.lit(-74.0) + F.col("n_regionkey") / F.lit(10.0), 1)
    return nation.select("*", place).select(
        F.concat(station, F.col("side")).alias("stop_id"),
        F.col("n_name").alias("stop_name"),
        lat.cast("string").alias("stop_lat"),
        lon.cast("string").alias("stop_lon"),
        F.when(F.col("side") == "", "1").otherwise("").alias("location_type"),
        F.when(F.col("side") == "", "").otherwise(station).alias("parent_station"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A route per event type, and one per region that is never observed."""
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    name = F.col("event_type")
    observed = kinds.select(
        name.alias("route_id"),
        F.upper(name).alias("route_short_name"),
        F.concat(name, F.lit(" line")).alias("route_long_name"),
        F.lit("").alias("route_desc"),
        F.when(name == "click", "0062CF").when(name == "view", "").otherwise("EB6800").alias("route_color"),
        F.lit("FFFFFF").alias("route_text_color"),
    )
    region = F.col("r_name")
    unobserved = table(spark, sf_dir, "region").select(
        region.alias("route_id"),
        F.upper(region).alias("route_short_name"),
        F.concat(region, F.lit(" line")).alias("route_long_name"),
        F.lit("").alias("route_desc"),
        F.lit(None).cast("string").alias("route_color"),
        F.lit("").alias("route_text_color"),
    )
    return observed.unionByName(unobserved)


def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document of parallel hourly arrays per local day in ``events``."""
    local_hour = clock.hour_floor(clock.to_local(F.timestamp_seconds("t"), ZONE))
    hours = _events(spark, sf_dir).select(local_hour.alias("hour")).distinct()
    k = F.unix_seconds(F.col("hour").cast("timestamp")) / 3600
    k = k.cast("long")
    wet = (k % 9).isin(0, 1)
    readings = hours.select(
        F.to_date("hour").alias("day"),
        F.struct(
            F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"),
            F.when(wet, (k % 7) * F.lit(0.5)).otherwise(F.lit(0.0)).alias("precipitation"),
            ((k % 30) - F.lit(5.0)).alias("temperature_2m"),
            ((k % 40) * F.lit(1.0)).alias("wind_speed_10m"),
        ).alias("reading"),
    )
    # At most 25 hours to a day, so the arrays are short whatever the volume.
    daily = readings.groupBy("day").agg(F.array_sort(F.collect_list("reading")).alias("r"))
    return daily.select(F.struct(
        F.col("r.time").alias("time"),
        F.col("r.precipitation").alias("precipitation"),
        F.col("r.temperature_2m").alias("temperature_2m"),
        F.col("r.wind_speed_10m").alias("wind_speed_10m"),
    ).alias("hourly"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested feed messages.

    A message holds the events of a type among 64 in a row, so its arrays are
    short whatever the volume: an entity per user, a stop per event. Codes,
    empty strings, zero times and missing parts occur as they do on the wire.
    Every fourth message was fetched again unchanged, and every eighth one after
    that with an older header and then as it was.
    """
    e, u = F.col("event_id"), F.col("user_id")
    predicted = F.when(e % 17 == 0, F.lit(0)).otherwise(F.col("t") + F.col("v") * 4 - 60).cast("long")
    stop = F.struct(
        _stop().alias("stop_id"),
        F.struct(predicted.alias("time")).alias("arrival"),
        F.struct(F.when(predicted == 0, 0).otherwise(predicted + 30).cast("long").alias("time")).alias("departure"),
        (e % 6).cast("int").alias("schedule_relationship"),
        F.when(e % 19 != 0, F.struct(
            (e % 4).cast("string").alias("scheduled_track"),
            F.when(e % 2 == 0, (e % 4).cast("string")).otherwise("").alias("actual_track"),
        )).alias("ext"),
    )
    message = ["event_type", "message"]
    entities = (
        _events(spark, sf_dir)
        .withColumn("message", F.floor(e / 64))
        .groupBy(*message, "user_id")
        .agg(
            F.array_sort(F.collect_list(F.struct(e.alias("event_id"), stop.alias("stop")))).alias("stops"),
            F.max("t").alias("t"),
        )
    )
    trip = F.struct(
        F.when(u % 29 == 0, "").otherwise(_trip()).alias("trip_id"),
        F.col("event_type").alias("route_id"),
        _start_date().alias("start_date"),
        F.when(u % 13 != 0, F.struct(
            F.when(u % 17 == 0, "").otherwise(F.concat(F.lit("train-"), u.cast("string"))).alias("train_id"),
            (u % 3 == 0).alias("is_assigned"),
            (u % 6).cast("int").alias("direction"),
        )).alias("ext"),
    )
    vehicle, alert = u % 7 == 3, u % 11 == 5
    entity = F.struct(
        u.cast("string").alias("id"),
        F.when(~vehicle & ~alert, F.struct(
            trip.alias("trip"), F.col("stops.stop").alias("stop_time_update"),
        )).alias("trip_update"),
        F.when(vehicle, F.struct(F.col("stops")[0]["stop"]["stop_id"].alias("stop_id"))).alias("vehicle"),
        F.when(alert, F.struct(F.lit("delays").alias("header_text"))).alias("alert"),
    )
    messages = entities.select(*message, "t", "user_id", entity.alias("entity")).groupBy(*message).agg(
        F.array_sort(F.collect_list(F.struct("user_id", "entity"))).alias("listed"),
        F.max("t").alias("made"),
    )
    number = F.col("message")
    fetches = (
        F.when(number % 8 == 0, F.array(*map(F.lit, (0, 1, 2, 3))))
        .when(number % 4 == 0, F.array(F.lit(0), F.lit(1)))
        .otherwise(F.array(F.lit(0)))
    )
    fetched = messages.select("*", F.explode(fetches).alias("fetch"))
    header = (
        F.when(number % 50 == 7, 0)
        .when(F.col("fetch") == 2, F.col("made") - 30)
        .otherwise(F.col("made")).cast("long")
    )
    return fetched.select(
        F.col("event_type").alias("feed_id"),
        (F.col("made") + F.lit(3.25) + F.col("fetch") * F.lit(5.5)).alias("fetched_at"),
        F.struct(header.alias("timestamp")).alias("header"),
        F.col("listed.entity").alias("entity"),
    )
