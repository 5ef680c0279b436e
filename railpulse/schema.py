"""Fixed schemas, grains and value lists.

Nothing here is inferred from data: one writer produces every landing file with
one column set, so a reader that guesses can only guess wrong.
"""

from __future__ import annotations

from pyspark.sql import types as T

# -- fixed values: the landing contract ---------------------------------------

LANDING_SCHEMA = T.StructType([
    T.StructField("feed_id", T.StringType()),
    T.StructField("observed_at", T.LongType()),
    T.StructField("fetched_at", T.LongType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("train_id", T.StringType()),
    T.StructField("is_assigned", T.BooleanType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("stop_sequence", T.LongType()),
    T.StructField("predicted_arrival", T.LongType()),
    T.StructField("predicted_departure", T.LongType()),
    T.StructField("scheduled_track", T.StringType()),
    T.StructField("actual_track", T.StringType()),
    T.StructField("schedule_relationship", T.StringType()),
])
LANDING_COLUMNS = LANDING_SCHEMA.fieldNames()

# Directory columns of the landing zone, in the service zone's clock.
LANDING_PARTITIONS = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("hour", T.IntegerType()),
])

FEED_IDS = ("numbered", "ace", "bdfm", "g", "jz", "nqrw", "l", "sir")
DIRECTION_CODES = {1: "NORTH", 2: "EAST", 3: "SOUTH", 4: "WEST"}
RELATIONSHIP_CODES = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}

STOP_COLUMNS = (
    "stop_id", "stop_name", "stop_lat", "stop_lon", "location_type", "parent_station",
)
ROUTE_COLUMNS = (
    "route_id", "route_short_name", "route_long_name",
    "route_desc", "route_color", "route_text_color",
)

# -- nested snapshots, before they are flattened ------------------------------

_TIME = T.StructType([T.StructField("time", T.LongType())])

STOP_TIME_UPDATE = T.StructType([
    T.StructField("stop_id", T.StringType()),
    T.StructField("arrival", _TIME),
    T.StructField("departure", _TIME),
    T.StructField("schedule_relationship", T.IntegerType()),
    T.StructField("ext", T.StructType([
        T.StructField("scheduled_track", T.StringType()),
        T.StructField("actual_track", T.StringType()),
    ])),
])

TRIP_UPDATE = T.StructType([
    T.StructField("trip", T.StructType([
        T.StructField("trip_id", T.StringType()),
        T.StructField("route_id", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("ext", T.StructType([
            T.StructField("train_id", T.StringType()),
            T.StructField("is_assigned", T.BooleanType()),
            T.StructField("direction", T.IntegerType()),
        ])),
    ])),
    T.StructField("stop_time_update", T.ArrayType(STOP_TIME_UPDATE)),
])

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("feed_id", T.StringType()),
    T.StructField("fetched_at", T.DoubleType()),
    T.StructField("header", T.StructType([T.StructField("timestamp", T.LongType())])),
    T.StructField("entity", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("trip_update", TRIP_UPDATE),
        T.StructField("vehicle", T.StructType([T.StructField("stop_id", T.StringType())])),
        T.StructField("alert", T.StructType([T.StructField("header_text", T.StringType())])),
    ]))),
])

# -- hourly weather, as parallel arrays ---------------------------------------

WEATHER_SCHEMA = T.StructType([
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
    ])),
])

# -- stored tables ------------------------------------------------------------

STAGED_SCHEMA = T.StructType([
    T.StructField("feed_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("platform_direction", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("service_date_raw", T.StringType()),
    T.StructField("observed_at", T.TimestampType()),
    T.StructField("fetched_at", T.TimestampType()),
    T.StructField("predicted_arrival", T.TimestampType()),
    T.StructField("predicted_departure", T.TimestampType()),
    T.StructField("feed_lag_seconds", T.LongType()),
    T.StructField("direction", T.StringType()),
    T.StructField("train_id", T.StringType()),
    T.StructField("is_assigned", T.BooleanType()),
    T.StructField("stop_sequence", T.LongType()),
    T.StructField("scheduled_track", T.StringType()),
    T.StructField("actual_track", T.StringType()),
    T.StructField("schedule_relationship", T.StringType()),
    T.StructField("trip_origin_minutes", T.DoubleType()),
])

SIGHTINGS_SCHEMA = T.StructType([
    T.StructField("service_date_raw", T.StringType()),
    T.StructField("feed_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("train_id", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("platform_direction", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("last_predicted_arrival", T.TimestampType()),
    T.StructField("last_seen_at", T.TimestampType()),
    T.StructField("lead_seconds", T.LongType()),
    T.StructField("observations_of_pair", T.LongType()),
    T.StructField("scheduled_track", T.StringType()),
    T.StructField("actual_track", T.StringType()),
    T.StructField("has_vanished", T.BooleanType()),
])

ARRIVALS_SCHEMA = T.StructType([
    T.StructField("service_date_raw", T.StringType()),
    T.StructField("feed_id", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("train_id", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("platform_direction", T.StringType()),
    T.StructField("direction", T.StringType()),
    T.StructField("inferred_arrival", T.TimestampType()),
    T.StructField("arrival_local", T.TimestampNTZType()),
    T.StructField("service_hour", T.TimestampNTZType()),
    T.StructField("hour_of_day", T.LongType()),
    T.StructField("day_of_week", T.LongType()),
    T.StructField("last_seen_at", T.TimestampType()),
    T.StructField("lead_seconds", T.LongType()),
    T.StructField("observations_of_pair", T.LongType()),
    T.StructField("scheduled_track", T.StringType()),
    T.StructField("actual_track", T.StringType()),
])

HEADWAYS_SCHEMA = T.StructType([
    T.StructField("service_date_raw", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("platform_direction", T.StringType()),
    T.StructField("trip_id", T.StringType()),
    T.StructField("previous_trip_id", T.StringType()),
    T.StructField("previous_arrival", T.TimestampType()),
    T.StructField("inferred_arrival", T.TimestampType()),
    T.StructField("arrival_local", T.TimestampNTZType()),
    T.StructField("service_hour", T.TimestampNTZType()),
    T.StructField("hour_of_day", T.LongType()),
    T.StructField("day_of_week", T.LongType()),
    T.StructField("headway_minutes", T.DoubleType()),
])

EXCESS_WAIT_SCHEMA = T.StructType([
    T.StructField("service_date_raw", T.StringType()),
    T.StructField("route_id", T.StringType()),
    T.StructField("stop_id", T.StringType()),
    T.StructField("station_id", T.StringType()),
    T.StructField("platform_direction", T.StringType()),
    T.StructField("service_hour", T.TimestampNTZType()),
    T.StructField("hour_of_day", T.LongType()),
    T.StructField("day_of_week", T.LongType()),
    T.StructField("headways", T.LongType()),
    T.StructField("mean_headway_minutes", T.DoubleType()),
    T.StructField("min_headway_minutes", T.DoubleType()),
    T.StructField("max_headway_minutes", T.DoubleType()),
    T.StructField("rider_wait_minutes", T.DoubleType()),
    T.StructField("even_wait_minutes", T.DoubleType()),
    T.StructField("excess_wait_minutes", T.DoubleType()),
])

# What makes a row unique in each table.
GRAIN = {
    "stg_stop_time_updates": ("feed_id", "observed_at", "trip_id", "stop_id"),
    "int_last_sightings": ("service_date_raw", "trip_id", "stop_id"),
    "int_inferred_arrivals": ("service_date_raw", "trip_id", "stop_id"),
    "fct_arrivals": ("service_date_raw", "trip_id", "stop_id"),
    "fct_headways": ("service_date_raw", "route_id", "stop_id", "inferred_arrival"),
    "fct_excess_wait": ("service_date_raw", "route_id", "stop_id", "service_hour"),
    "dim_stations": ("station_id",),
    "dim_routes": ("route_id",),
}
