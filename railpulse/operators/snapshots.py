"""Feed messages: nested snapshots, before and while they become landing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from railpulse.functions import clock, identifiers
from railpulse.functions.values import empty_to_null, zero_to_null
from railpulse.operators.keyed import first_per_key, lag_across_slices, measured
from railpulse.params import DEFAULTS, Params
from railpulse.plans.tables import write_and_read
from railpulse.session import scratch_path

_DAY = 86_400


def flatten(snapshots: DataFrame) -> DataFrame:
    """One row per predicted stop, carrying its trip and its snapshot down.

    Nothing is filtered but entities that are not trip updates. A stop's
    sequence is its position in the list. Two explodes, no shuffle.
    """
    entities = snapshots.select(
        "feed_id",
        F.col("header.timestamp").alias("observed_at"),
        F.col("fetched_at").cast("long").alias("fetched_at"),
        F.explode("entity").alias("entity"),
    ).where(F.col("entity.trip_update").isNotNull())
    stops = entities.select(
        "feed_id", "observed_at", "fetched_at",
        F.col("entity.trip_update.trip").alias("trip"),
        F.posexplode("entity.trip_update.stop_time_update").alias("position", "stop"),
    )
    text = lambda path: empty_to_null(F.col(path))
    return stops.select(
        "feed_id",
        "observed_at",
        "fetched_at",
        text("trip.trip_id").alias("trip_id"),
        text("trip.route_id").alias("route_id"),
        text("trip.start_date").alias("start_date"),
        identifiers.direction_label(F.col("trip.ext.direction")).alias("direction"),
        text("trip.ext.train_id").alias("train_id"),
        F.col("trip.ext.is_assigned").alias("is_assigned"),
        text("stop.stop_id").alias("stop_id"),
        F.col("position").cast("long").alias("stop_sequence"),
        zero_to_null(F.col("stop.arrival.time")).alias("predicted_arrival"),
        zero_to_null(F.col("stop.departure.time")).alias("predicted_departure"),
        text("stop.ext.scheduled_track").alias("scheduled_track"),
        text("stop.ext.actual_track").alias("actual_track"),
        identifiers.relationship_label(F.col("stop.schedule_relationship")).alias(
            "schedule_relationship"
        ),
    )


def placed_in_time(snapshots: DataFrame) -> DataFrame:
    """Snapshots that say when they were made."""
    return snapshots.where(F.col("header.timestamp") > 0)


def header_counts(snapshots: DataFrame) -> DataFrame:
    """Feed, fetch and header of all snapshots, and how many rows have all three; the messages are not looked at."""
    return (
        placed_in_time(snapshots)
        .groupBy("feed_id", "fetched_at", F.col("header.timestamp").alias("_header"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )


def last_headers(
    snapshots: DataFrame, before: DataFrame | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Fetch and header of the newest snapshot of every feed, of ``snapshots`` and those of ``before``.

    What a later batch has to know of all batches before it, a row for each feed.
    ``counted`` are the ``header_counts`` of the snapshots, if they are stored.
    """
    if counted is None:
        counted = header_counts(snapshots)
    seen = counted.select("feed_id", "fetched_at", "_header")
    if before is not None:
        seen = seen.unionByName(before)
    newest = seen.groupBy("feed_id").agg(F.max(F.struct("fetched_at", "_header")).alias("last"))
    return newest.select("feed_id", "last.*")


def changed_headers(
    snapshots: DataFrame, before: DataFrame | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Feed, fetch and header of the snapshots to keep, and how many rows have all three.

    ``before`` are the ``last_headers`` of earlier batches: the first snapshot of
    a feed is compared with its row there. ``counted`` are the ``header_counts``
    of the snapshots, if they are stored.

    Three columns of the snapshots are read, shuffled and put in order; what
    the messages hold is not. Headers are compared day by day, with each
    day's last one carried to the next, so a feed with a long history is spread
    over its days.
    """
    headers = header_counts(snapshots) if counted is None else counted
    if before is not None:
        # No copy of these is in the batch; a row that is delivered again comes after its own.
        headers = headers.unionByName(before.withColumn("_copies", F.lit(0).cast("long")))
    order = ["fetched_at", "_header", "_copies"]
    compared = lag_across_slices(
        headers, ["feed_id"], F.floor(F.col("fetched_at") / _DAY), order, "_header", "_before"
    )
    changed = F.col("_before").isNull() | (F.col("_before") != F.col("_header"))
    return compared.where(changed & (F.col("_copies") > 0)).drop("_before")


def _with_headers(headed: DataFrame, kept: DataFrame) -> DataFrame:
    """The snapshots whose feed, fetch and header are in ``kept``, which is stored."""
    small = measured(kept)
    wanted = kept.hint("shuffle_hash") if small is None else F.broadcast(small)
    return headed.alias("all").join(wanted.alias("kept"), F.expr(
        "all.feed_id <=> kept.feed_id and all.fetched_at <=> kept.fetched_at and all._header = kept._header"
    )).select("all.*")


def suppress_repeats(
    snapshots: DataFrame, before: DataFrame | None = None, changed: DataFrame | None = None
) -> DataFrame:
    """Drop a snapshot whose header is that of the one fetched before it.

    Only consecutive repeats of a feed go; A, B, A keeps all three. Which rows
    stay is found from their headers; the messages are then read once, and
    not sorted. Of rows with the same fetch and header one stays; if there are
    such rows, the messages are read once more for them.

    ``changed`` are the ``changed_headers``, if they are stored. Otherwise the
    headers are read once and stored in the scratch folder, since each thing
    asked of them would work the snapshots out anew.
    """
    if changed is None:
        spark = snapshots.sparkSession
        counted = write_and_read(header_counts(snapshots), scratch_path(spark, "headers"))
        changed = write_and_read(
            changed_headers(snapshots, before, counted), scratch_path(spark, "changed-headers")
        )
    headed = placed_in_time(snapshots).withColumn("_header", F.col("header.timestamp"))
    copied = changed.where(F.col("_copies") > 1)
    found = _with_headers(headed, changed.where(F.col("_copies") == 1))
    if not copied.isEmpty():
        key = ["feed_id", "fetched_at", "_header"]
        first = first_per_key(_with_headers(headed, copied), key, [F.xxhash64(F.to_json("entity"))])
        found = found.unionByName(first)
    return found.drop("_header")


def to_landing(
    snapshots: DataFrame, before: DataFrame | None = None, changed: DataFrame | None = None
) -> DataFrame:
    """What a collector writes: placed, changed, flattened."""
    return flatten(suppress_repeats(snapshots, before, changed))


def snapshot_profile(snapshots: DataFrame, params: Params = DEFAULTS, next_stops: int = 5) -> DataFrame:
    """Header age, what is in a snapshot, and its longest trip in detail.

    Everything is read off the arrays of one row; the first of equally long
    trips is shown.
    """
    kinds = F.transform("entity", _kind)
    how_many = lambda kind: F.size(F.filter(kinds, lambda k: k == kind)).cast("long")
    trips = F.filter("entity", lambda e: e.trip_update.isNotNull())
    ranked = F.transform(
        trips,
        lambda e, i: F.struct(
            F.size(F.coalesce(e.trip_update.stop_time_update, F.array())).alias("stops"),
            (-i).alias("position"),
        ),
    )
    profiled = snapshots.select(
        "feed_id",
        F.col("header.timestamp").alias("observed_at"),
        F.col("fetched_at").cast("long").alias("fetched_at"),
        F.size("entity").cast("long").alias("entities"),
        how_many("trip_update").alias("trip_updates"),
        how_many("vehicle").alias("vehicles"),
        how_many("alert").alias("alerts"),
        F.array_max(ranked).alias("best"),
        trips.alias("trips"),
    )
    longest = F.get("trips", -F.col("best.position")).trip_update
    shown = profiled.withColumn("longest", longest).drop("trips")
    zone = params.service_zone
    minutes = identifiers.trip_origin_minutes(F.col("longest.trip.trip_id"))
    stop_text = lambda s: F.concat_ws(
        " ",
        s.stop_id,
        clock.clock_text(s.arrival.time, zone),
        clock.clock_text(s.departure.time, zone),
        identifiers.effective_track(empty_to_null(s.ext.actual_track), empty_to_null(s.ext.scheduled_track)),
    )
    ahead = F.slice(F.col("longest.stop_time_update"), 1, next_stops)
    return shown.select(
        "feed_id",
        "observed_at",
        "fetched_at",
        clock.clock_text(F.col("observed_at"), zone).alias("generated"),
        (F.col("fetched_at") - F.col("observed_at")).alias("age_seconds"),
        "entities", "trip_updates", "vehicles", "alerts",
        F.col("longest.trip.trip_id").alias("trip_id"),
        F.col("longest.trip.route_id").alias("route_id"),
        F.col("longest.trip.ext.train_id").alias("train_id"),
        F.when(
            F.col("longest").isNotNull(),
            F.coalesce(identifiers.direction_label(F.col("longest.trip.ext.direction")), F.lit("?")),
        ).alias("direction"),
        identifiers.origin_clock(minutes).alias("origin"),
        F.col("best.stops").cast("long").alias("stops_remaining"),
        F.array_join(F.transform(ahead, stop_text), "; ").alias("next_stops"),
    )


def _kind(entity: Column) -> Column:
    """An entity counts once, as the first of the three things it carries."""
    return (
        F.when(entity.trip_update.isNotNull(), "trip_update")
        .when(entity.vehicle.isNotNull(), "vehicle")
        .when(entity.alert.isNotNull(), "alert")
    )
