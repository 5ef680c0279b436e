"""Every operator as a named query over the sample tables.

Each takes a session and a folder and returns a frame of plain values: instants
as epoch seconds, wall clocks as text, doubles at nine places.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from railpulse.functions import clock, identifiers, values
from railpulse.operators import arrivals as arrival_ops
from railpulse.operators import dimensions, quality, rain, sensitivity, sightings, snapshots
from railpulse.operators import summary, trace, weather
from railpulse.operators.difference import warehouse_difference
from railpulse.operators.keyed import upsert
from railpulse.operators.staging import NATURAL_KEY, shape, stage
from railpulse.params import Params
from railpulse.plans import tables as stored
from railpulse.plans.warehouse import FACTS, Warehouse, facts
from railpulse.schema import LANDING_COLUMNS, LANDING_SCHEMA, ROUTE_COLUMNS, STOP_COLUMNS
from railpulse.session import prepare, scratch_path
from railpulse.sources import history, landing, reference_files, samples
from railpulse.streaming.collect import follow_snapshots
from railpulse.streaming.ingest import follow_landing, stale_rows

Query = Callable[[SparkSession, str], DataFrame]

_HOUR = "yyyy-MM-dd HH:mm:ss"


def comparable(df: DataFrame, places: int = 9) -> DataFrame:
    """Plain values, independent of time zones and of the last bits of doubles."""
    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.unix_seconds(column)
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, _HOUR)
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            shown = places if isinstance(field.dataType, T.DoubleType) else 4
            column = F.round(column.cast("double"), shown) + F.lit(0.0)
        return column.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


# -- the tables as plans over the sample rows -----------------------------------

def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples.landing(spark, sf_dir)
    return sightings.last_sightings(stage(rows), sightings.landing_watermark(rows))


def _table(name: str, params: Params = Params()) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return facts(_sightings(spark, sf_dir), params)[name]
    return build


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(samples.landing(spark, sf_dir))


def _stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_stations(samples.stops(spark, sf_dir), _staged(spark, sf_dir))


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Copies do not change what is observed of a route.
    return dimensions.dim_routes(samples.routes(spark, sf_dir), shape(samples.landing(spark, sf_dir)))


def _weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather.weather_rows(samples.weather_documents(spark, sf_dir))


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    seen = _sightings(spark, sf_dir)
    return {
        "stg_stop_time_updates": _staged(spark, sf_dir),
        "int_last_sightings": seen,
        **facts(seen),
        "dim_stations": _stations(spark, sf_dir),
        "dim_routes": _routes(spark, sf_dir),
    }


# -- functions ------------------------------------------------------------------

def identifier_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id and name in the tables, with and without a direction letter."""
    rows = samples.landing(spark, sf_dir)
    texts = (
        rows.select(F.col("trip_id").alias("text"))
        .union(rows.select("stop_id"))
        .union(samples.stops(spark, sf_dir).select(F.explode(F.array(*STOP_COLUMNS))))
        .union(samples.routes(spark, sf_dir).select(F.explode(F.array(*ROUTE_COLUMNS))))
        .distinct()
    )
    text = F.col("text")
    minutes = identifiers.trip_origin_minutes(text)
    code = F.length(text) % 6
    return texts.select(
        text,
        identifiers.station_of(text).alias("station_id"),
        identifiers.direction_of(text).alias("platform_direction"),
        minutes.alias("origin_minutes"),
        identifiers.origin_clock(minutes).alias("origin"),
        identifiers.colour(text).alias("colour"),
        identifiers.direction_label(code).alias("direction"),
        identifiers.relationship_label(code).alias("relationship"),
        identifiers.effective_track(values.empty_to_null(text), F.lit("1")).alias("track"),
        values.empty_to_null(text).alias("text_or_null"),
        values.zero_to_null(code).cast("long").alias("code_or_null"),
        values.zero_if_null(code.cast("long")).alias("code_or_zero"),
        values.safe_cast(text, "double").alias("number"),
    )


def clock_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants of the tables, also moved to where daylight saving begins and ends."""
    moved = F.explode(F.array(*[F.lit(d * 86_400) for d in (0, 60, 300)]))
    seconds = (
        samples.landing(spark, sf_dir)
        .select("observed_at", "fetched_at", moved.alias("moved"))
        .select(
            (F.col("observed_at") + F.col("moved")).alias("epoch"),
            (F.col("fetched_at") + F.col("moved")).alias("later"),
        ).distinct()
    )
    instant = clock.epoch_to_timestamp(F.col("epoch"))
    local = clock.to_local(instant, samples.ZONE)
    return seconds.select(
        "epoch",
        "later",
        clock.timestamp_to_epoch(instant).alias("round_trip"),
        clock.seconds_between(instant, clock.epoch_to_timestamp(F.col("later"))).alias("seconds"),
        clock.shift(instant, hours=-3).alias("three_hours_before"),
        clock.shift(instant, seconds=120).alias("two_minutes_after"),
        local.alias("local"),
        clock.hour_floor(local).alias("hour_start"),
        clock.hour_of_day(local).alias("hour_of_day"),
        clock.day_of_week(local).alias("day_of_week"),
        clock.landing_date(F.col("epoch"), samples.ZONE).alias("dt"),
        clock.landing_hour(F.col("epoch"), samples.ZONE).alias("hour"),
        clock.clock_text(F.col("epoch"), samples.ZONE).alias("clock"),
    )


# -- dimensions, summaries --------------------------------------------------------

def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.table_counts(_tables(spark, sf_dir))


def worst_excess_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    waits = _table("fct_excess_wait")(spark, sf_dir)
    return summary.worst_excess_wait(waits, _stations(spark, sf_dir))


# -- sweep, rain -----------------------------------------------------------------

def sensitivity_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensitivity.sensitivity_sweep(_sightings(spark, sf_dir))


def rain_effect(spark: SparkSession, sf_dir: str, min_headways: int = 1) -> DataFrame:
    waits = _table("fct_excess_wait")(spark, sf_dir)
    return rain.rain_effect(waits, _weather(spark, sf_dir), min_headways=min_headways)


def rain_p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rain.with_p_values(rain_effect(spark, sf_dir)).select("route_id", "p_value")


# -- quality ----------------------------------------------------------------------

def _row_report(*kinds: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.row_report(_tables(spark, sf_dir), quality.row_checks(), kinds)
    return build


def dq_repeated_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that landed more than once: what staging removes."""
    return quality.repeated_keys(shape(samples.landing(spark, sf_dir)), NATURAL_KEY)


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations of arrivals that the stop list does not publish."""
    published = dimensions.published_stations(samples.stops(spark, sf_dir))
    return quality.orphans(_table("fct_arrivals")(spark, sf_dir), "station_id", published, "station_id")


def dq_grace_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrivals at a grace of 240 s that the default of 120 s does not allow."""
    generous = _table("fct_arrivals", Params(arrival_grace_seconds=240))(spark, sf_dir)
    return quality.violations(generous, quality.is_beyond_grace()).select(
        "trip_id", "stop_id", "last_seen_at", "inferred_arrival", "lead_seconds"
    )


def dq_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings in the newest snapshot of their feed; none may be an arrival."""
    return quality.arrivals_from_newest_snapshot(
        _sightings(spark, sf_dir), shape(samples.landing(spark, sf_dir))
    )


# -- incremental, streaming -------------------------------------------------------

# Sittings end at these moments of the sample month, as epoch seconds.
_SITTINGS = (1_704_700_000, 1_705_700_000)


def _sitting(rows: DataFrame, number: int) -> DataFrame:
    low = _SITTINGS[number - 1] if number else None
    high = _SITTINGS[number] if number < len(_SITTINGS) else None
    if low is not None:
        rows = rows.where(F.col("observed_at") >= low)
    return rows if high is None else rows.where(F.col("observed_at") < high)


def _in_three_sittings(spark: SparkSession, sf_dir: str, marts: bool = False) -> Warehouse:
    """A warehouse that saw the landing zone grow twice."""
    warehouse = Warehouse(spark, scratch_path(spark, "sittings"))
    rows = samples.landing(spark, sf_dir)
    for seen in (
        _sitting(rows, 0), rows.where(F.col("observed_at") < _SITTINGS[1]), rows,
    ):
        warehouse.update_observations(seen)
        warehouse.update_sightings()
    if marts:
        warehouse.build_marts(samples.stops(spark, sf_dir), samples.routes(spark, sf_dir))
    return warehouse


def incremental_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_three_sittings(spark, sf_dir).staged()


def incremental_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_three_sittings(spark, sf_dir).sightings()


def incremental_excess_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_three_sittings(spark, sf_dir, marts=True).fact("fct_excess_wait")


def _incremental_dimension(name: str) -> Query:
    """A dimension folded from the parts of each day, after three sittings that were given the lists at the first."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse(spark, scratch_path(spark, "dimensions"))
        warehouse.keep_lists(samples.stops(spark, sf_dir), samples.routes(spark, sf_dir))
        rows = samples.landing(spark, sf_dir)
        for seen in (_sitting(rows, 0), rows.where(F.col("observed_at") < _SITTINGS[1]), rows):
            warehouse.update_observations(seen)
        warehouse.build_dimensions()
        return warehouse.dimension(name)

    return build


def stream_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations as a stream keeps them, the lists given once."""
    prepare(spark)
    root = scratch_path(spark, "stream-dimensions")
    landing.write_landing(samples.landing(spark, sf_dir), f"{root}/landing")
    follow_landing(
        spark, f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint", max_files=400,
        stops=samples.stops(spark, sf_dir), routes=samples.routes(spark, sf_dir),
    ).awaitTermination()
    return Warehouse(spark, f"{root}/warehouse").dimension("dim_stations")


def touched_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second sitting would look at again."""
    rows = samples.landing(spark, sf_dir)
    first = _sitting(rows, 0)
    held = sightings.last_sightings(stage(first), sightings.landing_watermark(first))
    return sightings.touched_pairs(shape(rows), held, Params().incremental_lookback_hours)


def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings after one sitting, replaced and extended by those after all."""
    rows = samples.landing(spark, sf_dir)
    first = rows.where(F.col("observed_at") < _SITTINGS[0])
    last = rows.where(F.col("observed_at") >= _SITTINGS[0])
    held = sightings.last_sightings(stage(first), sightings.landing_watermark(first))
    incoming = sightings.last_sightings(stage(last), sightings.landing_watermark(last))
    return upsert(held, incoming, sightings.PAIR)


def warehouse_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The default threshold against a grace of 240 s, table by table."""
    seen = _sightings(spark, sf_dir)
    return warehouse_difference(facts(seen), facts(seen, Params(arrival_grace_seconds=240)))


def incremental_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sittings against one pass: nothing may differ."""
    names = ("stg_stop_time_updates", "int_last_sightings", "fct_arrivals", "fct_headways", "fct_excess_wait")
    staged_in_parts = _in_three_sittings(spark, sf_dir, marts=True).tables(dimensions=False)
    whole = Warehouse(spark, scratch_path(spark, "rebuild"))
    whole.rebuild(samples.landing(spark, sf_dir))
    rebuilt = whole.tables(dimensions=False)
    return warehouse_difference(
        {n: staged_in_parts[n] for n in names}, {n: rebuilt[n] for n in names}
    )


def stream_last_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files arriving in three sittings, followed by one stream."""
    prepare(spark)
    root = scratch_path(spark, "stream")
    rows = samples.landing(spark, sf_dir)
    for number in range(3):
        landing.write_landing(_sitting(rows, number), f"{root}/landing")
        follow_landing(
            spark, f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint", marts=False
        ).awaitTermination()
    return Warehouse(spark, f"{root}/warehouse").sightings()


def stream_backlog_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of landing files, the newest days written first, taken in over several micro-batches."""
    prepare(spark)
    root = scratch_path(spark, "backlog")
    rows = samples.landing(spark, sf_dir)
    for number in (2, 0, 1):
        landing.write_landing(_sitting(rows, number), f"{root}/landing")
    follow_landing(
        spark, f"{root}/landing", f"{root}/warehouse", f"{root}/checkpoint", max_files=300, marts=False
    ).awaitTermination()
    return Warehouse(spark, f"{root}/warehouse").sightings()


def repeated_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's last batch, absorbed again after its commit was lost."""
    warehouse = _in_three_sittings(spark, sf_dir)
    last = _sitting(samples.landing(spark, sf_dir), 2)
    warehouse.update_sightings(warehouse.update_observations(last, any_age=True))
    return warehouse.sightings()


def stream_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing rows of nested snapshots that arrive in three portions, the stream started again for each."""
    prepare(spark)
    root = scratch_path(spark, "collector")
    # Made once, not for each portion.
    messages = stored.write_and_read(samples.snapshots(spark, sf_dir), f"{root}/made")
    fetched = F.col("fetched_at")
    for part in (
        fetched < _SITTINGS[0], fetched.between(_SITTINGS[0], _SITTINGS[1]), fetched > _SITTINGS[1],
    ):
        messages.where(part).write.mode("append").json(f"{root}/messages")
        follow_snapshots(spark, f"{root}/messages", f"{root}/landing", f"{root}/checkpoint").awaitTermination()
    return landing.read_landing(spark, f"{root}/landing").select(*LANDING_COLUMNS)


def incremental_fact_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every fact by service date, each sitting writing only the dates it changed."""
    warehouse = Warehouse(spark, scratch_path(spark, "fact-dates"))
    rows = samples.landing(spark, sf_dir)
    for number in (0, 1, 2):
        seen = rows if number == 2 else rows.where(F.col("observed_at") < _SITTINGS[number])
        warehouse.update_observations(seen)
        warehouse.update_sightings()
        warehouse.build_facts()
    counted = [
        warehouse.fact(name).groupBy("service_date_raw").agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "service_date_raw", "row_count")
        for name in FACTS
    ]
    return functools.reduce(DataFrame.unionByName, counted)


def too_late_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is held when the middle sitting lands after the last one: older than the lookback, it is not taken in."""
    rows = samples.landing(spark, sf_dir)
    middle = F.col("observed_at").between(_SITTINGS[0], _SITTINGS[1] - 1)
    warehouse = Warehouse(spark, scratch_path(spark, "late"))
    warehouse.update_observations(rows.where(~middle))
    warehouse.update_observations(rows)
    return warehouse.staged()


def late_feed_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed delivered days late; a cutoff of its own for each feed loses none of it."""
    rows = samples.landing(spark, sf_dir)
    late = (F.col("feed_id") == "click") & (F.col("observed_at") >= _SITTINGS[0])
    warehouse = Warehouse(spark, scratch_path(spark, "late-feed"))
    for seen in (rows.where(~late), rows):
        warehouse.update_observations(seen, per_feed=True)
        warehouse.update_sightings()
    return warehouse.sightings()


# -- snapshots, traces -------------------------------------------------------------

def suppress_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.suppress_repeats(samples.snapshots(spark, sf_dir)).select(
        "feed_id", F.col("header.timestamp").alias("observed_at"), "fetched_at",
        F.size("entity").cast("long").alias("entities"),
    )


def trace_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples.landing(spark, sf_dir)
    return trace.trace_matrix(rows, trace.busiest_trips(rows))


# -- sources and sinks ---------------------------------------------------------------

def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    landing.write_landing(samples.landing(spark, sf_dir), root)
    return landing.read_landing(spark, root)


def landed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.landed_since(landing_roundtrip(spark, sf_dir), _SITTINGS[1])


def day_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days loaded twice, the second time without the copies of some of them."""
    path = scratch_path(spark, "history")
    rows = samples.landing(spark, sf_dir)
    history.replace_days(rows, path)
    again = stage(rows.where(F.col("observed_at") >= _SITTINGS[1])).select(
        *[
            (F.unix_seconds(f.name) if f.name.endswith("_at") or f.name.startswith("predicted_")
             else F.col("service_date_raw" if f.name == "start_date" else f.name)).alias(f.name)
            for f in LANDING_SCHEMA
        ]
    )
    # The first of these days is only partly in the second load.
    history.replace_days(again, path)
    whole = history.read_history(spark, path, first=_day(0))
    return whole.groupBy("observed_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.unix_seconds("fetched_at") - F.unix_seconds("observed_at")).alias("lag"),
    )


def _day(epoch: int):
    from datetime import datetime, timezone
    return datetime.fromtimestamp(epoch, timezone.utc).date()


def history_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "history")
    history.replace_days(samples.landing(spark, sf_dir), path)
    return history.read_history(spark, path, _day(_SITTINGS[0]), _day(_SITTINGS[1]))


def history_one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day out of all landing rows, loaded and read back."""
    path = scratch_path(spark, "history")
    day = _day(_SITTINGS[1])
    history.replace_days(samples.landing(spark, sf_dir), path, day)
    return history.read_history(spark, path, first=_day(0))


def load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "landing")
    landing.write_landing(samples.landing(spark, sf_dir), root)
    return history.load_plan(spark, root)


def reference_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route list written, read back, and cut to the columns it has."""
    path = scratch_path(spark, "routes")
    published = samples.routes(spark, sf_dir).drop("route_text_color").withColumn("agency_id", F.lit("x"))
    reference_files.write_reference(reference_files.project_published(published, ROUTE_COLUMNS), path)
    return reference_files.read_published(spark, path, ROUTE_COLUMNS)


def reference_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stops")
    reference_files.write_reference(samples.stops(spark, sf_dir), path)
    return reference_files.read_stops(spark, path).na.fill("")


def weather_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents written as JSON and read back as rows."""
    path = scratch_path(spark, "weather")
    samples.weather_documents(spark, sf_dir).write.json(path)
    return weather.weather_summary(_json_weather(spark, path))


def _json_weather(spark: SparkSession, path: str) -> DataFrame:
    from railpulse.schema import WEATHER_SCHEMA
    return weather.weather_rows(spark.read.schema(WEATHER_SCHEMA).json(path))


def _over_landing(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(samples.landing(spark, sf_dir))


def _over_snapshots(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(samples.snapshots(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "identifier_functions": identifier_functions,
    "clock_functions": clock_functions,
    "stage_dedup": _staged,
    "feed_watermark": _over_landing(sightings.landing_watermark),
    "last_sightings": _sightings,
    "inferred_arrivals": _table("int_inferred_arrivals"),
    "fct_arrivals": _table("fct_arrivals"),
    "fct_headways": _table("fct_headways"),
    "fct_excess_wait": _table("fct_excess_wait"),
    "dim_stations": _stations,
    "dim_routes": _routes,
    "top_routes": lambda s, d: summary.top_routes(_table("fct_arrivals")(s, d)),
    "worst_excess_wait": worst_excess_wait,
    "observation_span": _over_landing(lambda rows: summary.observation_span(shape(rows))),
    "table_counts": table_counts,
    "unpublished_stations": lambda s, d: summary.unpublished_stations(_stations(s, d)),
    "sensitivity_sweep": sensitivity_sweep,
    "sensitivity_swing": lambda s, d: sensitivity.sensitivity_swing(sensitivity_sweep(s, d)),
    "weather_rows": _weather,
    "weather_summary": lambda s, d: weather.weather_summary(_weather(s, d)),
    "weather_file": weather_file,
    "rain_effect": rain_effect,
    "rain_effect_min3": functools.partial(rain_effect, min_headways=3),
    "rain_p_values": rain_p_values,
    "dq_unique": lambda s, d: quality.unique_report(_tables(s, d)),
    "dq_not_null": _row_report("not_null"),
    "dq_between": _row_report("between"),
    "dq_accepted_values": _row_report("accepted_values"),
    "dq_relationships": lambda s, d: quality.relationship_report(_tables(s, d)),
    "dq_vanish": lambda s, d: quality.vanish_report(_tables(s, d)),
    "dq_grace": _row_report("within_grace"),
    "dq_non_negative": _row_report("non_negative"),
    "dq_feed_lag": _row_report("feed_lag"),
    "dq_repeated_observations": dq_repeated_observations,
    "dq_orphans": dq_orphans,
    "dq_grace_changed": dq_grace_changed,
    "dq_pending": dq_pending,
    "feed_freshness": _over_landing(lambda rows: stale_rows(
        rows.withColumn("fetched_at", F.col("fetched_at") + (F.col("stop_sequence") - 2) * 40)
    )),
    "touched_pairs": touched_pairs,
    "upsert_rows": upsert_rows,
    "incremental_stage": incremental_stage,
    "incremental_sightings": incremental_sightings,
    "incremental_excess_wait": incremental_excess_wait,
    "incremental_diff": incremental_diff,
    "stream_last_sightings": stream_last_sightings,
    "warehouse_diff": warehouse_diff,
    "flatten_snapshots": _over_snapshots(snapshots.flatten),
    "suppress_repeats": suppress_repeats,
    "snapshots_to_landing": _over_snapshots(snapshots.to_landing),
    "snapshot_profile": _over_snapshots(snapshots.snapshot_profile),
    "prediction_trace": _over_landing(trace.prediction_trace),
    "trace_matrix": trace_matrix,
    "landing_roundtrip": landing_roundtrip,
    "landed_since": landed_since,
    "day_replace": day_replace,
    "history_range": history_range,
    "history_one_day": history_one_day,
    "load_plan": load_plan,
    "stream_backlog_in_batches": stream_backlog_in_batches,
    "repeated_batch": repeated_batch,
    "stream_snapshots": stream_snapshots,
    "incremental_fact_dates": incremental_fact_dates,
    "incremental_dim_stations": _incremental_dimension("dim_stations"),
    "incremental_dim_routes": _incremental_dimension("dim_routes"),
    "stream_dimensions": stream_dimensions,
    "too_late_observations": too_late_observations,
    "late_feed_sightings": late_feed_sightings,
    "reference_csv": reference_csv,
    "reference_stops": reference_stops,
}

# Robust standard errors pass through more arithmetic before they are compared.
_PLACES = {"rain_effect": 6, "rain_effect_min3": 6, "rain_p_values": 6}


def registered() -> dict[str, Query]:
    def plain(name: str, query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return comparable(query(spark, str(sf_dir).rstrip("/")), _PLACES.get(name, 9))
        return run

    return {name: plain(name, query) for name, query in QUERIES.items()}
