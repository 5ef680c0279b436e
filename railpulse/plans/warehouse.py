"""The warehouse: full builds, incremental updates, and the tables to query.

Two tables are kept up to date, staged observations and last sightings, and the
facts follow the second: all of them are stored by service date, no headway
crosses one, and a run writes anew the dates whose sightings it has replaced
(``stale``). All dates are written when the thresholds have changed.

An incremental run leaves the tables a rebuild would. It writes observations
first and sightings second, and notes in the progress table (``progress``) what
it is about; the next run picks up what a stopped one has left.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from railpulse.functions import clock
from railpulse.operators import arrivals as arrival_ops
from railpulse.operators import headways as headway_ops
from railpulse.operators import sightings as sighting_ops
from railpulse.operators import dimensions as dimension_ops
from railpulse.operators.keyed import BROADCAST_ROWS, join_lookup, upsert
from railpulse.operators.sightings import PAIR
from railpulse.operators.staging import NATURAL_KEY, preference_key, stage
from railpulse.params import DEFAULTS, Params
from railpulse.plans import stale, tables as t
from railpulse.plans.progress import LITERAL_DAYS, LITERAL_FEEDS, Progress, among, few
from railpulse.schema import (
    ARRIVALS_SCHEMA, EXCESS_WAIT_SCHEMA, HEADWAYS_SCHEMA, SIGHTINGS_SCHEMA, STAGED_SCHEMA,
)
from railpulse.session import prepare
from railpulse.sources.landing import landed_since

STORED_STAGED = T.StructType(STAGED_SCHEMA.fields + [T.StructField("observed_date", T.DateType())])
STORED_SIGHTINGS = T.StructType(
    SIGHTINGS_SCHEMA.fields + [T.StructField("first_seen_at", T.TimestampType())]
)
# What the dimensions need of the observations of each day.
PARTS = {
    "dim_station_parts": (
        dimension_ops.station_parts, "station_id string, route_id string, rows long, observed_date date",
    ),
    "dim_trip_parts": (
        dimension_ops.trip_parts,
        "route_id string, feed_id string, trip_id string, first timestamp, last timestamp, observed_date date",
    ),
}
FACTS = {
    "fct_arrivals": ARRIVALS_SCHEMA,
    "fct_headways": HEADWAYS_SCHEMA,
    "fct_excess_wait": EXCESS_WAIT_SCHEMA,
}


def facts(sightings: DataFrame, params: Params = DEFAULTS) -> dict[str, DataFrame]:
    """The inference view and the three facts, as plans over the sightings."""
    inferred = arrival_ops.infer_arrivals(sightings, params)
    arrived = arrival_ops.fct_arrivals(inferred, params)
    gaps = headway_ops.headways(arrived, params)
    return {
        "int_inferred_arrivals": inferred,
        "fct_arrivals": arrived,
        "fct_headways": gaps,
        "fct_excess_wait": headway_ops.excess_wait(gaps),
    }


class Warehouse:
    """Tables below one folder, on storage all executors share."""

    def __init__(self, spark: SparkSession, root: str, params: Params = DEFAULTS):
        self.spark = prepare(spark)
        self.root = root.rstrip("/")
        self.params = params
        # Two runs share no intermediate table.
        self._run = f"_work/{uuid.uuid4().hex}"

    # -- reading -----------------------------------------------------------

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _work(self, name: str) -> str:
        return self._path(f"{self._run}/{name}")

    def finish(self) -> None:
        """Remove the intermediate tables of this run."""
        t.remove(self.spark, self._path(self._run))

    def progress(self) -> Progress:
        """How far each feed has come, after anything a stopped run has left was taken up."""
        staged = self._existing(self._stored_staged())
        progress = Progress(self.spark, self.root)
        if not progress.exists():
            progress.reset(staged, self._stored_sightings())
        elif progress.unfinished() is not None:
            concerned = staged.where(F.col("observed_date").between(*map(F.lit, progress.unfinished())))
            self._refresh_parts(concerned)
            progress.recover(concerned)
        return progress

    def _stored_staged(self) -> DataFrame | None:
        return t.read_table(self.spark, self._path("stg_stop_time_updates"), STORED_STAGED)

    def _stored_sightings(self) -> DataFrame | None:
        return t.read_table(self.spark, self._path("int_last_sightings"), STORED_SIGHTINGS)

    def staged(self) -> DataFrame:
        return self._existing(self._stored_staged()).select(*STAGED_SCHEMA.fieldNames())

    def sightings(self) -> DataFrame:
        return self._existing(self._stored_sightings()).select(*SIGHTINGS_SCHEMA.fieldNames())

    def inferred_arrivals(self) -> DataFrame:
        """A view: the threshold is applied when it is read."""
        return arrival_ops.infer_arrivals(self.sightings(), self.params)

    def fact(self, name: str) -> DataFrame:
        return self._existing(self._stored_fact(name)).select(*FACTS[name].fieldNames())

    def _stored_fact(self, name: str) -> DataFrame | None:
        return t.read_table(self.spark, self._path(name), FACTS[name])

    def dimension(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def tables(self, dimensions: bool = True) -> dict[str, DataFrame]:
        found = {
            "stg_stop_time_updates": self.staged(),
            "int_last_sightings": self.sightings(),
            "int_inferred_arrivals": self.inferred_arrivals(),
            **{name: self.fact(name) for name in FACTS},
        }
        if dimensions:
            held = {n: t.read_table(self.spark, self._path(n), None) for n in ("dim_stations", "dim_routes")}
            found |= {name: df for name, df in held.items() if df is not None}
        return found

    def register_views(self) -> None:
        """Make every table available to ``spark.sql`` under its name."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    @staticmethod
    def _existing(df: DataFrame | None) -> DataFrame:
        if df is None:
            raise LookupError("the warehouse has not been built yet")
        return df

    # -- full build ----------------------------------------------------------

    def rebuild_observations(self, landing: DataFrame) -> None:
        rows = t.require_schema(stage(landing), STAGED_SCHEMA, "stg_stop_time_updates")
        progress = Progress(self.spark, self.root)
        if progress.exists():
            progress.begin_all()
        t.overwrite(_dated(rows), self._path("stg_stop_time_updates"), "observed_date")
        self._refresh_parts(self._stored_staged(), all_days=True)
        progress.reset(self._stored_staged(), None)

    def rebuild_sightings(self) -> None:
        staged, progress = self._existing(self._stored_staged()), self.progress()
        stale.all_dates(self.spark, self.root)
        found = sighting_ops.describe(
            sighting_ops.latest_by_pair(staged), progress.watermark(), keep=("first_seen_at",),
        )
        t.overwrite(found, self._path("int_last_sightings"), "service_date_raw")
        progress.sighted(self._stored_sightings())

    def rebuild(self, landing: DataFrame, stops: DataFrame | None = None, routes: DataFrame | None = None) -> None:
        """Everything from all landing rows, whatever is held."""
        self.rebuild_observations(landing)
        self.rebuild_sightings()
        self.build_marts(stops, routes)

    def build_marts(self, stops: DataFrame | None = None, routes: DataFrame | None = None) -> None:
        """Facts from the sightings, and dimensions from the newest lists given, now or before."""
        self.build_facts()
        self.keep_lists(stops, routes)
        self.build_dimensions()

    def build_facts(self) -> None:
        """Bring the facts up to date with the sightings and the thresholds.

        Only the service dates whose sightings were replaced since the facts were
        last written are derived anew; the files of all others stay as they are.
        """
        if not stale.built_with(self.spark, self.root, self.params):
            self._build_all_facts()
            return
        noted = stale.noted(self.spark, self.root)
        if noted is not None:
            self._build_facts_of(noted.dates)
            noted.clear()

    def _build_all_facts(self) -> None:
        """Each fact is read back before the next is derived, so no step repeats the one before it."""
        params = self.params
        stale.all_dates(self.spark, self.root)
        # Notes of before are covered by what is read now.
        noted = stale.noted(self.spark, self.root)
        arrived = arrival_ops.fct_arrivals(self.inferred_arrivals(), params)
        self._write_fact("fct_arrivals", arrived)
        self._write_fact("fct_headways", headway_ops.headways(self.fact("fct_arrivals"), params))
        self._write_fact("fct_excess_wait", headway_ops.excess_wait(self.fact("fct_headways")))
        if noted is not None:
            noted.clear()
        stale.note_built(self.spark, self.root, params)

    def _build_facts_of(self, dates: DataFrame) -> None:
        """The same for some service dates, each fact derived from the new rows of the one before."""
        params = self.params
        sighted = _of_service_dates(self._existing(self._stored_sightings()), dates)
        rows = arrival_ops.fct_arrivals(arrival_ops.infer_arrivals(sighted, params), params)
        for name, follow in (
            ("fct_arrivals", lambda arrived: headway_ops.headways(arrived, params)),
            ("fct_headways", headway_ops.excess_wait),
            ("fct_excess_wait", None),
        ):
            written = t.write_and_read(t.require_schema(rows, FACTS[name], name), self._work(name))
            held = _of_service_dates(self._existing(self._stored_fact(name)), dates)
            t.replace_all(written, held, self._path(name), "service_date_raw")
            rows = written if follow is None else follow(written)

    def keep_lists(self, stops: DataFrame | None = None, routes: DataFrame | None = None) -> None:
        """Store the published lists that the dimensions are built with from now on."""
        for name, given in (("ref_stops", stops), ("ref_routes", routes)):
            if given is not None:
                t.overwrite(given, self._path(name))

    def build_dimensions(self) -> None:
        """Dimensions from the stored lists and the parts of each day; no observation is read."""
        stops, routes = (t.read_table(self.spark, self._path(n), None) for n in ("ref_stops", "ref_routes"))
        if stops is not None:
            observed = dimension_ops.fold_stations(self._parts("dim_station_parts"))
            t.overwrite(dimension_ops.described_stations(stops, observed), self._path("dim_stations"))
        if routes is not None:
            observed = dimension_ops.fold_routes(self._parts("dim_trip_parts"))
            t.overwrite(dimension_ops.described_routes(routes, observed), self._path("dim_routes"))

    def _parts(self, name: str) -> DataFrame:
        schema = T.StructType.fromDDL(PARTS[name][1])
        held = t.read_table(self.spark, self._path(name), schema)
        if held is None:
            # A warehouse of before there were parts.
            self._refresh_parts(self._existing(self._stored_staged()), all_days=True)
            held = t.read_table(self.spark, self._path(name), schema)
        return held

    def _refresh_parts(self, staged: DataFrame, all_days: bool = False) -> None:
        """Fold whole days anew: what a day held before is replaced, so nothing has to be taken back."""
        for name, (fold, _) in PARTS.items():
            write = t.overwrite if all_days else t.replace_partitions
            write(fold(staged, ("observed_date",)), self._path(name), "observed_date")

    def _write_fact(self, name: str, df: DataFrame) -> None:
        t.overwrite(t.require_schema(df, FACTS[name], name), self._path(name), "service_date_raw")

    # -- incremental update --------------------------------------------------

    def landing_cutoff(self) -> int | None:
        """Epoch second to read landing rows from; None before the first build. No observation is read for it."""
        newest = None if self._stored_staged() is None else self.progress().newest()
        return None if newest is None else newest - self.params.lookback_seconds

    def _landed_since_by_feed(self, landing: DataFrame, progress: Progress) -> DataFrame:
        """Landing rows after the cutoff of their own feed; all rows of a feed that is new."""
        newest = progress.feeds().select(
            "feed_id", (clock.timestamp_to_epoch(F.col("observed_through")) - self.params.lookback_seconds).alias("_cutoff"),
        )
        known = newest.limit(LITERAL_FEEDS + 1).collect()
        if len(known) > LITERAL_FEEDS:
            named = newest.where(F.col("feed_id").isNotNull())
            joined = join_lookup(landing, named, ["feed_id"], "left")
            return joined.where(F.col("_cutoff").isNull() | (F.col("observed_at") >= F.col("_cutoff"))).drop("_cutoff")
        late = F.lit(False)
        for feed, cutoff in known:
            late = late | (F.col("feed_id").eqNullSafe(F.lit(feed)) & (F.col("observed_at") < cutoff))
        return landing.where(~late)

    def update(
        self, landing: DataFrame, stops: DataFrame | None = None, routes: DataFrame | None = None, per_feed: bool = False
    ) -> None:
        """Take in what landed since the last run, and bring everything up to date."""
        self.update_observations(landing, per_feed=per_feed)
        self.update_sightings()
        self.build_marts(stops, routes)
        self.finish()

    def update_observations(self, landing: DataFrame, any_age: bool = False, per_feed: bool = False) -> DataFrame | None:
        """Add the observations that are new; returns those looked at, None after a rebuild.

        Older than the lookback is too late, which spares reading the landing
        zone again. With ``any_age`` nothing is: for files that are seen once. Age
        is told from the newest observation of all feeds, with ``per_feed`` from
        the newest of the same feed, so that a feed delivered hours late is not lost.
        ``landing`` may be the whole landing zone or only its new files. Rows
        already held are told by their key. They stay unless an earlier fetch
        of theirs has turned up, and then only the days concerned are written
        again; new observations are appended.
        """
        stored = self._stored_staged()
        progress = None if stored is None else self.progress()
        newest = None if stored is None else progress.newest()
        if newest is None:
            self.rebuild_observations(landing)
            return None
        if per_feed and not any_age:
            landing = self._landed_since_by_feed(landing, progress)
        elif not any_age:
            landing = landed_since(landing, newest - self.params.lookback_seconds)
        recent = stage(landing)
        fresh = t.write_and_read(
            _dated(t.require_schema(recent, STAGED_SCHEMA, "stg_stop_time_updates")),
            self._work("fresh"),
        )
        span = fresh.agg(F.min("observed_at"), F.min("observed_date"), F.max("observed_date")).first()
        if span[0] is None:
            return fresh
        first_day, last_day = span[1], span[2]
        held = stored.where(F.col("observed_date").between(F.lit(first_day), F.lit(last_day)))
        # Rows of days that hold nothing are new without a look at what is held.
        held_days = few(held.select("observed_date").distinct(), LITERAL_DAYS)
        looked_for = F.lit(True) if held_days is None else F.coalesce(among("observed_date", held_days), F.lit(False))
        changes = fresh.where(~looked_for).withColumn("replaces", F.lit(False))
        if held_days is None or held_days:
            # Keys are unique on either side of this join, so no key is hot.
            marked = fresh.where(looked_for).alias("fresh").join(
                held.select(*NATURAL_KEY, preference_key().alias("held_as")).alias("held"),
                F.expr(" and ".join(f"fresh.{k} <=> held.{k}" for k in NATURAL_KEY)),
                "left",
            ).where(
                F.col("held.held_as").isNull() | (preference_key("fresh") < F.col("held.held_as"))
            ).select("fresh.*", F.col("held.held_as").isNotNull().alias("replaces"))
            changes = changes.unionByName(t.write_and_read(marked, self._work("changes")))

        if changes.isEmpty():
            return fresh
        progress.begin(changes, first_day, last_day)
        self._write_changes(changes, held)
        days = few(changes.select("observed_date").distinct(), LITERAL_DAYS)
        within = F.col("observed_date").between(F.lit(first_day), F.lit(last_day))
        written = self._stored_staged().where(within if days is None else among("observed_date", days))
        self._refresh_parts(written)
        progress.staged(changes)
        return fresh

    def _write_changes(self, changes: DataFrame, held: DataFrame) -> None:
        """Append new rows; write days again where a held row is replaced."""
        path = self._path("stg_stop_time_updates")
        replaced = changes.where("replaces")
        if replaced.isEmpty():
            t.append(changes.drop("replaces"), path, "observed_date")
            return
        days = replaced.select("observed_date").distinct()
        rewritten = upsert(
            held.join(days, "observed_date", "left_semi").select(*STORED_STAGED.fieldNames()),
            changes.join(days, "observed_date", "left_semi").select(*STORED_STAGED.fieldNames()),
            NATURAL_KEY,
        )
        added = changes.join(days, "observed_date", "left_anti").select(*STORED_STAGED.fieldNames())
        # Appended first: rows added twice by a rerun are told by their key.
        t.append(added, path, "observed_date")
        t.replace_partitions(rewritten, path, "observed_date")

    def update_sightings(self, fresh: DataFrame | None = None) -> None:
        """Recompute the pairs whose answer may have changed, from their whole history.

        ``fresh`` are observations of any age that have just come in; their
        pairs count as touched. They are all a batch had, new or not, so a batch
        that is repeated after a failure touches the same pairs.

        Touched are the pairs seen since the previous progress of their feed,
        less the lookback: those with new observations, and those that were in
        the newest snapshot and had therefore not vanished. All others were
        gone before and still are. A feed that took in nothing is left alone.

        Only days that can matter are read: those on which a changed feed was
        observed after its progress, and the days a touched pair was in sight
        before, which its sighting tells. How long other feeds have been silent
        makes no difference, nor does a gap in a feed that is back.
        """
        staged, held = self._existing(self._stored_staged()), self._stored_sightings()
        if held is None:
            self.rebuild_sightings()
            return
        progress = self.progress()
        seen, days = progress.touched(staged, self.params.incremental_lookback_hours)
        seen = seen.select(*PAIR)
        if fresh is not None:
            seen = seen.unionByName(fresh.where(sighting_ops.can_arrive()).select(*PAIR))
            days = _together(days, few(fresh.select("observed_date").distinct(), LITERAL_DAYS))
        touched = t.write_and_read(seen.distinct(), self._work("touched"))
        if touched.isEmpty():
            progress.sighted(None)
            return
        same_pair = F.expr(" and ".join(f"held.{k} <=> touched.{k}" for k in PAIR))
        in_sight = _of_service_dates(held, touched).alias("held").join(
            touched.alias("touched"), same_pair, "left_semi",
        ).select(F.explode(F.sequence(F.to_date("first_seen_at"), F.to_date("last_seen_at"))).alias("day"))
        days = _together(days, few(in_sight.distinct(), LITERAL_DAYS))

        # Only touched pairs are folded, not all of those days.
        recent = staged if days is None else staged.where(among("observed_date", days))
        history = recent.alias("held").join(touched.alias("touched"), same_pair, "left_semi")
        recomputed = t.write_and_read(
            sighting_ops.describe(sighting_ops.latest_by_pair(history), progress.watermark(), keep=("first_seen_at",)),
            self._work("recomputed"),
        )
        concerned = _of_service_dates(held, recomputed)
        # Noted first: if this run stops here, the facts are written again by the next.
        stale.note(self.root, recomputed)
        t.replace_partitions(
            upsert(
                concerned.select(*STORED_SIGHTINGS.fieldNames()),
                recomputed.select(*STORED_SIGHTINGS.fieldNames()),
                PAIR,
            ),
            self._path("int_last_sightings"), "service_date_raw",
        )
        progress.sighted(recomputed)

    # -- upkeep ----------------------------------------------------------------

    def compact(self, first_day, last_day) -> None:
        """Merge the small files that appends leave in a range of days."""
        held = self._existing(self._stored_staged()).where(
            F.col("observed_date").between(F.lit(first_day), F.lit(last_day))
        )
        t.replace_partitions(held, self._path("stg_stop_time_updates"), "observed_date")


def _of_service_dates(held: DataFrame, rows: DataFrame) -> DataFrame:
    """The held rows of the service dates that occur in ``rows``.

    A few dates become literals, which prune folders; very many become a join.
    """
    dates = rows.select("service_date_raw").distinct()
    found = dates.limit(BROADCAST_ROWS + 1).collect()
    if len(found) > BROADCAST_ROWS:
        return held.alias("held").join(
            dates.alias("dates"),
            F.expr("held.service_date_raw <=> dates.service_date_raw"),
            "left_semi",
        )
    date = F.col("service_date_raw")
    chosen = date.isin([r[0] for r in found if r[0] is not None])
    return held.where(chosen | date.isNull() if any(r[0] is None for r in found) else chosen)


def _together(days: list[date] | None, more: list[date] | None) -> list[date] | None:
    """All the days of two lists; None, which stands for too many to name, wins."""
    return None if days is None or more is None else sorted({*days, *more})


def _dated(staged: DataFrame) -> DataFrame:
    return staged.withColumn("observed_date", F.to_date("observed_at"))
