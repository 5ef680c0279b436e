"""How far each feed has come: a small table kept beside the large ones.

An update has to know how far every feed was watched and what has changed since the sightings were last brought up to
date. Asking the observations would open every file of the history, so a row per feed says it:

``observed_through``   newest observation held, of any kind (the feed's watermark)
``seen_through``       newest one that predicted an arrival, as of when the sightings were last brought up to date
``changed_since``      oldest day that took in rows after that; null for a feed with none, which is then left alone
``left_over``          the same, of a run that did not get to the sightings

The table is kept twice and written in turns, so a write that stops half way leaves the other copy. Before
observations are written their days are noted. A run that finds such a note was preceded by one that stopped
there, and reads those days again, no others.

``feed_days`` is a map of the days that hold rows of a feed. It is extended before rows are written, so it
may name a day without rows and never misses one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from railpulse.functions import clock
from railpulse.operators.keyed import join_lookup, measured
from railpulse.operators.sightings import can_arrive
from railpulse.plans import tables as t

# With more feeds than this, their days are not spelt out as literals.
LITERAL_FEEDS = 200
LITERAL_DAYS = 5_000

FEED_DAYS = T.StructType([T.StructField("feed_id", T.StringType()), T.StructField("observed_date", T.DateType())])
_FEED = T.StructType([
    T.StructField("feed_id", T.StringType()),
    T.StructField("observed_through", T.TimestampType()),
    T.StructField("seen_through", T.TimestampType()),
    T.StructField("changed_since", T.DateType()),
    T.StructField("left_over", T.DateType()),
])
# A row without a feed carries the note, and makes a table of no feeds a table.
_STATE = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("is_feed", T.BooleanType()), *_FEED.fields,
    T.StructField("writing_from", T.DateType()), T.StructField("writing_to", T.DateType()),
    T.StructField("slot", T.IntegerType()),
])


class Progress:
    """The state of a warehouse, below ``root``, read once when it is made.

    Up to ``BROADCAST_ROWS`` feeds are held as a local table, so that questions about them run no job.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self._state_path, self._days_path = f"{root}/feed_progress", f"{root}/feed_days"
        self._version: int | None = None
        self._note: tuple[date | None, date | None] = (None, None)
        state = t.read_table(spark, self._state_path, _STATE)
        if state is not None:
            note = state.where("not is_feed").orderBy(F.col("version").desc()).limit(1).collect()
            if note:
                self._version, self._note = note[0].version, (note[0].writing_from, note[0].writing_to)
                held = state.where(F.col("is_feed") & (F.col("version") == self._version))
                self._feeds = _local(held.select(*_FEED.fieldNames()))

    # -- reading -----------------------------------------------------------

    def exists(self) -> bool:
        return self._version is not None

    def feeds(self) -> DataFrame:
        """A row per feed."""
        return self._feeds

    def watermark(self) -> DataFrame:
        return self._feeds.select("feed_id", "observed_through")

    def days(self) -> DataFrame:
        return t.read_table(self.spark, self._days_path, FEED_DAYS)

    def newest(self) -> int | None:
        """Epoch second of the newest observation of any feed."""
        return self._feeds.agg(clock.timestamp_to_epoch(F.max("observed_through"))).first()[0]

    # -- writing -----------------------------------------------------------

    def _write(self, feeds: DataFrame, writing: tuple[date | None, date | None] = (None, None)) -> None:
        feeds = _local(feeds.select(*_FEED.fieldNames()))
        version = 0 if self._version is None else self._version + 1
        note = self.spark.createDataFrame([(None, *writing)], "feed_id string, writing_from date, writing_to date")
        rows = feeds.withColumn("is_feed", F.lit(True)).unionByName(
            note.withColumn("is_feed", F.lit(False)), allowMissingColumns=True
        )
        complete = rows.withColumn("version", F.lit(version).cast("long")).withColumn("slot", F.lit(version % 2))
        (
            complete.select(*_STATE.fieldNames()).coalesce(1).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(self._state_path)
        )
        self._version, self._note, self._feeds = version, writing, feeds

    def _extend_days(self, rows: DataFrame) -> None:
        """Days of feeds that the map has not got yet; on most updates there are none."""
        new = _local(rows.select(*FEED_DAYS.fieldNames()).distinct()).alias("new").join(
            self.days().alias("held"),
            F.expr("new.feed_id <=> held.feed_id and new.observed_date <=> held.observed_date"), "left_anti",
        )
        new = _local(new)
        if not new.isEmpty():
            new.coalesce(1).write.mode("append").parquet(self._days_path)

    def begin(self, changes: DataFrame, first: date, last: date) -> None:
        """Note that rows of these days are about to be written."""
        self._extend_days(changes)
        self._write(self.feeds(), (first, last))

    def begin_all(self) -> None:
        """Note that any day may be written."""
        self._write(self.feeds(), (date.min, date.max))

    def staged(self, changes: DataFrame) -> None:
        """Rows have been written; ``changes`` are those rows or more of their days."""
        seen = changes.groupBy("feed_id").agg(
            F.max("observed_at").alias("newest"), F.min("observed_date").alias("oldest_day"),
        )
        merged = self.feeds().alias("old").join(seen.alias("new"), F.expr("old.feed_id <=> new.feed_id"), "full").select(
            # Only one side has a row where the other's feed is missing; a feed without a name is null on both.
            F.coalesce("old.feed_id", "new.feed_id").alias("feed_id"),
            F.greatest("observed_through", "newest").alias("observed_through"),
            "seen_through",
            F.least("changed_since", "oldest_day").alias("changed_since"),
            F.least("left_over", "changed_since").alias("left_over"),
        )
        self._write(merged)

    def sighted(self, recomputed: DataFrame | None) -> None:
        """The sightings are up to date; ``recomputed`` are those written just now."""
        feeds = self.feeds()
        if recomputed is not None:
            seen = recomputed.groupBy("feed_id").agg(F.max("last_seen_at").alias("newest"))
            feeds = feeds.alias("old").join(seen.alias("new"), F.expr("old.feed_id <=> new.feed_id"), "left").select(
                "old.feed_id", "observed_through", F.greatest("seen_through", "newest").alias("seen_through"),
            )
        self._write(feeds.withColumn("changed_since", F.lit(None).cast("date")).withColumn("left_over", F.lit(None).cast("date")))

    def reset(self, staged: DataFrame, sightings: DataFrame | None) -> None:
        """Everything anew from the tables themselves: after a rebuild, or where there is no state yet.

        Every feed counts as changed since its newest sighting, and without sightings from its first day.
        """
        feeds = staged.groupBy("feed_id").agg(
            F.max("observed_at").alias("observed_through"), F.min("observed_date").alias("first"),
        )
        if sightings is None:
            feeds = feeds.withColumn("seen_through", F.lit(None).cast("timestamp")).withColumn("left_over", F.col("first"))
        else:
            seen = sightings.groupBy("feed_id").agg(F.max("last_seen_at").alias("seen_through"))
            feeds = feeds.alias("f").join(seen.alias("s"), F.expr("f.feed_id <=> s.feed_id"), "left").select(
                "f.feed_id", "observed_through", "first", "seen_through",
            ).withColumn("left_over", F.coalesce(F.to_date("seen_through"), "first"))
        (
            staged.select(*FEED_DAYS.fieldNames()).distinct().coalesce(1)
            .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._days_path)
        )
        self._write(feeds.withColumn("changed_since", F.col("left_over")))

    def unfinished(self) -> tuple[date, date] | None:
        """The days a run was writing when it stopped; None if the last one got through."""
        first, last = self._note
        return None if first is None else (first, last)

    def recover(self, concerned: DataFrame) -> None:
        """Take up after a run that stopped while it wrote the observations of these days."""
        self.staged(concerned)
        # What that run changed is known by its days alone.
        left = self.feeds().withColumn("left_over", F.least("left_over", "changed_since"))
        self._write(left)

    # -- what an update of the sightings has to read ------------------------

    def changed(self, lookback_hours: int) -> DataFrame:
        """The changed feeds, and the instant from which their pairs may have another answer; null for all."""
        from_then = clock.shift(F.col("seen_through"), hours=-lookback_hours)
        since = F.when(F.col("seen_through").isNotNull(), F.least(from_then, F.col("left_over").cast("timestamp")))
        return self.feeds().where(F.col("changed_since").isNotNull()).select("feed_id", since.alias("since"))

    def touched(self, staged: DataFrame, lookback_hours: int) -> tuple[DataFrame, list[date] | None]:
        """Rows of pairs whose answer may have changed, and the days they were looked for in (None: too many to name)."""
        changed = self.changed(lookback_hours)
        near = F.col("c.since").isNull() | (F.col("d.observed_date") >= F.to_date("c.since"))
        places = self.days().alias("d").join(changed.alias("c"), F.expr("d.feed_id <=> c.feed_id") & near).select(
            "d.feed_id", "d.observed_date",
        )
        days = few(places.select("observed_date").distinct(), LITERAL_DAYS)
        rows = staged if days is None else staged.where(among("observed_date", days))
        by_feed = changed.limit(LITERAL_FEEDS + 1).select("feed_id", F.unix_micros("since")).collect()
        if len(by_feed) > LITERAL_FEEDS:
            known = join_lookup(rows.where(can_arrive()), changed.where(F.col("feed_id").isNotNull()), ["feed_id"])
            known = known.where(F.col("since").isNull() | (F.col("observed_at") >= F.col("since"))).drop("since")
            unnamed = rows.where(can_arrive() & F.col("feed_id").isNull())
            return known.unionByName(unnamed), days
        chosen = F.lit(False)
        for feed, micros in by_feed:
            own = F.col("feed_id").eqNullSafe(F.lit(feed))
            chosen = chosen | (own if micros is None else own & (F.col("observed_at") >= F.timestamp_micros(F.lit(micros))))
        return rows.where(chosen & can_arrive()), days


def _local(df: DataFrame) -> DataFrame:
    """``df`` as a local table if it is small, else as it is."""
    small = measured(df)
    return df if small is None else small


def few(days: DataFrame, limit: int) -> list[date] | None:
    """The days of a table of them; None if there are more than ``limit``."""
    found = [r[0] for r in days.limit(limit + 1).collect()]
    return None if len(found) > limit else sorted(found)


def among(column: str, days: list[date]) -> Column:
    """Days as literals, which prune folders before a file is opened; runs of days become ranges."""
    chosen = F.lit(False)
    start = None
    for at, day in enumerate(days):
        start = start or day
        if at + 1 == len(days) or (days[at + 1] - day).days > 1:
            chosen = chosen | F.col(column).between(F.lit(start), F.lit(day))
            start = None
    return chosen
