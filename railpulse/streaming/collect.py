"""Nested snapshots as a stream, turned into landing rows as they arrive.

A snapshot with the header of the one fetched before it says nothing new, also
if that one came in an earlier micro-batch. All a batch has to know of those
before it is the newest header of each feed, a small table kept beside the
checkpoint, one folder for each batch.

A batch reads the headers of the batch before, writes its landing rows into a
folder of its own and then the headers it leaves. Run again after a failure, it
reads the same headers and replaces the same folders, so its rows are there
once. Files have to arrive in the order in which they were fetched; a snapshot
that comes late is compared within its batch only, and if it turns out to be a
repeat, the key of its observations tells (``operators.staging``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from railpulse.operators.snapshots import changed_headers, header_counts, last_headers, to_landing
from railpulse.params import DEFAULTS, Params
from railpulse.plans import tables as t
from railpulse.sources.landing import stream_snapshots, write_landing

_HEADERS = "feed_id string, fetched_at double, _header long"


class Collector:
    """What is kept between the batches of one checkpoint."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def name(self) -> str:
        """A name that goes with the checkpoint: batches are numbered anew with a new one."""
        held = t.read_table(self.spark, f"{self.folder}/name", "name string")
        row = None if held is None else held.first()
        if row is not None:
            return row["name"]
        made = f"c{uuid.uuid4().hex}"
        t.overwrite(self.spark.createDataFrame([(made,)], "name string").coalesce(1), f"{self.folder}/name")
        return made

    def before(self, batch: int) -> DataFrame | None:
        """Newest headers when ``batch`` began, None for the first."""
        return t.read_table(self.spark, f"{self.folder}/headers/{batch - 1}", _HEADERS) if batch else None

    def absorb(self, snapshots: DataFrame, batch: int, landing_root: str, params: Params = DEFAULTS) -> None:
        before = self.before(batch)
        if batch and before is None:
            raise LookupError(f"the headers left by batch {batch - 1} are missing from {self.folder}")
        # The files of a batch are read for their headers and for their messages, and not again for each question.
        counted = t.write_and_read(header_counts(snapshots), f"{self.folder}/counted")
        changed = t.write_and_read(changed_headers(snapshots, before, counted), f"{self.folder}/changed")
        write_landing(to_landing(snapshots, before, changed), landing_root, params, batch=f"{self.name()}-{batch}")
        t.overwrite(last_headers(snapshots, before, counted).coalesce(1), f"{self.folder}/headers/{batch}")
        if batch > 1:
            # The batch before this one is committed, and no older one can be asked for.
            t.remove(self.spark, f"{self.folder}/headers/{batch - 2}")


def follow_snapshots(
    spark: SparkSession,
    snapshots_root: str,
    landing_root: str,
    checkpoint: str,
    params: Params = DEFAULTS,
    max_files: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Land nested messages as files of them arrive; ``every`` and ``max_files`` as in ``follow_landing``.

    The landing zone must be one that only collectors write. However files fall
    into batches, it holds the rows one pass over all of them would leave.
    """
    kept = f"{checkpoint.rstrip('/')}-collector"

    def absorb(batch: DataFrame, number: int) -> None:
        Collector(batch.sparkSession, kept).absorb(batch, number, landing_root, params)

    writer = (
        stream_snapshots(spark, snapshots_root, max_files)
        .writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
