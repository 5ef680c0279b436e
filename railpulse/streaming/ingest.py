"""The landing zone as a stream, kept in the same warehouse.

An arrival is recorded when nothing is observed any more, and withdrawn when
its train turns up again; how far one feed has been watched says nothing about
another. A single event-time watermark with append-only output can express
neither, so each micro-batch runs the incremental update, whose state is the
stored tables. The update is idempotent: a batch repeated after a failure
changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from railpulse.operators.quality import is_stale
from railpulse.operators.staging import shape
from railpulse.params import DEFAULTS, Params
from railpulse.plans.warehouse import Warehouse
from railpulse.sources.landing import stream_landing


def follow_landing(
    spark: SparkSession,
    landing_root: str,
    warehouse_root: str,
    checkpoint: str,
    params: Params = DEFAULTS,
    max_files: int | None = None,
    every: str | None = None,
    marts: bool = True,
    stops: DataFrame | None = None,
    routes: DataFrame | None = None,
) -> StreamingQuery:
    """Keep a warehouse up to date with files as they land.

    With ``every`` (say "30 seconds") it runs on; without, it takes what is
    there in batches of ``max_files`` and stops. Neither the size of the batches
    nor the order of the files changes what the warehouse holds in the end.
    With ``marts`` every batch brings the facts up to date, and the dimensions
    if the published lists are given here or were given to the warehouse before.
    """
    Warehouse(spark, warehouse_root, params).keep_lists(stops, routes)

    def absorb(batch: DataFrame, _batch_id: int) -> None:
        warehouse = Warehouse(batch.sparkSession, warehouse_root, params)
        # Each file is seen once, so no row of it may count as too late.
        warehouse.update_sightings(warehouse.update_observations(batch, any_age=True))
        if marts:
            warehouse.build_marts()
        warehouse.finish()

    writer = (
        stream_landing(spark, landing_root, max_files)
        .writeStream.foreachBatch(absorb)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def stale_rows(landing: DataFrame) -> DataFrame:
    """Rows of feeds that stopped regenerating; works on streams and tables."""
    return shape(landing).where(is_stale()).select(
        "feed_id", "observed_at", "fetched_at", "feed_lag_seconds"
    )
