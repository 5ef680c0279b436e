"""The landing zone: gzipped JSON lines below ``dt=YYYY-MM-DD/hour=HH``."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from railpulse.functions import clock
from railpulse.params import DEFAULTS, Params
from railpulse.schema import LANDING_COLUMNS, LANDING_PARTITIONS, LANDING_SCHEMA, SNAPSHOT_SCHEMA

# The names Spark writes and a collector writes end alike; files still being
# written do not.
FILES = "*.gz"
READ_SCHEMA = T.StructType(LANDING_SCHEMA.fields + LANDING_PARTITIONS.fields)


def read_landing(spark: SparkSession, root: str) -> DataFrame:
    """All landing rows with their directory columns.

    The schema is given, so no file is opened to find out; a row that does not
    fit it fails the read.
    """
    return (
        spark.read.schema(READ_SCHEMA)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", FILES)
        .json(root)
        .select(*READ_SCHEMA.fieldNames())
    )


def stream_landing(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Landing rows as files arrive."""
    reader = (
        spark.readStream.schema(READ_SCHEMA)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", FILES)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(root).select(*READ_SCHEMA.fieldNames())


def landed_since(landing: DataFrame, cutoff: int | None) -> DataFrame:
    """Rows observed at or after an epoch second; everything without one.

    ``dt`` is a local date and the cutoff an instant, so whole days are skipped
    only before the day ahead of it. Both bounds are literals: the second one
    prunes directories before a file is opened.
    """
    if cutoff is None:
        return landing
    recent = landing.where(F.col("observed_at") >= cutoff)
    if "dt" in landing.columns:
        day = datetime.fromtimestamp(cutoff, timezone.utc).date() - timedelta(days=1)
        recent = recent.where(F.col("dt") >= F.lit(day))
    return recent


def with_directories(landing: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Add ``dt`` and ``hour``: the local date and hour of the feed's time."""
    observed = F.col("observed_at")
    return landing.select(
        *LANDING_COLUMNS,
        clock.landing_date(observed, params.service_zone).alias("dt"),
        clock.landing_hour(observed, params.service_zone).alias("hour"),
    )


def write_landing(landing: DataFrame, root: str, params: Params = DEFAULTS, batch: str | None = None) -> None:
    """Append rows to the landing zone. Files show up when the job commits.

    With ``batch`` they go below a folder of that name, in place of what it had,
    so the same batch written twice is there once. A landing zone has such
    folders throughout or not at all.

    Rows are gathered by directory first, in partitions that Spark splits where
    one hour is too large and merges where many are small.
    """
    (
        with_directories(landing, params)
        .hint("rebalance", "dt", "hour")
        .write.mode("append" if batch is None else "overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("dt", "hour")
        .option("compression", "gzip")
        .json(root if batch is None else f"{root}/batch={batch}")
    )


def stream_snapshots(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Nested feed messages as files arrive."""
    reader = spark.readStream.schema(SNAPSHOT_SCHEMA).option("mode", "FAILFAST")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Nested feed messages as JSON lines."""
    return spark.read.schema(SNAPSHOT_SCHEMA).option("mode", "FAILFAST").json(path)
