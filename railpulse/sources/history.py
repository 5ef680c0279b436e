"""The landing history as a table by day, and the plan for loading it."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from railpulse.schema import LANDING_SCHEMA
from railpulse.sources.landing import FILES

_INSTANTS = ("observed_at", "fetched_at", "predicted_arrival", "predicted_departure")

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name in _INSTANTS else f.dataType)
        for f in LANDING_SCHEMA
    ]
    + [T.StructField("observed_date", T.DateType())]
)


def to_history(landing: DataFrame) -> DataFrame:
    """Epochs as instants, and the UTC date of the feed's own time."""
    instants = {c: F.timestamp_seconds(c).alias(c) for c in _INSTANTS}
    return landing.select(
        *[instants.get(f.name, F.col(f.name)) for f in LANDING_SCHEMA],
        F.to_date(F.timestamp_seconds("observed_at")).alias("observed_date"),
    )


def replace_days(landing: DataFrame, path: str, day: date | None = None) -> None:
    """Replace exactly the days present in ``landing`` (or just ``day``).

    Other days are left alone, so a load may be repeated and a backfill is a
    load. Within a day rows are clustered by route and stop, in files that
    Spark splits where a day is too large for one.
    """
    rows = to_history(landing)
    if day is not None:
        rows = rows.where(F.col("observed_date") == F.lit(day))
    (
        rows.hint("rebalance", "observed_date")
        .sortWithinPartitions("observed_date", "route_id", "stop_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("observed_date")
        .parquet(path)
    )


def read_history(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None
) -> DataFrame:
    """Rows of a range of days. A read without a range is refused."""
    if first is None and last is None:
        raise ValueError("reading the history needs a first or a last day")
    rows = spark.read.schema(HISTORY_SCHEMA).parquet(path)
    if first is not None:
        rows = rows.where(F.col("observed_date") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("observed_date") <= F.lit(last))
    return rows


def load_plan(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Files and bytes per day of the landing zone. No content is read."""
    if day is not None:
        datetime.strptime(day, "%Y-%m-%d")
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", FILES).load(root)
        .select(F.col("dt").cast("string").alias("day"), "length")
    )
    if day is not None:
        files = files.where(F.col("day") == day)
    return files.groupBy("day").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
