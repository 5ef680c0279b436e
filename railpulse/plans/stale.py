"""Which service dates of the facts are behind the sightings.

Two small tables beside the facts:

* ``fct_built`` has one row, the thresholds that all facts were derived with. It
  is gone while all of them are written, so a stopped run is followed by a
  whole one.
* ``fct_stale`` has the service dates whose sightings were replaced, a folder for
  each run that did. A run notes them before it replaces anything, and they are
  removed after the facts of these dates were written. Dates noted twice, or
  noted by a run that then stopped, are derived again, which changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from railpulse.params import Params
from railpulse.plans import tables as t

_STALE = T.StructType([T.StructField("service_date_raw", T.StringType()), T.StructField("run", T.StringType())])
_BUILT = "grace long, shortest double, longest double, zone string"


def _thresholds(params: Params) -> tuple:
    return (
        int(params.arrival_grace_seconds), float(params.min_headway_minutes),
        float(params.max_headway_minutes), params.service_zone,
    )


def built_with(spark: SparkSession, root: str, params: Params) -> bool:
    """Whether all facts are there, derived with these thresholds."""
    built = t.read_table(spark, f"{root}/fct_built", _BUILT)
    return built is not None and [tuple(r) for r in built.collect()] == [_thresholds(params)]


def note_built(spark: SparkSession, root: str, params: Params) -> None:
    t.overwrite(spark.createDataFrame([_thresholds(params)], _BUILT).coalesce(1), f"{root}/fct_built")


def all_dates(spark: SparkSession, root: str) -> None:
    """From now on no fact counts as up to date."""
    t.remove(spark, f"{root}/fct_built")


def note(root: str, rows: DataFrame) -> None:
    """The service dates of ``rows`` are about to change."""
    dates = rows.select("service_date_raw").distinct()
    t.append(dates.withColumn("run", F.lit(f"run-{uuid.uuid4().hex}")), f"{root}/fct_stale", "run")


@dataclass(frozen=True)
class Noted:
    """Stale dates, and the runs that noted them."""

    spark: SparkSession
    root: str
    runs: list[str]
    dates: DataFrame

    def clear(self) -> None:
        """What was noted since then stays."""
        for run in self.runs:
            t.remove(self.spark, f"{self.root}/fct_stale/run={run}")


def noted(spark: SparkSession, root: str) -> Noted | None:
    """The dates noted so far, None if there are none."""
    held = t.read_table(spark, f"{root}/fct_stale", _STALE)
    runs = [] if held is None else [r["run"] for r in held.select("run").distinct().collect()]
    if not runs:
        return None
    return Noted(spark, root, runs, held.where(F.col("run").isin(runs)).select("service_date_raw").distinct())
