"""Seconds for the headline work over one folder of sample tables.

Prints one JSON line. ``BENCH_SF_DIR`` names the folder, ``BENCH_CPUS`` the
cores, and ``BENCH_COPIES`` how many times the landing rows are laid over each
other, each time as other trips (1 by default; 98 copies of sf0.1 are 11.2
million rows). A small warehouse is built first and not timed.

``full_*`` are the steps of a complete build into stored tables. ``incr_*`` are
those of an update that brings in the last day of rows. The others are read
queries over the stored tables, and the whole chain from landing rows to excess
wait as a single plan.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, functions as F  # noqa: E402

from railpulse.operators import quality, rain, sensitivity, sightings, summary, weather  # noqa: E402
from railpulse.operators.difference import warehouse_difference  # noqa: E402
from railpulse.operators.staging import stage  # noqa: E402
from railpulse.plans.warehouse import Warehouse, facts  # noqa: E402
from railpulse.session import local_session, scratch_path  # noqa: E402
from railpulse.sources import samples  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "1"))


def repeated(landing: DataFrame) -> DataFrame:
    """The rows once per copy, each copy with trips of its own and 41 s later."""
    if COPIES == 1:
        return landing
    moved = landing.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    for column in ("observed_at", "fetched_at", "predicted_arrival", "predicted_departure"):
        moved = moved.withColumn(column, F.col(column) + F.col("copy") * 41)
    service_date = F.date_format(F.timestamp_seconds(F.col("observed_at") - 14400), "yyyyMMdd")
    trip = F.concat("trip_id", F.lit("."), F.col("copy").cast("string"))
    return moved.withColumn("start_date", service_date).withColumn("trip_id", trip).drop("copy")


def warm_up(spark, landing: DataFrame, stops: DataFrame, routes: DataFrame) -> None:
    """Build and update a small warehouse, so that compilation is not timed."""
    first = landing.agg(F.min("observed_at")).first()[0]
    day = landing.where(F.col("observed_at") < first + 86_400)
    small = Warehouse(spark, scratch_path(spark, "bench-warm"))
    small.rebuild(day, stops, routes)
    small.update(landing.where(F.col("observed_at") < first + 100_000), stops, routes)
    quality.quality_report(small.tables()).collect()
    sensitivity.sensitivity_sweep(small.sightings()).collect()


def main() -> None:
    spark = local_session(CPUS, "bench", **{
        "spark.sql.shuffle.partitions": str(max(8, min(200, COPIES))),
    })
    seconds: dict[str, float] = {}

    def timed(name, work):
        start = time.perf_counter()
        result = work()
        if isinstance(result, DataFrame):
            result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    landed = scratch_path(spark, "bench-landing")
    repeated(samples.landing(spark, SF_DIR)).write.parquet(landed)
    landing = spark.read.parquet(landed)
    stops, routes = samples.stops(spark, SF_DIR), samples.routes(spark, SF_DIR)
    last_day = landing.agg(F.max("observed_at")).first()[0] - 86_400
    earlier = landing.where(F.col("observed_at") < last_day)
    warm_up(spark, landing, stops, routes)

    whole = Warehouse(spark, scratch_path(spark, "bench-full"))
    timed("full_staging", lambda: whole.rebuild_observations(landing))
    timed("full_last_sightings", whole.rebuild_sightings)
    timed("full_marts", lambda: whole.build_marts(stops, routes))

    parts = Warehouse(spark, scratch_path(spark, "bench-incr"))
    parts.rebuild_observations(earlier)
    parts.rebuild_sightings()
    timed("incr_staging", lambda: parts.update_observations(landing))
    timed("incr_last_sightings", parts.update_sightings)
    timed("incr_marts", lambda: parts.build_marts(stops, routes))

    tables = whole.tables()
    documents = samples.weather_documents(spark, SF_DIR)

    def chain():
        return facts(sightings.last_sightings(stage(landing), sightings.landing_watermark(landing)))["fct_excess_wait"]

    timed("excess_wait_from_landing", chain)
    timed("sensitivity_sweep", lambda: sensitivity.sensitivity_sweep(tables["int_last_sightings"]))
    timed("rain_effect", lambda: rain.rain_effect(
        tables["fct_excess_wait"], weather.weather_rows(documents)))
    timed("quality_report", lambda: quality.quality_report(tables))
    timed("worst_excess_wait", lambda: summary.worst_excess_wait(
        tables["fct_excess_wait"], tables["dim_stations"]))
    timed("warehouse_diff", lambda: warehouse_difference(
        {n: df for n, df in tables.items() if not n.startswith("dim")},
        {n: df for n, df in parts.tables(False).items()}))

    print(json.dumps({
        "metric": "reliability_build_and_queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "copies": COPIES,
        "landing_rows": landing.count(),
    }))


if __name__ == "__main__":
    main()
