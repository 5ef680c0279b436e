"""Stop and route lists, and hourly weather, from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from railpulse.operators.weather import weather_rows
from railpulse.schema import ROUTE_COLUMNS, STOP_COLUMNS, WEATHER_SCHEMA


def _strings(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def project_published(published: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns a bundle has, absent values as empty strings.

    A column that is not published is left out. An empty list is refused: it
    would blank a dimension.
    """
    kept = published.select(*[c for c in wanted if c in published.columns])
    if kept.isEmpty():
        raise ValueError("the published list is empty")
    return kept.na.fill("")


def read_published(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """A bundle's own file, whatever columns it has, all of them strings."""
    everything = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return project_published(everything, wanted)


def write_reference(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def _read_reference(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    return (
        spark.read.option("header", True).option("enforceSchema", False)
        .schema(_strings(columns)).csv(path)
    )


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    return _read_reference(spark, path, STOP_COLUMNS)


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    return _read_reference(spark, path, ROUTE_COLUMNS)


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """Hourly rows from documents of parallel arrays."""
    documents = (
        spark.read.schema(WEATHER_SCHEMA).option("multiLine", True)
        .option("mode", "FAILFAST").json(path)
    )
    return weather_rows(documents)
