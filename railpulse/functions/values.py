"""Absent values, casts that may fail, and comparable doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def zero_to_null(epoch: Column) -> Column:
    """Zero stands for "not sent" on the wire and would read as 1970."""
    return F.nullif(epoch, F.lit(0))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def safe_cast(value: Column, kind: str) -> Column:
    return value.try_cast(kind)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("long"))


def is_wet(precip_mm: Column) -> Column:
    return F.coalesce(precip_mm, F.lit(0.0)) > 0


def rounded(df: DataFrame, places: int = 9) -> DataFrame:
    """Doubles and floats rounded, so that equal results compare equal."""
    return df.select(*[
        F.round(F.col(name).cast("double"), places).alias(name)
        if kind in ("double", "float") else F.col(name)
        for name, kind in df.dtypes
    ])
