"""Two versions of a table, or of a warehouse, compared row for row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from railpulse.functions.values import rounded


def table_difference(left: DataFrame, right: DataFrame, duplicates: bool = False) -> DataFrame:
    """Rows in one of the tables and not in the other, with their counts.

    Doubles are compared at nine places. One aggregation over both tables
    counts each distinct row on either side; equal rows meet before the shuffle
    as far as they can. Rows compare as sets, or as bags with ``duplicates``.
    """
    right = right.select(*left.columns)
    both = rounded(left).select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        rounded(right).select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counted = both.groupBy(*left.columns).agg(
        F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows")
    )
    if duplicates:
        return counted.where(F.col("left_rows") != F.col("right_rows"))
    return counted.where((F.col("left_rows") == 0) | (F.col("right_rows") == 0))


def warehouse_difference(
    left: dict[str, DataFrame], right: dict[str, DataFrame], duplicates: bool = False
) -> DataFrame:
    """Per table: how many rows are only in the left, only in the right."""
    excess = F.col("left_rows") - F.col("right_rows")
    one_sided = lambda sign: F.coalesce(
        F.sum(F.greatest(sign * excess, F.lit(0))) if duplicates
        else F.count_if(sign * excess > 0),
        F.lit(0).cast("long"),
    )
    per_table = [
        table_difference(left[name], right[name], duplicates)
        .agg(one_sided(1).alias("only_left"), one_sided(-1).alias("only_right"))
        .select(F.lit(name).alias("table_name"), "only_left", "only_right")
        for name in left
    ]
    return reduce(DataFrame.unionByName, per_table)
