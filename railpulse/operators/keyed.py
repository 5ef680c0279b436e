"""Building blocks for keyed work that hold up when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

# A side of a join is broadcast only after it was seen to be this small.
BROADCAST_ROWS = 10_000
SALTS = 64


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key.

    The rank filter is applied within each input partition before the shuffle
    as well as after it, so a key with a third of all rows sends one row per
    input partition. The hash of the key leads the sort: rows are then told
    apart by one number and seldom by comparing strings.
    """
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    return (
        df.withColumn("_hash", F.xxhash64(*keys))
        .withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") == 1)
        .drop("_rank", "_hash")
    )


def measured(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame | None:
    """``df`` as a local table if it has at most ``limit`` rows, else None.

    Reads at most ``limit + 1`` rows. Instants travel as microseconds, which no
    driver time zone can bend.
    """
    instants = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    plain = df.select(*[
        F.unix_micros(c).alias(c) if c in instants else F.col(c) for c in df.columns
    ])
    rows = plain.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    local = df.sparkSession.createDataFrame(rows, plain.schema)
    return local.select(*[
        F.timestamp_micros(c).alias(c) if c in instants else F.col(c) for c in df.columns
    ])


def join_lookup(
    left: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    limit: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join a large table to a lookup that has one row per key.

    A lookup measured to be small is broadcast. A larger one is repeated under
    every salt and joined on (key, salt), so that a hot key of the large side
    is spread over ``SALTS`` tasks.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join_lookup takes inner or left, not {how!r}")
    small = measured(lookup, limit)
    if small is not None:
        return left.join(F.broadcast(small), list(on), how)
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int"))
    return spread.join(salted, [*on, "_salt"], how).drop("_salt")


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality on every key column."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def upsert(held: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Held rows whose key did not come in again, and all incoming rows.

    ``incoming`` has one row per key. Null key parts match each other, so a
    row with one is replaced and not added again on every run.
    """
    kept = held.alias("held").join(
        incoming.select(*keys).alias("incoming"),
        F.expr(" and ".join(f"held.`{k}` <=> incoming.`{k}`" for k in keys)),
        "left_anti",
    )
    return kept.unionByName(incoming)


def lag_across_slices(
    df: DataFrame,
    keys: Sequence[str],
    slice_by: Column,
    order: Sequence[str],
    value: str,
    output: str,
) -> DataFrame:
    """``lag(value)`` per key in ``order``, without one task per key.

    ``slice_by`` cuts each key's rows into consecutive stretches (it must not
    decrease along ``order``; ``order`` must be total within a key). The lag is
    taken within a stretch; the first row of a stretch gets the last value of
    the stretch before, from a table with one row per key and stretch.
    """
    sliced = df.withColumn("_slice", slice_by)
    part = [*keys, "_slice"]
    ordered = Window.partitionBy(*part).orderBy(*order)
    within = sliced.withColumn("_position", F.row_number().over(ordered)).withColumn(
        "_previous", F.lag(value).over(ordered)
    )
    ends = sliced.groupBy(*part).agg(
        F.max(F.struct(*order, F.col(value).alias("_value")))["_value"].alias("_end")
    )
    carried = ends.select(
        *part, F.lag("_end").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_carried")
    ).where(F.col("_carried").isNotNull())
    # Only the first row of a stretch asks for a carried value, so the joined
    # side has one row per (key, stretch) as well.
    rows = within.withColumn("_opens", F.when(F.col("_position") == 1, F.col("_slice")))
    carried = carried.withColumnRenamed("_slice", "_opens")
    joined = rows.join(carried, [*keys, "_opens"], "left")
    return joined.withColumn(
        output, F.when(F.col("_position") == 1, F.col("_carried")).otherwise(F.col("_previous"))
    ).drop("_slice", "_opens", "_position", "_previous", "_carried")
