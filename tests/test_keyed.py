"""Keyed building blocks against brute force, with one key hot."""

import random

import pytest
from pyspark.sql import functions as F

from railpulse.operators import keyed


def test_first_per_key_with_a_hot_key(spark):
    generator = random.Random(7)
    rows = [(None if generator.random() < .1 else ("hot" if n % 3 else f"k{n % 20}"), generator.randrange(500), n)
            for n in range(900)]
    best = {}
    for key, at, n in rows:
        best[key] = min(best.get(key, (at, n)), (at, n))
    found = keyed.first_per_key(spark.createDataFrame(rows, "key string, at int, n int"), ["key"], [F.asc("at"), F.asc("n")])
    assert {r.key: (r.at, r.n) for r in found.collect()} == best


@pytest.mark.parametrize("how", ["inner", "left"])
def test_a_large_lookup_joins_like_a_small_one(spark, how):
    left = spark.range(300).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 7).alias("k"), "id")
    lookup = spark.createDataFrame([(i, f"v{i}") for i in range(5)], "k long, v string")
    small = keyed.join_lookup(left, lookup, ["k"], how)
    large = keyed.join_lookup(left, lookup, ["k"], how, limit=2)
    assert sorted(small.collect(), key=str) == sorted(large.select(small.columns).collect(), key=str)


def test_measured_keeps_instants_and_refuses_large_tables(spark):
    df = spark.range(3).select(F.timestamp_seconds(F.col("id") + 1_793_514_600).alias("at"), "id")
    assert keyed.measured(df, 3).orderBy("id").collect() == df.orderBy("id").collect()
    assert keyed.measured(df, 2) is None


def test_lag_across_slices_equals_a_plain_lag(spark):
    generator = random.Random(3)
    times = sorted(generator.sample(range(2000), 150))
    rows = [(("hot" if n % 3 else "cold"), t, generator.randrange(4)) for n, t in enumerate(times)]
    df = spark.createDataFrame(rows, "feed string, at int, value int")
    found = keyed.lag_across_slices(df, ["feed"], F.floor(F.col("at") / 100), ["at", "value"], "value", "before")
    expected, last = {}, {}
    for feed, at, value in rows:
        expected[feed, at] = last.get(feed)
        last[feed] = value
    assert {(r.feed, r["at"]): r.before for r in found.collect()} == expected


def test_upsert_matches_null_keys(spark):
    held = spark.createDataFrame([("a", None, 1), ("b", "x", 2)], "k string, l string, v int")
    incoming = spark.createDataFrame([("a", None, 9), ("c", "y", 3)], "k string, l string, v int")
    found = keyed.upsert(held, incoming, ["k", "l"])
    assert sorted(tuple(r) for r in found.select("k", "v").collect()) == [("a", 9), ("b", 2), ("c", 3)]
