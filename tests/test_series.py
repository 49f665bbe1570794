"""Ordered work over ranges against windows over whole keys."""

import random

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import chunking, series

ROWS = "k string, o long, distance double, v array<double>"


def made(spark, n, keys, seed, spread=1.0):
    rng = random.Random(seed)
    return spark.createDataFrame([(rng.choice(keys), o, rng.choice([None, 0.5, rng.random() * spread, rng.random() ** 40]), [rng.random(), rng.random() - 0.5]) for o in range(n)], ROWS).repartition(5)


def same(got, want, columns):
    read = lambda df: sorted(map(repr, df.select(*columns).collect()))
    assert read(got) == read(want)


@pytest.mark.parametrize("keys", [["a"], ["a", "b", None], [f"k{i}" for i in range(300)]])
def test_breakpoints_are_those_of_windows(spark, keys):
    rows = made(spark, 900, keys, len(keys))
    for percentile in (0.0, 37.5, 80.0, 100.0):
        same(series.breakpoints(rows, percentile, "k", "o", task_rows=1), chunking.breakpoints(rows, percentile, "k", "o"), ["k", "o", "threshold", "is_break", "group_no"])
    same(series.adjacent_distance(rows, "k", "o", "v", task_rows=1), chunking.adjacent_distance(rows, "k", "o", "v"), ["k", "o", "distance"])


@pytest.mark.parametrize("spread", [1e-300, 1e300, 5.0])
def test_percentiles_of_uneven_values(spark, monkeypatch, spread):
    monkeypatch.setattr(series, "BUCKETS", 3)
    rows = made(spark, 500, ["a", "b"], 1, spread)
    same(series.percentiles(rows, "k", "distance", 0.731, task_rows=1), rows.groupBy("k").agg(F.percentile("distance", F.lit(0.731)).alias("threshold")), ["k", "threshold"])


def test_keys_without_values_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", 1, None, [1.0]), ("b", 1, 2.0, [0.0])], ROWS)
    assert {(r.k, r.threshold, r.is_break, r.group_no) for r in series.breakpoints(rows, 50.0, "k", "o", task_rows=0).collect()} == {("a", None, False, 0), ("b", 2.0, True, 1)}
    assert series.breakpoints(rows.where("false"), 50.0, "k", "o").count() == 0 and series.adjacent_distance(rows.where("false"), "k", "o", "v", task_rows=-1).count() == 0 and series.breakpoints(rows.where("false"), 50.0, "k", "o", task_rows=-1).count() == 0


def test_one_key_is_many_ranges(spark):
    """All rows have one key; no range, and so no task of a window, holds much more than its share."""
    rows = spark.range(40_000).select(F.lit("one").alias("k"), F.col("id").alias("o"))
    sizes = [r["count"] for r in series.ranges(rows, "k", "o", 8).groupBy(series.PART).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40_000 / 8
    summed = series.running_sum(series.ranges(rows.withColumn("x", F.lit(1)), "k", "o", 8), "k", "o", "x", "n")
    assert summed.where("n <> o + 1").count() == 0
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning({series.PART}" in plan
