"""Ordered work over keys of any size: the row before, running sums and exact percentiles, no key in one task.

A window over a key brings all rows of it to one task. Here rows are dealt by range of (key, order) instead and numbered by
range, so a key that holds most of the table is many ranges. A window then works within (range, key), and what crosses from one range
to the next is one row for each range and key: its last value, or the sum of all ranges before. Percentiles are selected, not
sorted: histograms of a key's values, added up in partial sums, narrow the bucket that holds the wanted rank until one value is
left. Results are those of the windows and of ``percentile``, rows without a key (null) included; rows of equal order are in no
set order among each other, as in a window. Keys and orders may be of any type that sorts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import cosine_distance
from ..shared import settle
from . import chunking

#: Buckets of one round of a percentile's histogram.
BUCKETS = 4096
PART = "_range"


def ranges(rows: DataFrame, key: str, order: str, n: int | None = None) -> DataFrame:
    """``rows`` dealt by range of (key, order), settled, with the number of their range in ``_range``."""
    n = n or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settle(rows.repartitionByRange(n, key, order).withColumn(PART, F.spark_partition_id()))


def _carried(dealt: DataFrame, key: str, of_range: Column, carry: Callable[[Column, Window], Column]) -> DataFrame:
    """One row for each range and key: what ``carry`` makes of ``of_range`` over the ranges of that key before it."""
    per = dealt.groupBy(PART, key).agg(of_range.alias("_own"))
    return per.select(F.col(PART).alias("_p"), F.col(key).alias("_k"), carry(F.col("_own"), Window.partitionBy(key).orderBy(PART)).alias("_carried"))


def _with_carried(dealt: DataFrame, key: str, carried: DataFrame) -> DataFrame:
    return dealt.join(carried, (F.col(PART) == F.col("_p")) & F.col(key).eqNullSafe(F.col("_k")), "left").drop("_p", "_k")


def lag(dealt: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Adds ``out``: ``value`` (not null) of the row before in the key, null on the first. ``dealt`` as ``ranges`` gives it."""
    last = F.max_by(value, order)
    both = _with_carried(dealt, key, _carried(dealt, key, last, lambda own, w: F.lag(own).over(w)))
    before = F.lag(value).over(Window.partitionBy(PART, key).orderBy(order))
    return both.withColumn(out, F.coalesce(before, "_carried")).drop("_carried")


def running_sum(dealt: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the key so far, this one included."""
    earlier = lambda own, w: F.sum(own).over(w.rowsBetween(Window.unboundedPreceding, -1))
    both = _with_carried(dealt, key, _carried(dealt, key, F.sum(value), earlier))
    own = F.sum(value).over(Window.partitionBy(PART, key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn(out, own + F.coalesce("_carried", F.lit(0))).drop("_carried")


def last_seen(dealt: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Adds ``out``: the last ``value`` of the key so far that is not null, this row's included."""
    own = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    both = _with_carried(dealt, key, _carried(dealt, key, own, lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))))
    here = F.last(value, ignorenulls=True).over(Window.partitionBy(PART, key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn(out, F.coalesce(here, "_carried")).drop("_carried")


def percentiles(rows: DataFrame, key: str, value: str, fraction: float, task_rows: int = 1 << 20) -> DataFrame:
    """``key``, ``threshold``: the exact percentile, interpolated as ``percentile`` does, of each key's values that are not null; null where it has
    none. Keys of up to ``task_rows`` values, or of up to a quarter of a partition's share, are worked out by ``percentile`` in one task each;
    the larger ones, four for each shuffle partition at most, by rounds of histograms."""
    spark = rows.sparkSession
    counts = settle(rows.groupBy(key).agg(F.count(value).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    large = counts.where(F.col("n") > max(task_rows, total // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    big = [(r[key], r["n"]) for r in large.collect()]
    if not big:
        return rows.groupBy(key).agg(F.percentile(value, F.lit(fraction)).alias("threshold"))
    kind = rows.schema[key].dataType.simpleString()
    of_big = spark.createDataFrame([(k,) for k, _ in big], f"_k {kind}")
    match = F.col(key).eqNullSafe(F.col("_k"))
    small = rows.join(F.broadcast(of_big), match, "left_anti").groupBy(key).agg(F.percentile(value, F.lit(fraction)).alias("threshold"))
    values = rows.where(F.col(value).isNotNull()).join(F.broadcast(of_big), match).select("_k", F.col(value).cast("double").alias("_x"))
    # each key is known by its number here, nulls among them
    position = {i: (n - 1) * fraction for i, (_, n) in enumerate(big)}
    bounds = {r["_k"]: (r["lo"], r["hi"]) for r in values.groupBy("_k").agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")).collect()}
    open_ = {(i, rank): (*bounds[k], 0) for i, (k, _) in enumerate(big) for rank in {int(position[i]), -int(-position[i] // 1)}}
    done: dict[tuple[int, int], float] = {}
    while open_:
        done |= {t: lo for t, (lo, hi, _) in open_.items() if lo == hi}
        open_ = {t: v for t, v in open_.items() if t not in done}
        if not open_:
            break
        wanted = spark.createDataFrame([(big[i][0], i, rank, lo, hi) for (i, rank), (lo, hi, _) in open_.items()], f"_wk {kind}, i int, rank long, lo double, hi double")
        near = values.join(F.broadcast(wanted), F.col("_k").eqNullSafe(F.col("_wk")) & F.col("_x").between(F.col("lo"), F.col("hi")))
        bucket = F.least(F.floor((F.col("_x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS), F.lit(BUCKETS - 1))
        per = near.groupBy("i", "rank", bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
        so_far = per.withColumn("upto", F.sum("n").over(Window.partitionBy("i", "rank").orderBy("b")))
        picked = so_far.join(F.broadcast(spark.createDataFrame([(i, rank, rank - less) for (i, rank), (_, _, less) in open_.items()], "i int, rank long, k long")), ["i", "rank"]).where((F.col("upto") > F.col("k")) & (F.col("upto") - F.col("n") <= F.col("k")))
        for r in picked.collect():
            less = open_[r["i"], r["rank"]][2]
            open_[r["i"], r["rank"]] = (r["lo"], r["hi"], less + r["upto"] - r["n"])
    found = []
    for i, (k, _) in enumerate(big):
        at, low, high = position[i], int(position[i]), -int(-position[i] // 1)
        a, b = done[i, low], done[i, high]
        found.append((k, a if a == b else (high - at) * a + (at - low) * b))
    return small.unionByName(spark.createDataFrame(found, f"`{key}` {kind}, threshold double"))


def fits_tasks(rows: DataFrame, key: str, task_rows: int) -> bool:
    """Whether no key has more rows than one task is to have."""
    return (rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0) <= task_rows


def breakpoints(rows: DataFrame, percentile: float, key: str, order: str, task_rows: int = 1 << 20) -> DataFrame:
    """Adds ``threshold`` (per key, null without distances), ``is_break`` (``distance`` at or above it) and ``group_no``. Where all keys fit
    tasks it does so by windows, else by ranges, with the same result."""
    if fits_tasks(rows, key, task_rows):
        return chunking.breakpoints(rows, percentile, key, order)
    dealt = ranges(rows, key, order)
    of_key = percentiles(dealt, key, "distance", percentile / 100, task_rows).select(F.col(key).alias("_tk"), "threshold")
    # thresholds go to the ranges of their key, which are few, and from there to the rows
    per_range = dealt.select(PART, key).distinct().join(of_key, F.col(key).eqNullSafe(F.col("_tk"))).select(F.col(PART).alias("_p"), F.col(key).alias("_k"), "threshold")
    marked = _with_carried(dealt, key, per_range).withColumn("is_break", F.coalesce(F.col("distance") >= F.col("threshold"), F.lit(False))).withColumn("_b", F.col("is_break").cast("int"))
    return running_sum(marked, key, order, "_b", "group_no").withColumn("group_no", F.col("group_no").cast("int")).drop("_b", PART)


def adjacent_distance(rows: DataFrame, key: str, order: str, vector: str, task_rows: int = 1 << 20) -> DataFrame:
    """Adds ``distance`` to the row before; null on the first. By windows where all keys fit tasks, else by ranges."""
    if fits_tasks(rows, key, task_rows):
        return chunking.adjacent_distance(rows, key, order, vector)
    before = lag(ranges(rows, key, order), key, order, vector, "_before")
    return before.withColumn("distance", F.when(F.col("_before").isNotNull(), cosine_distance(F.col("_before"), F.col(vector)))).drop("_before", PART)
