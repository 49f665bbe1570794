"""Approximate nearest neighbours by cosine, over several shifted Hilbert orderings.

Distinct vectors are projected on a few random directions, once for each of ``curves`` orderings with directions and
shift of its own, and placed along a Hilbert curve. Each ordering is cut by range into blocks of about
``block`` vectors. A query reads the blocks of a window around its own place in every ordering; each block
gives its best classes (equal cosines by the class's smallest id), and what all windows found is merged and reranked by the exact cosine in double
precision.

The directions' scale, the cuts and the width of the windows come from a bounded sample: the width is
the least one with which queries of the sample find ``aim`` of their true neighbours of the sample. The nearer
neighbours are, the narrower the windows: on clustered vectors they hold a small part of the table, on vectors
without structure most of it, since no ordering keeps those together. All vectors are indexed.

Vectors that are null, zero, or hold null or non-finite components, and those of another length than most,
take no part; nor do rows with a null id. Equal vectors form one class, of which the smallest ``k`` + 1 ids are carried, so
copies cost nothing and ties go to smaller ids. An id on several rows counts with each of its vectors and is
returned once, with the best. A block that many vectors with one key make too large is split further. An empty table gives
no rows. Only the id and the vector are read, so no other column can clash; ids must be integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, partitions

DIMS, LEVELS = 6, 7
ROUNDING = 1e-9
WIDTHS = (0.01, 0.02, 0.04, 0.08, 0.12, 0.16, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8, 1.0)


def hilbert(cells: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (rows, dims), integers under 2**levels."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (levels - 1)
    while q > 1:  # undo the curve's rotations and reflections, from the coarsest level down
        p = q - 1
        for i in range(dims):
            flip = (x[i] & q) != 0
            t = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (levels - 1)
    while q > 1:
        t = np.where((x[dims - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    x ^= t
    for level in range(levels - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


class Orderings:
    """Directions, scales and shifts of all curves."""

    def __init__(self, sample: np.ndarray, curves: int, seed: int = 0) -> None:
        rng, d = np.random.default_rng(seed), sample.shape[1]
        dims = min(DIMS, d)
        self.directions = np.stack([np.linalg.qr(rng.normal(size=(d, dims)))[0] for _ in range(curves)])
        # projections take their ranks in the sample, so cells are about equally full
        steps = np.linspace(0, 1, (1 << LEVELS) + 1)[1:-1]
        self.cuts = np.stack([np.quantile(sample @ m, steps, axis=0).T for m in self.directions])
        self.shifts = rng.integers(0, 1 << (LEVELS - 1), (curves, dims))

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """(curves, rows)"""
        out = np.empty((len(self.directions), len(unit)), np.int64)
        for c, m in enumerate(self.directions):
            y = unit @ m
            cells = np.column_stack([np.searchsorted(cut, y[:, j]) for j, cut in enumerate(self.cuts[c])]) + self.shifts[c]
            out[c] = hilbert(cells, LEVELS + 1)
        return out


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row, summed in order in double precision: one pair gives one result wherever it is met."""
    dot, a, b = ((v * w).cumsum(axis=1)[:, -1] for v, w in ((q, c), (q, q), (c, c)))
    return dot / (np.sqrt(a) * np.sqrt(b))


def window_width(unit: np.ndarray, keys: np.ndarray, k: int, aim: float, queries: int = 256) -> float:
    """Least of WIDTHS, as a share of each ordering, that finds ``aim`` of the sample's own neighbours."""
    n = len(unit)
    asked = np.linspace(0, n - 1, min(queries, n)).astype(np.int64)
    near = unit[asked] @ unit.T
    near[np.arange(len(asked)), asked] = -2
    best = np.argsort(-near, axis=1)[:, : min(k, n - 1)]
    rank = np.argsort(np.argsort(keys, axis=1, kind="stable"), axis=1)
    apart = np.abs(rank[:, asked, None] - rank[:, best]).min(axis=0) / n  # in the ordering where they are closest
    return next((w for w in WIDTHS if (apart <= w / 2).mean() >= aim), 1.0)


def nearest(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, curves: int = 8, block: int = 2048, aim: float = 0.95, sample: int = 8192) -> DataFrame:
    """``queries``: a condition on ``vectors`` that picks the query rows. Returns query_id, rank (from 1), vec_id, score:
    for each query its ``k`` nearest among all other ids, ties to the smaller id."""
    spark, n_parts = vectors.sparkSession, partitions(vectors.sparkSession)
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    given = vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).where(fine).select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    size = given.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = given.where(F.size("v") == size["d"]).withColumn("h", F.xxhash64("v")).withColumn("h2", F.hash("v"))
    # the smallest ids of each class; the limit works before the shuffle too, so a class of any size is small here
    first = rows.dropDuplicates(["h", "h2", "id"]).withColumn("r", F.row_number().over(Window.partitionBy("h", "h2").orderBy("id"))).where(F.col("r") <= k + 1)
    classes = materialize(first.groupBy("h", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v")).withColumn("least", F.col("ids")[0]))
    asking = rows.where("asks").select("id", "h", "h2").distinct()
    asked = classes.join(asking.select("h", "h2").distinct(), ["h", "h2"], "left_semi")
    n = classes.count()
    drawn = classes.orderBy(F.xxhash64("h", F.lit("draw")), "h2").limit(sample).select("v").toArrow().column(0)
    unit = _units(np.array(drawn.combine_chunks().flatten()).reshape(-1, size["d"]))
    orders = Orderings(unit, curves)
    keys = orders.keys(unit)
    width = window_width(unit, keys, k, aim)
    blocks = max(1, -(-n // block))
    cuts = np.quantile(keys, np.arange(1, blocks) / blocks, axis=1).T if blocks > 1 else np.empty((curves, 0))  # (curves, blocks - 1)
    reach = width / 2
    ranked = np.sort(keys, axis=1)
    shared = spark.sparkContext.broadcast((orders, cuts, ranked))

    def place(windows: bool):
        """Rows (curve, block) of each vector; for queries, of every block that their window touches."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            o, cut, rank = shared.value
            for b in batches:
                x = np.array(b.column(2).flatten()).reshape(b.num_rows, -1)
                if not len(x):
                    continue
                for c, key in enumerate(o.keys(_units(x))):
                    if windows:
                        at = (np.searchsorted(rank[c], key, "left") + np.searchsorted(rank[c], key, "right")) / 2 / rank.shape[1]
                        lo, hi = (np.clip(((at + s * reach) * len_blocks).astype(np.int64), 0, len_blocks - 1) for s in (-1, 1))
                        own = np.searchsorted(cut[c], key, "right")
                        lo, hi = np.minimum(lo, own), np.maximum(hi, own)
                    else:
                        lo = hi = np.searchsorted(cut[c], key, "right")
                    many = hi - lo + 1
                    row = np.repeat(np.arange(len(key)), many)
                    which = lo[row] + np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                    for s in range(0, len(row), 4096):
                        r = pa.array(row[s : s + 4096])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(r), c, np.int32)), pa.array(which[s : s + 4096].astype(np.int32)), b.column(0).take(r), b.column(1).take(r), b.column(2).take(r), b.column(3).take(r)], names=["curve", "block", "h", "h2", "v", "least"])

        len_blocks = blocks
        return run

    kind = "curve int, block int, h long, h2 int, v array<double>, least long"
    base = classes.select("h", "h2", "v", "least").mapInArrow(place(False), kind)
    # a block is dealt to as many tasks as its size asks for; a query goes to each of them
    sizes = materialize(base.groupBy("curve", "block").agg(F.ceil(F.count(F.lit(1)) / (2 * block)).cast("int").alias("parts")))
    held = base.join(F.broadcast(sizes) if blocks * curves <= 100_000 else sizes, ["curve", "block"]).withColumn("part", F.pmod(F.xxhash64("h", "h2"), F.col("parts")).cast("int"))
    tests = asked.select("h", "h2", "v", "least").mapInArrow(place(True), kind).join(F.broadcast(sizes) if blocks * curves <= 100_000 else sizes, ["curve", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = ["curve", "block", "part"]
    dealt = held.select(*columns, F.lit(0).alias("side"), "h", "h2", "v", "least").union(tests.select(*columns, F.lit(1).alias("side"), "h", "h2", "v", "least")).repartition(n_parts, *columns).sortWithinPartitions(*columns, "side")
    # of classes in order of score and smallest id, the first k + 1 hold the first k + 1 ids
    most = k + 1

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's vectors come first and stay; its queries stream past them."""
        now, base_parts, block_x, names = None, [], None, None
        for b in batches:
            key = np.column_stack([b.column(i).to_numpy() for i in range(3)])
            side, h, h2 = (b.column(i).to_numpy() for i in range(3, 6))
            x, least = np.array(b.column(6).flatten()).reshape(b.num_rows, -1), b.column(7).to_numpy()
            change = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1) | (side[1:] != side[:-1])])
            for s, e in zip(change, [*change[1:], b.num_rows], strict=True):
                if now is None or tuple(key[s]) != now:
                    now, base_parts, block_x = tuple(key[s]), [], None
                if side[s] == 0:
                    base_parts.append((x[s:e], h[s:e], h2[s:e], least[s:e]))
                    continue
                if not base_parts:
                    continue
                if block_x is None:
                    block_x = np.concatenate([p[0] for p in base_parts])
                    names = tuple(np.concatenate([p[i] for p in base_parts]) for i in (1, 2, 3))
                    block_u = _units(block_x)
                for lo in range(s, e, 512):
                    q = x[lo : min(lo + 512, e)]
                    near = _units(q) @ block_u.T
                    # every class that may reach the block's last place, as products of matrices round otherwise
                    least_near = np.partition(near, -most, axis=1)[:, -most] - ROUNDING if near.shape[1] > most else np.full(len(q), -np.inf)
                    i, j = np.nonzero(near >= least_near[:, None])
                    score = np.concatenate([cosines(q[i[at : at + 16384]], block_x[j[at : at + 16384]]) for at in range(0, len(i), 16384)])
                    order = np.lexsort((names[2][j], -score, i))
                    order = order[np.arange(len(i)) - np.searchsorted(i, i) < most]  # ``i`` is sorted before and after
                    i, j, score = i[order], j[order], score[order]
                    yield pa.RecordBatch.from_arrays([pa.array(h[lo + i]), pa.array(h2[lo + i]), pa.array(names[0][j]), pa.array(names[1][j]), pa.array(names[2][j]), pa.array(score)], names=["qh", "qh2", "h", "h2", "least", "score"])

    found = dealt.mapInArrow(search, "qh long, qh2 int, h long, h2 int, least long, score double").groupBy("qh", "qh2", "h", "h2", "least").agg(F.max("score").alias("score"))
    best = found.withColumn("r", F.row_number().over(Window.partitionBy("qh", "qh2").orderBy(F.desc("score"), "least", "h", "h2"))).where(F.col("r") <= most)
    named = best.join(classes.select("h", "h2", "ids"), ["h", "h2"]).select("qh", "qh2", "score", F.explode("ids").alias("vec_id"))
    # for a class of queries, its best ids; one more than k, as a query itself may be among them
    listed = named.groupBy("qh", "qh2", "vec_id").agg(F.max("score").alias("score")).withColumn("r", F.row_number().over(Window.partitionBy("qh", "qh2").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    lists = listed.groupBy("qh", "qh2").agg(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score")).alias("best"))
    answers = asking.join(lists, (asking["h"] == lists["qh"]) & (asking["h2"] == lists["qh2"])).select(F.col("id").alias("query_id"), F.explode("best").alias("b")).where(F.col("b.vec_id") != F.col("query_id"))
    answers = answers.groupBy("query_id", F.col("b.vec_id").alias("vec_id")).agg(F.max("b.score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return answers.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
