"""Exact top-k by cosine for any number of queries, with a second score over the best."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components of the chunk vectors that a task holds at once, about.
HELD = 1 << 22
#: Product of a task's queries and chunks that are held against each other at once.
PAIRS = 1 << 22
ROUNDING = 1e-9


def _matrix(column: pa.Array) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """By length, the rows that have vectors of it and these vectors; and the rows whose vector is null or holds a null."""
    lists = column.to_pylist()
    whole = [x is not None and None not in x for x in lists]
    lengths = np.array([len(x) if ok else -1 for x, ok in zip(lists, whole, strict=True)], np.int64)
    of = {n: np.flatnonzero(lengths == n) for n in np.unique(lengths).tolist() if n >= 0}
    return {n: (rows, np.array([lists[i] for i in rows.tolist()], np.float64).reshape(len(rows), n)) for n, rows in of.items()}, np.flatnonzero(lengths < 0)


def _units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``x`` at length 1, and which rows have no such form: zero, or without a finite length."""
    with np.errstate(all="ignore"):
        size = np.sqrt((x * x).sum(1))
        odd = ~np.isfinite(size) | (size < 1e-140)
        return np.where(odd[:, None], 0.0, x / size[:, None]), odd


def _cosines(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row, summed in order as ``functions.vectors.cosine`` does; 0 where a vector is zero."""
    if not q.shape[1]:
        return np.zeros(len(q))
    with np.errstate(all="ignore"):
        dot, a, b = ((v * w).cumsum(axis=1)[:, -1] for v, w in ((q, c), (q, q), (c, c)))
        size = np.sqrt(a) * np.sqrt(b)
        return np.where(size == 0, 0.0, dot / size)


def _best(q: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row of ``q``, row of ``c`` and cosine of the ``k`` best of ``c``, ties to the earlier row; NaN is the largest, as Spark has it."""
    (qu, q_odd), (cu, c_odd) = _units(q), _units(c)
    step = max(1, PAIRS // max(len(c), 1))
    for lo in range(0, len(q), step):
        near = qu[lo : lo + step] @ cu.T
        least = np.partition(near, -k, axis=1)[:, -k] - ROUNDING if len(c) > k else np.full(len(near), -np.inf)
        # the odd ones are always looked at: what they score is not told by ``near``, and they may not push others out
        if c_odd.any() and len(c) > k:
            sound = near[:, ~c_odd]
            least = np.partition(sound, -k, axis=1)[:, -k] - ROUNDING if sound.shape[1] > k else np.full(len(near), -np.inf)
        i, j = np.nonzero((near >= least[:, None]) | c_odd | q_odd[lo : lo + step, None])
        score = np.concatenate([_cosines(q[lo + i[at : at + 16384]], c[j[at : at + 16384]]) for at in range(0, len(i), 16384)] or [np.empty(0)])
        order = np.lexsort((j, np.where(np.isnan(score), -np.inf, -score), i))
        order = order[np.arange(len(i)) - np.searchsorted(i, i) < k]
        yield lo + i[order], j[order], score[order]


def top_k(queries: DataFrame, chunks: DataFrame, k: int = 20, query_id: str = "query_id", chunk_id: str = "chunk_id", vector: str = "embedding", rerank: Callable[[Column, Column], Column] | None = None, keep: int = 5) -> DataFrame:
    """For each query the ``k`` chunks of largest cosine, ties to smaller ids; with ``rerank`` (a function of both vectors) the best
    ``keep`` of these by that score. Chunks are dealt to blocks of bounded size, by a hash; all queries stream past each block, which gives
    its own ``k`` best of each, and these lists are merged. A pair without a cosine (a null, or lengths that differ) comes last."""
    spark = queries.sparkSession
    n, wide = chunks.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vector)), F.lit(1))).first()
    most = max(1024, HELD // max(wide, 1))
    blocks = max(1, -(-n // most), min(spark.sparkContext.defaultParallelism, n // 1024))
    kind = {"q": queries.schema[query_id].dataType.simpleString(), "c": chunks.schema[chunk_id].dataType.simpleString()}
    # the vectors themselves go along only where a second score needs them
    made = f"q {kind['q']}, c {kind['c']}, score double" + ", qv array<double>, cv array<double>" * (rerank is not None)

    base = chunks.select(F.pmod(F.xxhash64(chunk_id, vector), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("side"), F.lit(None).cast(kind["q"]).alias("q"), F.col(chunk_id).alias("c"), F.col(vector).cast("array<double>").alias("v"))
    asks = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("side"), F.col(query_id).alias("q"), F.lit(None).cast(kind["c"]).alias("c"), F.col(vector).cast("array<double>").alias("v"))
    dealt = base.union(asks).repartition(blocks, "block").sortWithinPartitions("block", "side", "c")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's chunks come first, by id, and stay; the queries stream past them."""
        now, parts, held = None, [], None
        for b in batches:
            key = np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()])
            change = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(1)])
            for s, e in zip(change.tolist(), [*change[1:].tolist(), b.num_rows], strict=True):
                if key[s, 0] != now:
                    now, parts, held = key[s, 0], [], None
                if key[s, 1] == 0:
                    parts.append(b.slice(s, e - s))
                    continue
                if not parts:
                    continue
                if held is None:
                    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    held, ids, vectors = _matrix(whole.column(4)), whole.column(3), whole.column(4)
                of_length, nulls = _matrix(b.column(4).slice(s, e - s))
                for length, (rows, x) in [*of_length.items(), (-1, (nulls, None))]:
                    at, c = held[0].get(length, (np.empty(0, np.int64), None))
                    found = list(_best(x, c, k)) if len(rows) and len(at) else []
                    i, j, score = (np.concatenate(p) for p in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
                    i, j, score = rows[i], at[j], pa.array(score)
                    if len(at) < k and len(rows):  # pairs without a score fill up the list
                        rest = np.setdiff1d(np.arange(len(ids)), at)[: k - len(at)]
                        i, j = np.r_[i, np.repeat(rows, len(rest))], np.r_[j, np.tile(rest, len(rows))]
                        score = pa.concat_arrays([score, pa.nulls(len(rows) * len(rest), pa.float64())])
                    for lo in range(0, len(i), 4096):
                        qi, cj = pa.array(s + i[lo : lo + 4096]), pa.array(j[lo : lo + 4096])
                        out = [b.column(2).take(qi), ids.take(cj), score.slice(lo, len(qi))]
                        out += [b.column(4).take(qi), vectors.take(cj)] if rerank is not None else []
                        yield pa.RecordBatch.from_arrays(out, names=["q", "c", "score", "qv", "cv"][: len(out)])

    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    top = dealt.mapInArrow(search, made).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if rerank is not None:
        given = (queries.schema[vector].dataType.simpleString(), chunks.schema[vector].dataType.simpleString())
        top = top.withColumn("score", rerank(F.col("qv").cast(given[0]), F.col("cv").cast(given[1]))).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)
    return top.select(F.col("q").alias(query_id), "rank", F.col("c").alias(chunk_id), "score")
