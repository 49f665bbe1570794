"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its distinct words, word pairs and pairs with one word between, hashed into
2**BITS places. FTRL-proximal gives each place its own learning rate and, by the L1 term, sets all but the
telling ones to zero, so the model is a short sorted list of places and weights, small to broadcast. It is
fitted on at most ``max_rows`` labelled rows (the smallest by a hash of the id); everything is scored.

Null and empty texts have no features and get the score of the bias. Words are runs of ASCII letters and
digits and of other characters' bytes, with A-Z lower-cased; whole texts are read, however long. Rows that repeat
come back each, with the same score. A null id is in the fold of the text ``null``. A label row whose id or label is null teaches nothing; one id with both labels
counts as toxic. An empty table gives an empty table; without labelled rows every text gets the score of the first bias.
A score equal to the threshold counts as toxic. Other columns pass through, whatever their names; a column named
``score`` is replaced by the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches

BITS = 22
THRESHOLD = 0.7
#: Bytes that are no part of a word become spaces; A-Z become a-z.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class WordHashes(dict):
    """XXH64 of words, remembered; forgets all at a bound, so memory stays bounded."""

    limit = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, 7)
        return h


def features(text: bytes | None, cache: WordHashes) -> np.ndarray:
    """Places of all features, repeats included."""
    words = (text or b"").translate(WORD_BYTES).split()
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    shift = np.uint64(64 - BITS)
    parts = [h * _M1 >> shift]
    if len(h) > 1:
        parts.append((h[:-1] * _M2 + h[1:]) * _M1 >> shift)
    if len(h) > 2:
        parts.append((h[:-2] * _M3 + h[2:] + _M2) * _M1 >> shift)
    return np.concatenate(parts).astype(np.int64)


@dataclass(frozen=True)
class Model:
    places: np.ndarray  # sorted
    weights: np.ndarray
    bias: float

    def score(self, dense: np.ndarray, text: bytes | None, cache: WordHashes) -> float:
        x = features(text, cache)
        x = x[dense[x] != 0]
        return float(1 / (1 + np.exp(-np.clip(self.bias + dense[np.unique(x)].sum(), -60, 60))))

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, np.float32)
        w[self.places] = self.weights
        return w


def fit(rows: list[tuple[np.ndarray, int]], alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.1, epochs: int = 10, bias_rate: float = 0.02) -> Model:
    """FTRL-proximal over rows of (distinct places, label), in the given order, ``epochs`` times."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = -2.0
    for _ in range(epochs):
        for x, y in rows:
            zx, nx = z[x], n[x]
            w = np.where(np.abs(zx) <= l1, 0.0, (np.sign(zx) * l1 - zx) / ((beta + np.sqrt(nx)) / alpha + l2))
            g = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -60, 60))) - y
            sigma = (np.sqrt(nx + g * g) - np.sqrt(nx)) / alpha
            z[x] = zx + g - sigma * w
            n[x] = nx + g * g
            bias -= bias_rate * g
    places = np.flatnonzero(np.abs(z) > l1)
    zx, nx = z[places], n[places]
    return Model(places, ((np.sign(zx) * l1 - zx) / ((beta + np.sqrt(nx)) / alpha + l2)).astype(np.float32), bias)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = 12_000) -> Model:
    """Fit on ``labels`` (already restricted to rows that may teach). Only features, at most ``max_rows`` rows
    of them, come to the driver."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)  # a bounded sample, the documented parameter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            x = [np.unique(features(t, cache)).astype(np.int32) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(x, pa.list_(pa.int32()))], names=["_id", "_y", "_x"])

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    joined = texts.join(F.broadcast(chosen), "_id").select(F.col("_id").cast("string").alias("_id"), "_y", "_text")
    got = joined.mapInArrow(run, "_id string, _y int, _x array<int>").toArrow()
    order = sorted(range(got.num_rows), key=lambda i, ids=got.column(0).to_pylist(): (xxhash.xxh64_intdigest(str(ids[i])), str(ids[i])))
    xs, ys = got.column(2), got.column(1).to_pylist()
    rows = [(xs[i].values.to_numpy(), ys[i]) for i in order]  # views of what Arrow holds
    return fit(rows)


def _score_of(spark: SparkSession, model: Model, text: Column) -> Column:
    """The score of a text. Only texts go to Python, in small batches; the other columns stay in the JVM."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.places, model.weights, model.bias))

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Model(*shared.value)
        dense, cache = own.dense(), WordHashes()
        for b in batches:
            yield pa.array([own.score(dense, x.as_py(), cache) for x in b], pa.float64())

    return scored(text.cast("binary"))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double), in place of a column of that name."""
    return docs.select(*[docs[f"`{c}`"] for c in docs.columns if c != "score"], _score_of(docs.sparkSession, model, docs[f"`{text_col}`"]).alias("score"))


def may_teach(id_col: str = "doc_id", folds: int = 3, held_out: int = 1) -> Column:
    """Whether an id is of a fold that teaches; a null id is taken as the text ``null``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary")) % folds != held_out


def reject(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that score ``threshold`` or more."""
    return docs.where(_score_of(docs.sparkSession, model, docs[f"`{text_col}`"]) < threshold)
