"""Encoders turn texts into vectors. No model is at hand offline, so the one here hashes words; a model goes
behind the same interface: a function from a column to an array<float> column."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Encoder = Callable[[Column], Column]


def hashing_encoder(dims: int = 64, normalize: bool = True) -> Encoder:
    """Signed feature hashing of lower-cased words; the same text gives the same vector everywhere."""

    @F.pandas_udf("array<float>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = []
            for t in texts:
                v = np.zeros(dims, np.float32)
                for w in (t or "").lower().split():
                    h = zlib.crc32(w.encode())
                    v[h % dims] += 1 if h & 0x80000000 else -1
                size = float(np.sqrt((v * v).sum()))
                out.append(v / size if normalize and size else v)
            yield pd.Series(out)

    return encode


def model_encoder(load: Callable[[], Callable[[list[str]], np.ndarray]], batch: int = 16) -> Encoder:
    """``load`` runs once per Python worker and returns a function from texts to a matrix."""

    @F.pandas_udf("array<float>")
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in parts:
            rows = [np.asarray(model(list(texts.iloc[i : i + batch])), np.float32) for i in range(0, len(texts), batch)]
            found = np.concatenate(rows) if rows else np.empty((0, 0), np.float32)
            if len(found) != len(texts):
                raise ValueError(f"the model gave {len(found)} vectors for {len(texts)} texts")
            yield pd.Series(list(found))

    return encode
