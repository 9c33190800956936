"""Embeddings of texts with any model that maps a list of texts to a list of vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.session import ship_package

DIMENSIONS = 384
EMBEDDER_BATCH = 250


class HashingEmbedder:
    """A deterministic embedder for tests: signed counts of hashed words, scaled to length 1."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for text in texts:
            v = np.zeros(self.dimensions)
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
                v[h % self.dimensions] += 1 if h >> 63 else -1
            norm = np.linalg.norm(v)
            out.append(v / norm if norm else v)
        return out


def embed(docs: DataFrame, text: str, make: Callable[[], Callable[[list[str]], list]] = HashingEmbedder, to: str = "emb") -> DataFrame:
    """docs with the vector of a text column. make() builds the model, once in each task; a null text has a null vector.

    Raises ValueError if the model returns another number of vectors than it got texts.
    """

    ship_package(docs.sparkSession)

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for texts in parts:
            given = texts.dropna()
            vectors: list = []
            for start in range(0, len(given), EMBEDDER_BATCH):
                some = given.iloc[start : start + EMBEDDER_BATCH].tolist()
                found = list(model(some))
                if len(found) != len(some):
                    raise ValueError("the model returned another number of vectors than texts")
                vectors += [np.asarray(v, dtype=float).tolist() for v in found]
            yield pd.Series([None] * len(texts), index=texts.index, dtype=object).where(texts.isna(), pd.Series(vectors, index=given.index, dtype=object).reindex(texts.index))

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return docs.withColumn(to, F.pandas_udf(run, "array<double>")(F.col(text)))
