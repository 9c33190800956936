"""Labelled rows for the classifiers: bounded samples, and the fit of a linear model on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, allowed, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, label) of at most per_class documents of each label, and how many labelled documents there are of each.

    labels: (doc_id, label); null ids and labels are left out, the largest of several labels counts. allowed: condition on doc_id.
    The sample is the documents with the smallest hashes of their id, the same on every run.
    """
    marks = labels.filter("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").cast("int").alias("label")).filter(allowed)
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}  # a row for each label
    picked = None
    for label in (0, 1):
        one = marks.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), counts  # at most 2 * per_class ids


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_linear(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, y: np.ndarray, width: int, l2: float, rounds: int = 150) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2-regularised logistic regression on sparse features (row, column, value), by Adam over all rows; classes count alike."""
    n = len(y)
    w, b = np.zeros(width), 0.0
    m, s, mb, sb = np.zeros(width), np.zeros(width), 0.0, 0.0
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    for t in range(1, rounds + 1):
        z = np.bincount(rows, weights=values * w[cols], minlength=n) + b
        g = (logistic(z) - y) * share
        gw = np.bincount(cols, weights=values * g[rows], minlength=width) + l2 * w
        gb = g.sum()
        rate = 0.1 / (1 + t / 60)
        m, s = 0.9 * m + 0.1 * gw, 0.99 * s + 0.01 * gw * gw
        mb, sb = 0.9 * mb + 0.1 * gb, 0.99 * sb + 0.01 * gb * gb
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
        b = b - rate * (mb / (1 - 0.9**t)) / (np.sqrt(sb / (1 - 0.99**t)) + 1e-8)
    return w, float(b)
