"""Logistic regressions on bounded samples, and the sampling of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_dense(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the first is the intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], l2)
    ridge[0] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (weight * (y - p)) - ridge * w
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        w += step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_sparse(rows: np.ndarray, cols: np.ndarray, n: int, dims: int, scale: np.ndarray, y: np.ndarray, weight: np.ndarray,
               l2: float = 1.0, steps: int = 200) -> tuple[float, np.ndarray]:
    """Intercept and weights for present features of value ``scale``; accelerated gradient descent."""
    value = scale[cols]
    # Lipschitz bound of the gradient by the largest row norm
    norm = np.bincount(rows, value * value, n) + 1.0
    rate = 1.0 / (0.25 * float((weight * norm).sum()) / max(1, n) * 4 + l2)
    w, b = np.zeros(dims), 0.0
    g2w, g2b = np.full(dims, 1e-8), 1e-8
    for step in range(steps):
        p = sigmoid(b + np.bincount(rows, value * w[cols], n))
        e = weight * (p - y)
        gw = np.bincount(cols, value * e[rows], dims) + l2 * w
        gb = float(e.sum())
        g2w += gw * gw
        g2b += gb * gb
        w -= 0.5 * gw / np.sqrt(g2w)
        b -= 0.5 * gb / np.sqrt(g2b)
    return b, w


def labelled(labels: DataFrame, label: str, where: Column | None, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """Up to ``per_class`` labelled ids of either class, those of the smallest hash: (_id, _y),
    and the weight that restores each class's share. Null ids or labels are left out; of
    several labels of an id the largest counts."""
    l = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    l = l if where is None else l.where(where)
    l = l.groupBy(F.col("doc_id").alias("_id")).agg((F.max(label) > 0).cast("int").alias("_y"))
    total = {r["_y"]: r["n"] for r in l.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    some = [l.where(F.col("_y") == c).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for c in (0, 1)]
    return some[0].unionByName(some[1]), {c: total.get(c, 0) / max(1, min(per_class, total.get(c, 0))) for c in (0, 1)}
