"""Toxicity: linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.common import keep
from sparklab.llm.linear import fit_sparse, labelled, sigmoid
from sparklab.llm.words import _M1 as K1
from sparklab.llm.words import _M2 as K2

ORDERS = (3, 4, 5, 6)
BITS = 20
#: bounds of the fit: labelled rows of either class, and features kept by the weight of their ratio
PER_CLASS = 5_000
FEATURES = 4_000
#: an n-gram is a feature if its log-count ratio is this many standard errors from zero
MIN_Z = 4.0


def ngrams(text: str | None) -> np.ndarray:
    """Hashed ids of the distinct n-grams of a whole text, framed by a space, in lower case."""
    c = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    found, h = [], c
    for n in range(2, max(ORDERS) + 1):
        if len(c) < n:
            break
        h = h[:-1] * K1 + c[n - 1:]
        if n in ORDERS:
            found.append(((h ^ np.uint64(n)) * K2 >> np.uint64(64 - BITS)).astype(np.int32))
    if not found:
        return np.zeros(0, np.int32)
    ids = np.concatenate(found)
    place = _scratch()
    order = np.arange(len(ids), dtype=np.int32)
    place[ids] = order  # the last of equal ids stays; no sort
    return ids[place[ids] == order]


_SCRATCH: list[np.ndarray] = []


def _scratch() -> np.ndarray:
    if not _SCRATCH:
        _SCRATCH.append(np.zeros(1 << BITS, dtype=np.int32))
    return _SCRATCH[0]


@dataclass
class Model:
    intercept: float
    weight: np.ndarray  # float32, one per hashed n-gram; the ratio is multiplied in

    def score(self, text: str | None) -> float:
        return float(sigmoid(self.intercept + self.weight[ngrams(text)].sum(dtype=np.float64)))


def _count(batches):
    """Documents with each n-gram, by class; one partial result per task."""
    n = np.zeros((2, 1 << BITS), dtype=np.int64)
    for b in batches:
        for text, y in zip(b["_text"].to_pylist(), b["_y"].to_pylist(), strict=True):
            n[y, ngrams(text)] += 1
    at = np.flatnonzero(n.any(axis=0))
    yield pa.RecordBatch.from_pydict({"id": pa.array(at, pa.int32()), "n0": n[0, at], "n1": n[1, at]})


def _select(kept):
    def run(batches):
        mask = np.zeros(1 << BITS, dtype=bool)
        mask[kept] = True
        for b in batches:
            ids = [x[mask[x]] for x in map(ngrams, b["_text"].to_pylist())]
            yield pa.RecordBatch.from_pydict({"_y": b["_y"], "ids": pa.array([x.tobytes() for x in ids], pa.binary())})
    return run


def fit(docs: DataFrame, labels: DataFrame, where=None, per_class: int = PER_CLASS, features: int = FEATURES) -> Model:
    """Train on at most ``per_class`` labelled documents of either class (by smallest hash of the id).

    The sample is bounded, so its ids are broadcast and what reaches the driver
    is bounded too: the counts per hashed n-gram and the kept features of the
    sample. Without labels of both classes every text gets the share of toxic labels.
    """
    ids, weights = labelled(labels, "toxic", where, per_class)
    sample = keep(docs.select(F.col("doc_id").alias("_d"), F.col("text").alias("_text"))
                  .join(F.broadcast(ids), F.col("_d") == F.col("_id")).select("_y", "_text").repartition(8))  # a bounded sample
    counts = sample.mapInArrow(_count, "id int, n0 long, n1 long").groupBy("id").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    classes = {r["_y"]: r["n"] for r in sample.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        rate = 0.5 if not classes else float(next(iter(classes)))
        return Model(float(np.log((0.001 + rate * 0.998) / (0.999 - rate * 0.998))), np.zeros(1 << BITS, np.float32))
    p, q = (F.col("n1") + 1) / (classes[1] + 2), (F.col("n0") + 1) / (classes[0] + 2)
    # how far the ratio is from what chance gives: its size against its standard error
    best = counts.select("id", F.log(p / q).alias("ratio"), (F.abs(F.log(p / q)) / F.sqrt(1 / (F.col("n1") + 1) + 1 / (F.col("n0") + 1))).alias("z"))
    best = best.where(F.col("z") >= MIN_Z).orderBy(F.col("z").desc(), "id").limit(features).toPandas()
    r = np.zeros(1 << BITS)
    r[best["id"]] = best["ratio"]
    got = sample.mapInArrow(_select(np.sort(best["id"].to_numpy())), "_y int, ids binary").toPandas()
    cols = [np.frombuffer(x, np.int32) for x in got["ids"]]
    rows = np.repeat(np.arange(len(cols)), [len(x) for x in cols])
    y = got["_y"].to_numpy(float)
    w = np.where(y == 1, weights[1], weights[0])
    b, beta = fit_sparse(rows, np.concatenate(cols) if cols else np.zeros(0, np.int64), len(cols), 1 << BITS, r, y, w / w.mean())
    return Model(float(b), (beta * r).astype(np.float32))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every whole text.

    Null and empty texts get the score of an empty text. Null or repeated
    doc_ids are rows of their own; a null id is never held out.
    """
    packed = docs.sparkSession.sparkContext.broadcast((model.intercept, model.weight))

    def run(batches):
        m = Model(*packed.value)
        for b in batches:
            s = [m.score(t) for t in b["_text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "score": pa.array(s, pa.float64())})

    d = docs.select("doc_id", F.col("text").alias("_text"))
    d = d.mapInArrow(run, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def held_out(doc_id, folds: int = 3, fold: int = 1):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labels that are not held out and score all documents."""
    return score(docs, fit(docs, labels, ~held_out(F.col("doc_id"))))
