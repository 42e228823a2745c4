"""Quality classifier by co-training: a text view and a metadata view teach each other.

Both start from the labelled sample. In each round either view labels the
pool rows it is sure of for the other one; at the end both are calibrated on
labels neither was trained on, and their log odds add up.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.common import keep
from sparklab.llm.linear import fit_dense, labelled, sigmoid
from sparklab.llm.words import PLAIN, pieces

#: bounds of the fit: labelled rows of either class, unlabelled rows of the pool
PER_CLASS = 6_000
POOL = 10_000
ROUNDS = 4
#: a view labels a pool row for the other one when its probability is at least this far out
SURE = 0.97
META_BUCKETS = 32
#: whole texts of about so many bytes are looked at together; a task's working memory goes by it
PIECE_BYTES = 1 << 18

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#$%&*!@^_|~<>{}[]=+/\\"]] = True
TEXT_FEATURES = 11


def text_features(column) -> np.ndarray:
    """Shape of whole texts, one row each; an empty text gives zeros."""
    out = np.zeros((len(column), TEXT_FEATURES))
    for i, j, w in pieces(column, PLAIN, limit=PIECE_BYTES):
        b, h, low = w.bytes[:-8], w.hashes(), w.text_start
        mixed = np.concatenate([[0], np.cumsum(_SYMBOL[b[w.end - 1]])]) if w.n else np.zeros(1)
        same = np.zeros(w.n, bool)
        same[1:] = h[1:] == h[:-1]
        same[w.first[:-1][w.first[:-1] < w.n]] = False
        same = np.concatenate([[0], np.cumsum(same)])
        length = np.concatenate([[0], np.cumsum(w.end - w.start)])
        for k in range(j - i):
            a, z = int(w.first[k]), int(w.first[k + 1])
            n = z - a
            if not n:
                continue
            size = int(low[k + 1] - low[k])
            own = b[low[k]:low[k + 1]]
            upper, letter, digit, symbol = (float(np.count_nonzero(t[own])) for t in (_UPPER, _LETTER, _DIGIT, _SYMBOL))
            _, counts = np.unique(h[a:z], return_counts=True)
            pair = np.unique(h[a:z - 1] * np.uint64(3) ^ h[a + 1:z]) if n > 1 else h[:1]
            out[i + k] = (np.log1p(n), (length[z] - length[a]) / n, upper / max(1.0, letter), digit / size, symbol / size,
                          (mixed[z] - mixed[a]) / n, (same[z] - same[a]) / n, len(counts) / n, counts.max() / n,
                          len(pair) / n, letter / size)
    return out


def meta_features(lang, source, n_chars) -> np.ndarray:
    """Hashed language and source, and the recorded length in steps; null is a value of its own."""
    out = np.zeros((len(lang), 2 * META_BUCKETS + 12))
    for i, (a, b, n) in enumerate(zip(lang, source, n_chars, strict=True)):
        out[i, zlib.crc32(f"l{a}".encode()) % META_BUCKETS] = 1
        out[i, META_BUCKETS + zlib.crc32(f"s{b}".encode()) % META_BUCKETS] = 1
        out[i, 2 * META_BUCKETS + min(11, int(np.log2(1 + max(0, n or 0)) / 1.6))] = 1
    return out


@dataclass
class View:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        z = np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -6, 6)]) @ self.weight
        return self.slope * z + self.shift


def _fit(x, y, weight, mean, scale) -> View:
    return View(mean, scale, fit_dense(np.clip((x - mean) / scale, -6, 6), y, weight))


def _calibrated(v: View, x, y, weight) -> View:
    """Platt scaling on rows that did not train the view; a slope below zero means no signal."""
    w = fit_dense(v.odds(x)[:, None], y, weight, l2=0.1)
    v.shift, v.slope = float(w[0]), max(0.0, float(w[1]))
    return v


@dataclass
class CoTrained:
    text: View | None
    meta: View | None
    prior: float  # log odds of a good page

    def score(self, xt, xm):
        if self.text is None:
            p = np.full(len(xt), float(sigmoid(np.array(self.prior))))
            return p, p, p
        a, b = self.text.odds(xt), self.meta.odds(xm)
        return sigmoid(a), sigmoid(b), sigmoid(a + b - self.prior)


def co_train(xt, xm, y, weight, pt, pm, rounds: int = ROUNDS, sure: float = SURE) -> CoTrained:
    """Train both views on labelled (xt, xm, y, weight) and the unlabelled pool (pt, pm).

    A fifth of the labels is held back for calibration. Every round each view
    names its surest tenth of the pool, if ``sure`` enough, for the other view.
    """
    held = np.arange(len(y)) % 5 == 0
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        good = float((weight * y).sum() + 1) / float(weight.sum() + 2)
        return CoTrained(None, None, float(np.log(good / (1 - good))))
    views, pools, data = [None, None], [pt, pm], [xt, xm]
    stats = [(d[~held].mean(0), d[~held].std(0) + 1e-6) for d in data]
    taught: list[dict[int, float]] = [{}, {}]
    for _ in range(rounds + 1):
        for k in (0, 1):
            rows = np.array(sorted(taught[k]), dtype=int)
            x = np.vstack([data[k][~held], pools[k][rows]])
            t = np.concatenate([y[~held], [taught[k][r] for r in rows]])
            w = np.concatenate([weight[~held], np.full(len(rows), 0.5)])
            views[k] = _calibrated(_fit(x, t, w, *stats[k]), data[k][held], y[held], weight[held])
        for k in (0, 1):
            p = sigmoid(views[k].odds(pools[k])) if len(pools[k]) else np.zeros(0)
            for label, confident in ((1.0, p), (0.0, 1 - p)):
                for r in np.argsort(-confident, kind="stable")[:max(1, len(p) // 10)]:
                    if confident[r] >= sure:
                        taught[1 - k].setdefault(int(r), label)
    good = float((weight * y).sum() / weight.sum())
    return CoTrained(*views, float(np.log(good / (1 - good))))


def _columns(docs: DataFrame) -> DataFrame:
    has = {c.lower() for c in docs.columns}
    col = lambda c, kind: (F.col(c).cast(kind) if c in has else F.lit(None).cast(kind)).alias(f"_{c}")
    return docs.select(F.col("doc_id").alias("_doc_id"), col("text", "string"), col("lang", "string"), col("source", "string"), col("n_chars", "double"))


def _features(text, lang, source, n_chars):
    return text_features(text), meta_features(lang.to_pylist(), source.to_pylist(), n_chars.to_pylist())


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, pool: int = POOL) -> CoTrained:
    """Co-train on at most ``per_class`` labelled rows of either class and ``pool`` unlabelled rows,
    those with the smallest hash of their id; only their feature rows reach the driver."""
    ids, weights = labelled(labels, "quality", None, per_class)
    known = labels.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()
    others = docs.select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").join(known, "_id", "left_anti")
    others = others.distinct().orderBy(F.xxhash64("_id"), "_id").limit(pool).withColumn("_y", F.lit(-1))
    wanted = keep(ids.unionByName(others))

    def run(batches):
        for b in batches:
            xt, xm = _features(b["_text"], b["_lang"], b["_source"], b["_n_chars"])
            yield pa.RecordBatch.from_pydict({"y": b["_y"], "id": b["_doc_id"], "t": pa.array(list(xt), pa.list_(pa.float64())),
                                              "m": pa.array(list(xm), pa.list_(pa.float64()))})

    # at most 2 * per_class + pool ids, and of rows that share one the smallest features
    d = _columns(docs).join(F.broadcast(wanted), F.col("_doc_id") == F.col("_id")).drop("_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    d = d.mapInArrow(run, f"y int, id {kind}, t array<double>, m array<double>")
    got = d.groupBy("id").agg(F.min(F.struct("y", "t", "m")).alias("_m")).select("id", "_m.*").toPandas().sort_values("id", kind="stable")
    if not len(got):
        return CoTrained(None, None, 0.0)
    xt = np.array(got["t"].tolist()).reshape(-1, TEXT_FEATURES)
    xm = np.array(got["m"].tolist()).reshape(len(got), -1)
    y = got["y"].to_numpy()
    on = y >= 0
    if not on.any():
        return CoTrained(None, None, 0.0)
    order = np.argsort([zlib.crc32(str(i).encode()) for i in got["id"][on]], kind="stable")
    yl = y[on].astype(float)[order]
    w = np.where(yl == 1, weights[1], weights[0])
    return co_train(xt[on][order], xm[on][order], yl, w / w.mean(), xt[~on], xm[~on])


SCORES = ("_text_score", "_meta_score", "_score")


def _scored(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``docs`` with its columns renamed to _c0, _c1, ... and the scores.

    The Python workers get the four columns that the scores need, once, and hand back nothing but the scores.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    back = {c.lower(): n for c, n in zip(docs.columns, names, strict=True)}
    used = [(F.col(back[c]) if c in back else F.lit(None)).cast(k)
            for c, k in (("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "double"))]

    def run(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        found = model.score(*_features(text, lang, source, n_chars))
        return pa.StructArray.from_arrays([pa.array(x, pa.float64()) for x in found], names=SCORES)

    # not deterministic to Spark, so that a filter on a score never has it computed twice
    scores = F.arrow_udf(run, ", ".join(f"{c} double" for c in SCORES)).asNondeterministic()
    return docs.toDF(*names).select(*names, scores(*used).alias("_s")).select(*names, "_s.*")


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """``docs`` with ``_text_score``, ``_meta_score`` and ``_score`` (probability of a good page).

    All rows stay, null texts count as empty, missing metadata columns as null;
    null or repeated doc_ids are rows of their own.
    """
    return _scored(docs, model).toDF(*docs.columns, *SCORES)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text_score, meta_score, score, good (score >= 0.5) of every document."""
    d = score(docs.select("doc_id", "text", "lang", "source", "n_chars"), fit(docs, labels))
    return d.select("doc_id", F.col("_text_score").alias("text_score"), F.col("_meta_score").alias("meta_score"),
                    F.col("_score").alias("score"), (F.col("_score") >= 0.5).alias("good"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``."""
    return _scored(docs, fit(docs, labels)).where(F.col("_score") >= threshold).drop(*SCORES).toDF(*docs.columns)
