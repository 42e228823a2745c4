"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.common import components, keep

THRESHOLD = 0.93
#: bits of a code, cut into parts that are the keys of the tables; rotations learnt independently
BITS, PART, CODES = 64, 16, 2
#: a part matches with at most one bit off; whole codes with at most this many
RADIUS = 20
#: bound of the sample that the rotations are learnt on
SAMPLE = 10_000


def learn(x: np.ndarray, seed: int, steps: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection to ``BITS`` signs: principal axes (random ones where
    there are too few), then the rotation that brings them nearest to +-1."""
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    v = x - mean
    dims = x.shape[1]
    if dims >= BITS:
        axes = np.linalg.eigh(v.T @ v)[1][:, ::-1][:, :BITS]
    else:
        axes = rng.standard_normal((dims, BITS)) / np.sqrt(dims)
    v = v @ axes
    r = np.linalg.qr(rng.standard_normal((BITS, BITS)))[0]
    for _ in range(steps):
        u, _, wt = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ wt).T
    return mean, axes @ r


def _model(models: dict, dims: int):
    if dims not in models:  # a length that the sample missed: random hyperplanes
        models[dims] = [(np.zeros(dims), np.random.default_rng([dims, s]).standard_normal((dims, BITS))) for s in range(CODES)]
    return models[dims]


def _codes(models):
    def run(batches):
        own = dict(models.value)
        for b in batches:
            ids, labels, vecs = b["_id"].to_pylist(), b["label"], b["_v"].to_pylist()
            out = np.zeros((len(vecs), CODES), dtype=np.uint64)
            sizes = np.array([len(v) for v in vecs])
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                x = np.array([vecs[i] for i in at], dtype=np.float64)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for k, (mean, axes) in enumerate(_model(own, int(dims))):
                    out[at, k] = np.packbits((x - mean) @ axes >= 0, axis=1).view(">u8").ravel()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), labels, pa.array(sizes, pa.int32()),
                                              *[pa.array(out[:, k].view(np.int64)) for k in range(CODES)]],
                                             names=["_id", "label", "_dims", *[f"_c{k}" for k in range(CODES)]])
    return run


def _rerank(threshold):
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sizes = np.diff(b["_va"].offsets.to_numpy())
            for dims in np.unique(sizes):
                at = np.flatnonzero(sizes == dims)
                part = b.take(pa.array(at))
                x, y = (part[c].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) for c in ("_va", "_vb"))
                cos = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
                on = np.flatnonzero(cos >= threshold)
                yield pa.RecordBatch.from_arrays([part["a"].take(pa.array(on)), part["b"].take(pa.array(on)), pa.array(cos[on])], names=["a", "b", "cos"])
    return run


def links(vectors: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE) -> DataFrame:
    """Pairs (a < b, cos) of different vectors ``(_id, label, _v)`` with equal label and length.

    Candidates agree in one 16-bit part of a code up to one bit and differ in
    at most ``RADIUS`` bits of that code; cosines are of the original vectors.
    """
    spark = vectors.sparkSession
    some = vectors.orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_v").toPandas()["_v"]
    models, sizes = {}, np.array([len(v) for v in some], dtype=int)
    for dims in np.unique(sizes):
        x = np.array([v for v in some if len(v) == dims], dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        models[int(dims)] = [learn(x, seed) for seed in range(CODES)]
    codes = keep(vectors.select("_id", "label", "_v").mapInArrow(
        _codes(spark.sparkContext.broadcast(models)), f"_id long, label {vectors.schema['label'].dataType.simpleString()}, _dims int, "
        + ", ".join(f"_c{k} long" for k in range(CODES))))
    parts = [F.struct(F.lit(k * BITS // PART + p).alias("t"), F.col(f"_c{k}").alias("code"),
                      F.shiftrightunsigned(F.col(f"_c{k}"), p * PART).bitwiseAND((1 << PART) - 1).alias("key"))
             for k in range(CODES) for p in range(BITS // PART)]
    table = codes.select("_id", "label", "_dims", F.explode(F.array(*parts)).alias("p")).select("_id", "label", "_dims", "p.*")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(PART)])
    probe = table.select(F.col("_id").alias("b"), F.col("label").alias("_l"), F.col("_dims").alias("_n"), F.col("t").alias("_t"),
                         F.col("code").alias("_code"), F.col("key").alias("_key"), F.explode(flips).alias("_flip"))
    probe = probe.withColumn("_key", F.col("_key").bitwiseXOR(F.col("_flip"))).drop("_flip")
    near = table.join(probe, (F.col("label") == F.col("_l")) & (F.col("_dims") == F.col("_n")) & (F.col("t") == F.col("_t"))
                      & (F.col("key") == F.col("_key")) & (F.col("_id") < F.col("b")))
    near = near.where(F.bit_count(F.col("code").bitwiseXOR(F.col("_code"))) <= RADIUS)
    pairs = near.select(F.col("_id").alias("a"), "b").distinct()
    v = vectors.select("_id", "_v")
    pairs = pairs.join(v.select(F.col("_id").alias("a"), F.col("_v").alias("_va")), "a").join(
        v.select(F.col("_id").alias("b"), F.col("_v").alias("_vb")), "b")
    return pairs.select("a", "b", "_va", "_vb").mapInArrow(_rerank(threshold), "a long, b long, cos double")


def dedup(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``table(vec_id, embedding, label)``.

    Equal vectors of a label are one class: the tables hold one vector per
    class, links of copies are counted, not listed. Rows whose vector is null,
    empty, zero or holds null or non-finite components, or whose label is null,
    link with nothing and keep their own id; vectors of different lengths do
    not link. Repeated vec_ids are vectors of their own; null ids count as
    links but name no component unless all of it are null. ``table`` must be
    a table or scan, whose row numbers are stable.
    """
    v = F.col("embedding").cast("array<double>")
    good = (F.col("label").isNotNull() & F.coalesce(F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))
            & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False)))
    rows = keep(table.select(F.monotonically_increasing_id().alias("_row"), "vec_id", "label", v.alias("_v"), good.alias("_good"))
                .withColumn("_h", F.xxhash64("label", "_v")).withColumn("_g", F.xxhash64(F.lit(1), "_v", "label")))
    on = rows.where("_good")
    classes = keep(on.groupBy("_h", "_g").agg(F.min("_row").alias("_id"), F.count("*").alias("_copies"), F.min("vec_id").alias("_least")))
    vectors = on.join(classes.select(F.col("_id").alias("_row")), "_row", "left_semi").select(F.col("_row").alias("_id"), "label", "_v")
    pairs = keep(links(vectors, threshold).select("a", "b"))
    size = classes.select(F.col("_id").alias("b"), "_copies")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(size, "b").groupBy(F.col("a").alias("_id")).agg(F.sum("_copies").alias("_others"))
    comp = components(pairs).select(F.col("id").alias("_id"), "component")
    c = classes.join(degree, "_id", "left").join(comp, "_id", "left")
    c = keep(c.select("_h", "_g", "_least", F.coalesce("component", "_id").alias("_comp"),
                      (F.col("_copies") - 1 + F.coalesce("_others", F.lit(0))).alias("_links")))
    least = c.groupBy("_comp").agg(F.min("_least").alias("_component"))
    c = c.join(least, "_comp").select(F.col("_h").alias("_x"), F.col("_g").alias("_y"), "_links", "_component")
    out = rows.select("vec_id", "_good", "_h", "_g").join(c, (F.col("_h") == F.col("_x")) & (F.col("_g") == F.col("_y")) & F.col("_good"), "left")
    component = F.coalesce("_component", "vec_id")
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
