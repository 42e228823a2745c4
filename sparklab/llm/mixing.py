"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws an exponential key whose rate is its quality weight;
sorted by key within the source, documents are taken up to the source's word
budget. Whole epochs come first, the sorted selection covers the remainder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklab.llm.common import keep, read

#: Weights by rank of the source, repeating; a target stops at this multiple of its source
WEIGHTS = (1, 2, 3)
MOST = 3
#: running sums within a source are split into this many ranges of keys
RANGES = 4096
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST) -> DataFrame:
    """Word budget per source; one row per source, so the windows are over sources only.

    A target is the smaller of ``most`` times the source's size and its weight
    times the common level at which all targets add up to all words. With the
    sources sorted by how early they reach their bound, the level is the
    largest of (words left after the bounded ones) / (weights left).
    """
    every = Window.partitionBy(F.lit(0))
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    no = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    s = s.withColumn("_w", F.element_at(F.array(*[F.lit(w) for w in weights]), ((no - 1) % len(weights) + 1).cast("int")).cast("double"))
    by = every.orderBy(F.lit(float(most)) * F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(every)
    before = F.sum(F.lit(most) * F.col("source_size")).over(by) - F.lit(most) * F.col("source_size")
    left = F.sum("_w").over(every) - F.sum("_w").over(by) + F.col("_w")
    s = s.withColumn("_level", (total - before).cast("double") / left)
    return s.select("source", "source_size", F.least(F.lit(float(most)) * F.col("source_size"), F.col("_w") * F.max("_level").over(every)).alias("target"))


def words_of(column: str) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words, without the text."""
    return docs.select("doc_id", "source", words_of("text").alias("size"))


def mix_sources(docs: DataFrame, quality: Column | None = None, seed: str = "mix") -> DataFrame:
    """Words taken of every document: doc_id, source, size, source_size, target, taken.

    ``docs`` has texts, or ``sized`` rows. ``quality`` is the positive sampling weight of a row (default 1; null 1).
    ``taken`` is epochs * size, plus for the fractional part the documents
    with the smallest keys until the remainder is used up; the document at the
    edge gives only its first words, so each source's sum is its target
    rounded down. The draw is a hash of seed and doc_id: reruns agree.

    Null text has size 0, a null source is a source of its own (the last), a
    null doc_id draws as the word "null". Repeated rows are separate
    documents; equal keys are ordered by doc_id and size, rows equal in those
    too are interchangeable. An empty table gives an empty result.
    """
    if "text" in docs.columns:
        docs = docs.withColumn("size", words_of("text"))
    u = (F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))), 1, 13), 16, 10)
         .cast("double") + 0.5) / float(1 << 52)
    weight = F.coalesce(quality, F.lit(1.0)) if quality is not None else F.lit(1.0)
    # narrow rows, read again for targets, ranges and selection
    d = keep(docs.select("doc_id", "source", "size", (-F.log(u) / weight).alias("_key")))
    t = targets(d)
    # where a key lies: the keys' own distribution makes the ranges even
    d = d.withColumn("_range", F.least(F.lit(RANGES - 1), F.floor(F.lit(float(RANGES)) * (1 - F.exp(-F.col("_key"))))).cast("int"))
    r = d.groupBy("source", "_range").agg(F.sum("size").alias("_n"))
    r = r.select(F.col("source").alias("_s"), F.col("_range").alias("_r"),
                 (F.sum("_n").over(Window.partitionBy("source").orderBy("_range")) - F.col("_n")).alias("_start"))
    t = r.join(t.withColumnRenamed("source", "_t"), F.col("_s").eqNullSafe(F.col("_t"))).drop("_t")
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_before", F.sum("size").over(inside) - F.col("size"))
    d = d.join(t, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    words = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("long")
    rest = words - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start") - F.col("_before")))
    return d.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``_quality``: 2 if labelled good, 0.5 if bad, 1 without label (a bad label wins over a good one)."""
    best = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_q"))
    return docs.join(best, F.col("doc_id") == F.col("_id"), "left").withColumn(
        "_quality", F.when(F.col("_q") == 1, 2.0).when(F.col("_q") == 0, 0.5).otherwise(1.0)).drop("_id", "_q")


def labelled_mix(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``mix_sources`` with the quality weights of ``labels``; texts are counted before the join."""
    return mix_sources(with_labels(sized(docs), read(spark, sf_dir, "labels")), F.col("_quality"))


SQL = r"""
WITH q AS (SELECT doc_id, min(quality) AS q FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT d.doc_id, d.source, coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        -ln((('0x' || substr(md5('mix' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
          / (CASE q.q WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS k
      FROM documents d LEFT JOIN q ON d.doc_id = q.doc_id),
s AS (SELECT source, sum(size)::BIGINT AS source_size, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS w FROM d GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER () - sum(3 * source_size) OVER o + 3 * source_size)::DOUBLE
        / (sum(w) OVER () - sum(w) OVER o + w) AS level
      FROM s WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, w * max(level) OVER ()) AS target FROM l),
r AS (SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS words,
        CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS epochs,
        (sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size)::BIGINT AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
  (epochs * size + greatest(0, least(size, words - epochs * source_size - before)))::BIGINT AS taken FROM r
"""
