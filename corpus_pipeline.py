"""Training-data pipeline: quality, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it to the shared folder and hands the reread table to the next stage. All
stages but the last return the columns of ``documents``; where a stage edits
``text``, ``n_chars`` follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.llm import decontaminate, line_dedup, minhash, mixing, quality
from sparklab.llm.common import free_name, keep, read


def _edited(docs: DataFrame, changed: DataFrame, old: str) -> DataFrame:
    """``changed`` (docs with the former text in ``old``) in the columns of ``docs``; a document
    that had words and has none left goes."""
    same = F.col(old).eqNullSafe(F.col("text"))
    has = lambda c: F.coalesce(F.col(c).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    size: Column = F.when(same, F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.where(same | has("text") | ~has(old)).select(
        *[size.alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the co-trained classifier rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: later copies of repeated runs of three lines, or of 50 words in one or two, go."""
    old = free_name(docs, "_old_text")
    return _edited(docs, line_dedup.dedup_lines(docs.withColumn(old, F.col("text"))), old)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group of near duplicates stays (five words, 0.8)."""
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: passages of the benchmark are cut out of the texts."""
    old = free_name(docs, "_old_text")
    return _edited(docs, decontaminate.remove_spans(docs.withColumn(old, F.col("text")), read(spark, sf_dir, "benchmark")), old)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: words taken of each document."""
    return mixing.labelled_mix(spark, docs, sf_dir)


STAGES = [("quality classifier", quality_stage), ("line dedup", line_stage), ("near dedup", near_stage),
          ("decontamination", benchmark_stage), ("mixing", mix_stage)]

#: the trained classifier can't be written in SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
