"""Ids of any type, repeated ids, and files that are read twice."""

import pytest
from pyspark.sql import functions as F

from sparklab.llm import line_dedup, minhash, quality
from sparklab.llm.common import with_rows

LINES = "\n".join(f"line {i} of a text that is long enough" for i in range(4))


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("twice")) + "/documents.parquet"
    rows = [(1, LINES, "en", "s", len(LINES)), (2, "something else", "en", "s", 14)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(path)
    return path


def test_rows_of_a_file_read_twice_are_rows_of_their_own(spark, docs):
    once, twice = spark.read.parquet(docs), spark.read.parquet(docs, docs)
    assert sorted(r.n for r in with_rows(once, "n").collect()) == [0, 1]
    assert len({r.n for r in with_rows(twice, "n").collect()}) == twice.count() == 4
    assert sorted(r.n_removed for r in line_dedup.dedup_lines(twice).collect()) == [0, 0, 0, 4]
    assert sum(r.first for r in minhash.near_duplicates(twice).collect()) == 2


@pytest.mark.parametrize("kind", ["string", "int", "decimal(20,0)"])
def test_line_dedup_takes_ids_of_any_type(spark, docs, kind):
    d = spark.read.parquet(docs).withColumn("doc_id", F.col("doc_id").cast(kind))
    both = d.unionByName(d.withColumn("doc_id", (F.col("doc_id").cast("long") + 5).cast(kind))).unionByName(d.withColumn("doc_id", F.lit(None).cast(kind)))
    got = {r.doc_id and int(r.doc_id): r.n_removed for r in line_dedup.dedup_lines(both).collect() if r.n_lines == 4}
    assert got == {None: 0, 1: 4, 6: 4}


def test_quality_takes_ids_of_any_type_and_repeated_ones(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    text = lambda df: df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    n = d.count()
    assert quality.classify(text(d), text(labels)).count() == n
    hot = d.unionByName(d.withColumn("doc_id", F.lit(3).cast("long")))
    assert quality.classify(hot, labels).count() == 2 * n
