"""The pipeline's stages, one after the other, on a small table."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from sparklab.llm import decontaminate
from sparklab.llm.common import read

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = [read(spark, SF, "documents")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], SF).write.parquet(f"{folder}/{k}")
        docs.append(spark.read.parquet(f"{folder}/{k}"))
    return docs


def test_stages_keep_the_columns(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near dedup", "decontamination", "mixing"]
    for d in tables[1:-1]:
        assert d.columns == tables[0].columns


def test_quality_stage_goes_by_the_labels(spark, tables):
    labels = read(spark, SF, "labels")
    kept = tables[1].select("doc_id")
    assert labels.where("quality = 1").join(kept, "doc_id", "left_anti").count() <= 0.01 * labels.where("quality = 1").count()
    bad = labels.where("quality = 0")
    assert bad.join(kept, "doc_id").count() <= 0.1 * bad.count()


def test_line_stage_only_cuts_repeated_runs(tables):
    before = {r.doc_id: r.text for r in tables[1].collect()}
    seen, left = set(), {r.doc_id: r for r in tables[2].collect()}
    for i in sorted(before):
        lines = before[i].split("\n")
        gone = set()
        for p in range(len(lines)):
            for k in (1, 2, 3):
                run = tuple(lines[p:p + k])
                if len(run) < k or (k < 3 and sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in run) < 50):
                    continue
                if run in seen:
                    gone |= set(range(p, p + k))
                seen.add(run)
        kept = "\n".join(x for p, x in enumerate(lines) if p not in gone)
        if i in left:
            assert left[i].text == kept
            assert left[i].n_chars == len(kept) if gone else True
        else:
            assert gone and not kept.strip()


def test_near_stage_keeps_one_of_each_group(tables):
    def shingles(t):
        w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t).split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}

    sets = {r.doc_id: shingles(r.text) for r in tables[2].collect()}
    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    links = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    links = [(a, b) for a, b in links if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {r.doc_id for r in tables[3].collect()} == {find(i) for i in sets}


def test_benchmark_stage_leaves_no_window(spark, tables):
    benchmark = read(spark, SF, "benchmark")
    assert decontaminate.contamination(tables[3], benchmark).where("contaminated").count() > 0
    assert decontaminate.contamination(tables[4], benchmark).where("contaminated").count() == 0
    clean = decontaminate.contamination(tables[3], benchmark).where("NOT contaminated").select("doc_id")
    same = tables[3].join(clean, "doc_id").join(tables[4].select("doc_id", F.col("text").alias("after")), "doc_id").where("text = after")
    assert same.count() == clean.count()


def test_mix_stage_meets_its_targets(tables):
    per = tables[5].groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert per and all(abs(r.taken - r.target) <= 1 for r in per)
    assert tables[5].count() == tables[4].count()


def test_run_equals_the_stages(spark, tables):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, tables[5].collect()))


def test_queries_are_registered():
    q = __spark_entry__.queries()
    assert "pipeline" in q and all(any(n.startswith(f"op{k}_") for n in q) for k in range(1, 11))
    assert {"op1_line_dedup", "op4_mixing"} <= set(__spark_entry__.oracle_sql())
