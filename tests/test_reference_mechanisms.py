"""Dictionaries, table differences, least squares, search scores and file samples on awkward input."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklab import sources
from sparklab.operators import features, grid
from sparklab.operators.check import diff_tables


def test_dictionary_of_all_kinds_of_columns(spark):
    rows = [("b", 10, 1.5, True, dt.date(2020, 1, 2), dt.datetime(2020, 1, 1, 5)), ("a", 9, float("nan"), False, dt.date(2019, 1, 1), None),
            (None, None, None, None, None, None), ("", 10, -0.5, True, dt.date(2020, 1, 2), dt.datetime(2019, 1, 1)), ("B", 2 ** 60, 1.5, None, None, dt.datetime(2019, 1, 1))]
    df = spark.createDataFrame(rows, "s string, i long, d double, b boolean, day date, ts timestamp_ntz").withColumn("m", F.col("i").cast("decimal(30,2)"))
    cols = ["s", "i", "d", "b", "day", "ts", "m"]
    got = features.categorize(df, cols)
    assert got.columns == [*cols, *[c + "_code" for c in cols]] and got.count() == 5
    for c in cols:
        pairs = {(r[c] if r[c] == r[c] else "nan", r[c + "_code"]) for r in got.collect()}
        values = sorted({r[c] for r in df.collect() if r[c] is not None and r[c] == r[c]}, key=lambda v: v.encode() if isinstance(v, str) else v)
        want = {(v, k) for k, v in enumerate(values)} | {(None, None)}
        assert pairs == (want | {("nan", 2)} if c == "d" else want)
    with pytest.raises(ValueError, match="no dictionary"):
        features.categorize(df.withColumn("a", F.array("i")), ["a"])
    assert features.categorize(df.limit(0), cols).count() == 0


def test_dictionary_is_found_in_one_pass(spark):
    from sparklab.plans.registry import registry

    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_returnflag", "l_linestatus", "l_suppkey")
    plan = features.categorize(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 1 and "SortMergeJoin" not in plan
    assert "categorize" in registry().queries


def cells(df):
    return sorted((r.k is None, r.k, r.column, r.side, r.a_num, r.b_num, r.a_str, r.b_str) for r in df.collect())


def test_differences_of_hot_and_null_keys(spark):
    n = 3000
    key = F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).cast("long")
    a = spark.range(n).select(key.alias("k"), (F.col("id") % 5).cast("double").alias("v"), F.lit(" x").alias("s"))
    b = a.unionByName(spark.createDataFrame([(7, 1.0, "x"), (None, 99.0, "x")], "k long, v double, s string"))
    assert diff_tables(a, a.repartition(9), ["k"]).count() == 0
    got = cells(diff_tables(a, b, ["k"]))
    assert [g[:4] for g in got] == [(False, 7, "<row>", "b"), (True, None, "<row>", "b")]
    # one cell of a hot key moved: that row alone is reported
    moved = b.where("k = 7 AND v = 2.0").limit(1)
    c = b.exceptAll(moved).unionByName(moved.withColumn("v", F.lit(2.5)))
    got = cells(diff_tables(b, c, ["k"]))
    assert got == [(False, 7, "v", "both", 2.0, 2.5, None, None)]
    near = b.withColumn("v", F.col("v") + 0.001)
    assert diff_tables(b, near, ["k"]).count() == 0
    plan = diff_tables(a, b, ["k"])._jdf.queryExecution().analyzed().toString()
    assert "row_number" not in plan


def test_differences_with_columns_of_one_side(spark):
    a = spark.createDataFrame([(1, "p"), (1, "p"), (2, "q")], "k long, s string")
    b = spark.createDataFrame([(1, "p", 5), (3, "r", 6)], "k long, s string, more long")
    got = cells(diff_tables(a, b, ["k"]))
    assert [(g[1], g[2], g[3], g[7]) for g in got] == [(1, "<row>", "a", None), (1, "more", "both", "5"), (2, "<row>", "a", None), (3, "<row>", "b", None), (3, "more", "b", "6")]


@pytest.mark.parametrize("names", [[0, 1, 2], ["x", "y", "z"]])
def test_least_squares_in_one_job(spark, names):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3000, 3)) * (rng.random((3000, 3)) > 0.2)  # cells that aren't there
    y = x @ [1.5, -2.0, 0.25] + rng.normal(size=3000) * 0.1
    kind = "int" if names[0] == 0 else "string"
    long = spark.createDataFrame([(i, names[j], float(x[i, j])) for i in range(3000) for j in range(3) if x[i, j]], f"i int, j {kind}, value double")
    yy = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "i int, y double")
    beta, fitted = grid.ols(long, y=yy)
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    got = {r.j: r.beta for r in beta.collect()}
    assert np.allclose([got[n] for n in names], want)
    assert all(abs(r.y_hat - x[r.i] @ want) < 1e-9 for r in fitted.collect())


def test_search_scores_per_fold(spark):
    df = spark.range(600).select("id", (F.col("id") % 10).cast("double").alias("x"), F.when(F.col("id") % 50 != 0, (F.col("id") % 10) * 2.0).alias("y"))
    s = features.fold_scores(df, ["x"], "y", ["id"], n_trials=2, folds=3).collect()
    again = features.fold_scores(df.repartition(5), ["x"], "y", ["id"], n_trials=2, folds=3).collect()
    assert [r[:6] for r in s] == [r[:6] for r in again] and all(abs(a.mse - b.mse) < 1e-9 for a, b in zip(s, again, strict=True))
    assert len(s) == 6 and sum(r.n for r in s) == 2 * 588
    assert all(r.mse < 0.3 * r.mean_mse and 20 < r.mean_mse < 45 for r in s)
    best = features.search(df, ["x"], "y", ["id"], n_trials=2).collect()
    assert len(best) == 2 and all(r.rmse < 4 for r in best)


def test_sampled_folders_are_the_only_ones_read(spark, tmpdir_path):
    path = f"{tmpdir_path}/by_key"
    spark.range(2000).withColumn("key", F.concat(F.lit("a b"), F.col("id") % 20)).write.partitionBy("key").parquet(path)
    s = sources.sample_files(spark, path, 0.3, seed=3, folders=True)
    keys = {r.key for r in s.select("key").distinct().collect()}
    assert 0 < len(keys) < 15 and s.count() == 100 * len(keys)
    assert {f.split("key=")[1].split("/")[0] for f in s.inputFiles()} == {k.replace(" ", "%20") for k in keys}
    other = f"{tmpdir_path}/again"  # other files, the same keys
    spark.range(2000).withColumn("key", F.concat(F.lit("a b"), F.col("id") % 20)).repartition(7).write.partitionBy("key").parquet(other)
    assert {r.key for r in sources.sample_files(spark, other, 0.3, seed=3, folders=True).select("key").distinct().collect()} == keys
    assert sources.sample_files(spark, path, 0.0, seed=3, folders=True).count() == 100  # at least one folder


@pytest.mark.parametrize("bound,accuracy", [(1 << 24, 10_000), (0, 10_000), (500, 50), (40, 1000)])
def test_quantile_of_sorted_and_of_bracketed_groups(spark, bound, accuracy):
    """The same exact values by both ways: hot group, hot value, ties, NULL key, few rows, infinities."""
    from sparklab.operators.relational import exact_quantile

    rng = np.random.default_rng(0)
    rows = [(None if i % 5 == 0 else i % 3, 3.0 if i % 4 == 0 else float(rng.integers(0, 50)) if i % 3 else float(rng.normal())) for i in range(4000)]
    rows += [(9, None), (8, 1.0), (7, float("-inf")), (7, 2.0), (7, float("-inf"))]
    df = spark.createDataFrame(rows, "k int, v double").repartition(5)
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    for q in (0.0, 0.25, 0.5, 0.77, 1.0):
        got = {r.k: r.x for r in exact_quantile(df, "k", "v", q, "x", bound, accuracy).collect()}
        assert set(got) == set(groups)
        for k, v in groups.items():
            if k != 7:
                assert abs(got[k] - np.quantile(v, q)) < 1e-9, (k, q)
        assert got[7] == (2.0 if q == 1.0 else float("-inf"))
        whole = [v for k, v in rows if v is not None and k != 7]
        assert abs(exact_quantile(df.where("k IS DISTINCT FROM 7"), [], "v", q, "x", bound, accuracy).first().x - np.quantile(whole, q)) < 1e-9
    plan = exact_quantile(df, "k", "v", 0.5, "x", bound, accuracy)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "RDD" not in plan.split("ExistingRDD")[0]
