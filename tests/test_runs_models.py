"""Run-history analytics on crafted histories; bootstrap invariants; model
quality bounds (no oracle for these)."""

import datetime as dt

from pyspark.sql import functions as F

from sparklab.operators import features, runs


def _history(spark, values, name="t[1]", runtime="py0", start=dt.datetime(2024, 1, 1)):
    rows = []
    for k, v in enumerate(values):
        rows.append((k, k // 3, name, "t", "suite/test_t.py", runtime, "3.11.2", "0.1.0", "linux",
                     start + dt.timedelta(hours=k), start + dt.timedelta(hours=k, seconds=5), v, v * 1e6, v * 2e6,
                     "passed", "dataframe", 1))
    return spark.createDataFrame(rows, """id long, session_id long, name string, originalname string, path string,
        runtime string, python_version string, runtime_version string, platform string,
        start timestamp_ntz, `end` timestamp_ntz, duration double, average_memory double, peak_memory double,
        call_outcome string, library string, query int""")


def test_regression_flagged_only_when_last_n_exceed(spark):
    base = [10.0, 10.0, 10.5, 9.5, 10.0, 10.2, 9.8, 10.1, 9.9, 10.0, 10.0]  # 11 + 3 > 10 + 3
    h = _history(spark, base + [20.0, 21.0, 22.0])
    flagged = runs.detect_regressions(h, "2024-01-02", n_last=3)
    types = {r.type for r in flagged.collect()}
    assert "duration" in types  # 20 >= 10 + max(3 * std, 1)
    calm = _history(spark, base + [10.0, 20.0, 21.0])
    assert "duration" not in {r.type for r in runs.detect_regressions(calm, "2024-01-02", n_last=3).collect()}
    # idle for 7+ days: skipped
    assert runs.detect_regressions(h, "2024-02-01", n_last=3).count() == 0
    # too few values (needs > 10 + n)
    assert runs.detect_regressions(_history(spark, base[:10] + [20.0, 21.0, 22.0]), "2024-01-02").count() == 0


def test_bootstrap_replicates_and_probabilities(spark):
    a = _history(spark, [10.0, 11.0, 9.0, 10.0], runtime="A")
    b = _history(spark, [20.0, 22.0, 18.0, 20.0], runtime="B").withColumn("id", F.col("id") + 100)
    r = runs.label_runs(a.unionByName(b))
    out = runs.ab_confidence(r, "duration", "A", "B", reps=500, seed=0)
    rows = {(x.xlabel): x.p for x in out.collect()}
    assert len(rows) == 34 and rows[">80%"] > 0.9 and rows["<0%"] == 0.0


def test_bootstrap_has_exactly_reps_replicates(spark):
    a = _history(spark, [1.0, 2.0, 3.0], runtime="A")
    b = _history(spark, [2.0, 2.0, 5.0], runtime="B").withColumn("id", F.col("id") + 100)
    out = runs.ab_confidence(runs.label_runs(a.unionByName(b)), "duration", "A", "B", reps=1000)
    p = {x.xlabel: x.p for x in out.collect()}
    # probabilities are multiples of 1/1000
    assert all(abs(v * 1000 - round(v * 1000)) < 1e-9 for v in p.values())


def test_bootstrap_draws_each_run_without_shuffling_draws(spark):
    """The shares are those of the stated hashes; ids of several lengths, null ids, a test with runs of one runtime, one whose A is 0."""
    import hashlib

    import numpy as np

    reps = 1300  # more than a task draws
    rng = np.random.default_rng(1)
    ids = [7, 12, 345, 10 ** 6, 10 ** 6 + 1, 99, None, 2 ** 40, 5, -3]
    rows = [(i, "t" if k % 2 else None, f"py{k // 2 % 2}", k % 3, round(float(rng.gamma(4)), 2)) for k, i in enumerate(ids * 4)]
    rows += [(1, "one side", "py0", 0, 1.0), (1, "zero", "py0", 0, 0.0), (2, "zero", "py1", 0, 1.0)]
    df = spark.createDataFrame(rows, "id long, fullname string, runtime string, start int, duration double")
    hashed = {(r.id, r.rep): r.h for r in df.select("id").distinct().select(
        "id", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep")).select("id", "rep", F.xxhash64("id", "rep", F.lit(-5)).alias("h")).collect()}
    for portable in (True, False):
        def mean(name, runtime, r, portable=portable):
            own = sorted((x for x in rows if x[1:3] == (name, runtime)), key=lambda x: (x[3], x[0] is not None, x[0], x[4]))
            at = [(int(hashlib.md5(f"{x[0]}-{r}".encode()).hexdigest()[:8], 16) if x[0] is not None else 0) if portable else hashed[x[0], r] for x in own]
            return sum(round(own[h % len(own)][4] * 100) for h in at) / 100.0 / len(own)

        out = runs.ab_confidence(df, "duration", "py0", "py1", reps=reps, seed=-5, portable=portable)
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
        got = {(r.fullname, r.xlabel): r.p for r in out.collect()}
        assert len(got) == 3 * 34 and got["zero", "<0%"] is None
        for name in ("t", None):
            ratio = [mean(name, "py1", r) / mean(name, "py0", r) - 1 for r in range(reps)]
            for k in range(-16, 17):
                if k <= 0:
                    assert got[name, f"<{k * 5}%"] == sum(x < k / 20.0 for x in ratio) / reps
                if k >= 0:
                    assert got[name, f">{k * 5}%"] == sum(x > k / 20.0 for x in ratio) / reps
    long = runs.md5_heads([b"x" * 60], range(10, 12))[0].tolist()
    assert long == [int(hashlib.md5(b"x" * 60 + b"%d" % r).hexdigest()[:8], 16) for r in (10, 11)]


def test_merge_runs_fresh_consecutive_ids(spark):
    a = _history(spark, [1.0, 2.0])
    b = _history(spark, [3.0, 4.0, 5.0])
    m = runs.merge_runs(a.select("id", "start", "duration"), b.select("id", "start", "duration"))
    assert [r.id for r in m.orderBy("id").collect()] == [1, 2, 3, 4, 5]
    assert [r.duration for r in m.orderBy("id").collect()] == [1.0, 2.0, 3.0, 4.0, 5.0]


def test_apply_rules(spark):
    h = _history(spark, [1.0, 2.0]).withColumn("runtime_version", F.when(F.col("id") == 0, "AB_x").otherwise("0.1"))
    out = runs.apply_rules(h, [{"rename": "originalname", "from": "t", "to": "u"},
                               {"prefix": "path", "from": "suite/", "to": "bench/"},
                               {"delete": "runtime_version LIKE 'AB_%'"}])
    r = out.collect()
    assert len(r) == 1 and r[0].originalname == "u" and r[0].path == "bench/test_t.py"


def test_gbt_beats_mean_predictor(spark):
    from sparklab.operators.relational import hash_split
    from sparklab.tables import Tables
    from tests.conftest import SF001

    li = Tables(spark, SF001).raw("lineitem").withColumn("net_qty", F.col("l_quantity") * (1 - F.col("l_discount")))
    cols = ["l_quantity", "l_discount", "l_tax", "l_partkey", "l_linenumber"]
    tr, te = hash_split(li, ["l_orderkey", "l_linenumber", "l_partkey"], [0.8, 0.2], seed=42)
    _, pred, rmse = features.train_gbt(tr, cols, "net_qty", te)
    mean = tr.agg(F.avg("net_qty")).first()[0]
    base = te.agg(F.sqrt(F.avg((F.col("net_qty") - mean) ** 2))).first()[0]
    assert pred.count() == te.count() and rmse < 0.5 * base


def test_models_of_weighted_cells_are_those_of_all_rows(spark):
    """Trees from one weighted row per combination of bins predict what trees from all binned rows predict, and score alike; NULLs and a constant."""
    import pytest
    from pyspark.ml.regression import GBTRegressor

    df = spark.range(6000).select("id", (F.rand(1) * 100).alias("x"), (F.col("id") % 7).cast("int").alias("n"), F.lit(3).alias("c"))
    df = df.withColumn("y", F.col("x") * F.col("n") + F.rand(2)).withColumn("x", F.when(F.col("id") % 100 != 0, F.col("x")))
    df = spark.createDataFrame(df.collect(), df.schema)
    names = ["x", "n", "c"]
    model, pred, rmse = features.train_gbt(df, names, "y", max_iter=5)
    cells = features.bin_cells(df, features.bin_stages(df, names), "y")
    assert cells.count() <= 32 * 7 and cells.agg(F.sum("weight")).first()[0] == 5940  # rows without x are left out, as before
    binned = model.stages[1].transform(model.stages[0].transform(df.withColumn("label", F.col("y"))))
    plain = GBTRegressor(maxIter=5, maxDepth=4, stepSize=0.1, seed=42).fit(binned)
    want = {round(r.label, 9): r.prediction for r in plain.transform(binned).collect()}
    got = {round(r.label, 9): r.prediction for r in pred.collect()}
    assert got.keys() == want.keys() and len(got) == 5940 and max(abs(got[k] - want[k]) for k in got) < 1e-6
    assert abs(rmse - (sum((k - v) ** 2 for k, v in got.items()) / len(got)) ** 0.5) < 1e-6
    # a fold's error from its cells is that of its rows
    r = next(r for r in features.fold_scores(df, names, "y", ["id"], n_trials=1, folds=2).collect() if r.fold == 0)
    stages = features.bin_stages(df, names)
    d = df.withColumn("_fold", F.coalesce(features_bucket(), F.lit(0)).cast("int"))
    whole = stages[1].transform(stages[0].transform(d.withColumn("label", F.col("y"))))
    fit = GBTRegressor(maxIter=r.max_iter, maxDepth=r.max_depth, stepSize=r.step_size, seed=2).fit(whole.where("_fold <> 0"))
    mse = fit.transform(whole.where("_fold = 0")).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0]
    assert abs(r.mse - mse) < 1e-6 * mse
    with pytest.raises(Exception, match="Labels MUST NOT"):
        features.train_gbt(df.withColumn("y", F.when(F.col("id") != 5, F.col("y"))), names, "y", max_iter=1)


def features_bucket():
    from sparklab.operators.relational import hash_bucket

    return hash_bucket(["id"], 2, 2, portable=True)


def test_search_scores_shape(spark):
    df = spark.range(300).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 + 1).alias("y"))
    out = features.search(df, ["x"], "y", n_trials=2, folds=2)
    rows = out.collect()
    assert len(rows) == 2 and all(r.rmse >= 0 for r in rows)


def test_categorize_codes(spark):
    df = spark.createDataFrame([("b", 10), ("a", 2), ("b", 2), (None, 3)], "s string, n int")
    out = {(r.s, r.n): (r.s_code, r.n_code) for r in features.categorize(df, ["s", "n"]).collect()}
    assert out[("a", 2)] == (0, 0) and out[("b", 10)] == (1, 2) and out[(None, 3)] == (None, 1)


def test_onepass_bootstrap_agrees_with_the_drawn_one(spark):
    """Within 0.05 on tests of 50 runs a side, and alike however the rows are cut."""
    import numpy as np

    rng = np.random.default_rng(4)
    rows = [(i, f"t{i % 3}", f"py{i // 3 % 2}", None, float(round(rng.gamma(4) * (1 + 0.1 * (i // 3 % 2) * (i % 3)), 2))) for i in range(600)]
    rows += [(1000, "lone", "py0", None, 1.0), (1001, "lone", "py1", None, 2.0), (1002, "one side", "py0", None, 1.0), (1003, None, "py0", None, 1.0), (1004, None, "py1", None, 2.0)]
    df = spark.createDataFrame(rows, "id long, fullname string, runtime string, start timestamp, duration double")
    drawn = {(r.fullname, r.xlabel): r.p for r in runs.ab_confidence(df, "duration", "py0", "py1", reps=4000).collect()}
    once = {(r.fullname, r.xlabel): r.p for r in runs.ab_confidence_onepass(df, "duration", "py0", "py1", reps=4000).collect()}
    again = {(r.fullname, r.xlabel): r.p for r in runs.ab_confidence_onepass(df.repartition(11), "duration", "py0", "py1", reps=4000).collect()}
    assert once == again and not any(k[0] == "one side" for k in once)
    assert once["lone", ">80%"] == 1.0 and once["lone", "<0%"] == 0.0 and once[None, ">80%"] == 1.0
    assert len(once) == 5 * 34
    assert max(abs(once[k] - drawn[k]) for k in once if k[0] and k[0][0] == "t") < 0.05
    w = runs.replicate_weights(np.arange(200), 5000)
    assert abs(w.mean() - 1) < 0.01 and abs(w.var() - 1) < 0.02
    assert abs(np.corrcoef(w[:20])[np.triu_indices(20, 1)]).max() < 0.08
