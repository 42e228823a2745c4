"""Edge cases on small hand-made frames: empty input, NULLs, ties,
single-row groups, zero variance."""

import datetime as dt

from pyspark.sql import functions as F

from sparklab.operators import h2o, relational as R


def test_first_per_group_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 2, 1, 10.0), ("a", 1, 2, None), ("a", 1, 1, 5.0), ("b", 3, 0, 1.0)],
                               "k string, t int, id int, v double")
    out = {r["k"]: (r["t"], r["id"], r["v"]) for r in R.first_per_group(df, "k", ["t", "id"]).collect()}
    assert out == {"a": (1, 1, 5.0), "b": (3, 0, 1.0)}


def test_first_per_group_empty(spark):
    df = spark.createDataFrame([], "k string, t int, v double")
    assert R.first_per_group(df, "k", "t").count() == 0


def test_series_extremes_first_key_wins(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 3.0), (3, 3.0), (4, 0.0), (5, 1.0)], "k int, v double")
    r = R.series_extremes(df, "k", "v").first()
    assert (r.argmin_key, r.argmax_key, r.first_nonzero_key) == (1, 2, 2)


def test_bool_share_and_counts(spark):
    df = spark.createDataFrame([("x", True), ("x", False), ("y", True)], "g string, f boolean")
    assert R.bool_share(df, "f").first()[0] == 2 / 3
    got = {(r.g, r.f): r.n for r in R.value_counts(df, "g", "f").collect()}
    assert got == {("x", True): 1, ("x", False): 1, ("y", True): 1}


def test_join_size_equals_materialised_join(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "key int, x string")
    b = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (2, 4.0), (9, 0.0)], "key int, y double")
    r = R.join_size(a, b, "key").first()
    assert r.rows == a.join(b, "key").count() == 7
    assert r.cols == 3 and r.size == 21


def test_join_small_forces_no_broadcast(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(50).withColumnRenamed("id", "k")
    j = R.join_small(big, small, "k")
    assert j.count() == 50 and "ResolvedHint" not in j._jdf.queryExecution().analyzed().toString()


def test_align_disjoint_gives_nulls(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "ts int, v double")
    b = spark.createDataFrame([(3, 1.0), (4, 2.0)], "ts int, v double")
    assert R.align_subtract(a, b, "ts", ["v"]).first().v is None
    c = spark.createDataFrame([(2, 5.0), (3, 1.0)], "ts int, v double")
    assert R.align_subtract(a, c, "ts", ["v"]).first().v == 3.0


def test_natural_join_on_shared_columns(spark):
    a = spark.createDataFrame([(1, 0.5, 2.0)], "id int, x double, y double")
    b = spark.createDataFrame([(1, 0.5, 9.0), (1, 0.25, 9.0)], "id int, x double, z double")
    out = R.natural_join(a, b)
    assert out.count() == 1 and set(out.columns) == {"id", "x", "y", "z"}


def test_range_sort_partitions_are_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    parts = R.range_sort(df, "v", 4).rdd.glom().collect()
    flat = [r.v for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == 1000


def test_top_n_and_dedup(spark):
    df = spark.createDataFrame([("a", 3.0, 1), ("a", 3.0, 2), ("a", 1.0, 3), ("b", 2.0, 4)], "g string, v double, id int")
    top = R.top_n_per_group(df, "g", [F.col("v").desc(), F.col("id")], 2)
    assert sorted((r.g, r.id) for r in top.collect()) == [("a", 1), ("a", 2), ("b", 4)]
    d = R.dedup(df, "v", "id")
    assert sorted(r.id for r in d.collect()) == [1, 3, 4]


def test_hash_split_is_a_partition_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, b = R.hash_split(df, "k", [0.8, 0.2], seed=3)
    ka, kb = {r.k for r in a.collect()}, {r.k for r in b.collect()}
    assert ka.isdisjoint(kb) and len(ka | kb) == 2000
    assert 0.75 < len(ka) / 2000 < 0.85
    assert {r.k for r in R.hash_split(df, "k", [0.8, 0.2], seed=3)[0].collect()} == ka


def test_remove_outliers_bounds(spark):
    df = spark.createDataFrame([(float(x),) for x in [-1, 0, 1, 2, 3, 4, 100]], "x double")
    kept = sorted(r.x for r in R.remove_outliers(df, "x", exact=True).collect())
    # Q3 = 3.5 -> upper = 3.5 + 1.5 * 3.5 = 8.75
    assert kept == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_map_values_keeps_unmapped(spark):
    df = spark.createDataFrame([("HV0003",), ("HV9999",)], "lic string")
    out = [r.c for r in R.map_values(df, "lic", {"HV0003": "Uber"}, out="c").collect()]
    assert out == ["Uber", "HV9999"]


def test_clean_wide_and_select_range(spark):
    df = spark.createDataFrame([(1, "x", None, 2.5)], "a int, b string, c double, d double")
    out = R.clean_wide(df, rename={"a": "A"}, replace={"x": "xxx"}, fill={"c": 100.0}, cast={"d": "int"},
                       keep=("b", "d"))
    assert out.columns == ["b", "c", "d"]
    assert tuple(out.first()) == ("xxx", 100.0, 2)


def test_relax_schema(spark):
    df = spark.createDataFrame([(dt.date(2020, 2, 29),)], "d date").select(
        "d", F.lit(1.25).cast("decimal(5,2)").alias("m"))
    out = R.relax_schema(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["timestamp_ntz", "double"]


def test_h2o_q9_zero_variance_is_null(spark):
    df = spark.createDataFrame([("a", 1, 1, 2), ("a", 1, 1, 3), ("b", 2, 1, 1), ("b", 2, 2, 2)],
                               "id2 string, id4 int, v1 int, v2 int")
    got = {r.id2: r.r2 for r in h2o.h2o_q9(df).collect()}
    assert got["a"] is None and abs(got["b"] - 1.0) < 1e-12


def test_h2o_q6_single_row_std_is_null(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 1.0), (1, 2, 3.0)], "id4 int, id5 int, v3 double")
    got = {r.id5: (r.median_v3, r.sd_v3) for r in h2o.h2o_q6(df).collect()}
    assert got[1] == (5.0, None) and got[2][0] == 2.0


def test_h2o_q8_drops_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, 2.0), (1, 5.0), (1, 3.0), (2, None)], "id6 int, v3 double")
    out = sorted((r.id6, r.v3) for r in h2o.h2o_q8(df).collect())
    assert out == [(1, 3.0), (1, 5.0)]


def test_window_group_limit_in_plan(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("id6"), F.col("id").cast("double").alias("v3"))
    plan = h2o.h2o_q8(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "AdaptiveSparkPlan" in plan


def test_point_in_polygon_with_hole(spark):
    outer = [(0, 0), (10, 0), (10, 10), (0, 10)]
    hole = [(3, 3), (7, 3), (7, 7), (3, 7)]
    pts = [(1.0, 1.0), (5.0, 5.0), (9.0, 5.0), (11.0, 5.0), (5.0, -1.0), (2.0, 8.0)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    got = sorted((r.lon, r.lat) for r in R.filter_area(df, [outer, hole]).collect())
    assert got == [(1.0, 1.0), (2.0, 8.0), (9.0, 5.0)]


def test_compare_libraries_outer(spark):
    df = spark.createDataFrame([("dataframe", 1, 2.0), ("dataframe", 2, 4.0), ("polars", 1, 1.0), ("polars", 3, 5.0)],
                               "library string, query int, duration double")
    out = {(r.library, r.query): r.relative_diff for r in R.compare_libraries(df, "dataframe", "query").collect()}
    assert out[("polars", 1)] == -0.5 and out[("polars", 2)] is None and out[("polars", 3)] is None
    assert out[("dataframe", 1)] is None and len(out) == 5


def test_number_rows_consecutive_over_union(spark):
    a = spark.range(0, 3000, 3).withColumn("src", F.lit(0))
    b = spark.range(1, 3000, 2).withColumn("src", F.lit(1))
    out = R.number_rows(a.unionByName(b), ["src", "id"], name="n", partitions=7).toPandas()
    out = out.sort_values(["src", "id"]).reset_index(drop=True)
    assert list(out.n) == list(range(1, len(out) + 1))


def test_exact_quantile_hot_group_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    hot = rng.normal(size=3000)            # one group holds most rows
    rows = ([("hot", float(v)) for v in hot] + [("a", 1.0), ("a", 2.0), ("b", 7.0)]
            + [(f"g{k}", float(v)) for k, v in enumerate(rng.normal(size=200))] + [("n", None)])
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for q in (0.5, 0.75, 0.1):
        got = {r.k: r.q_v for r in R.exact_quantile(df, "k", "v", q).collect()}
        assert abs(got["hot"] - np.quantile(hot, q)) < 1e-12
        assert got["a"] == np.quantile([1.0, 2.0], q) and got["b"] == 7.0
        assert "n" not in got
    ranked = R.rank_within_groups(df.filter("k = 'hot'"), "k", "v", partitions=6)
    assert sorted(r._pos for r in ranked.collect()) == list(range(3000))
    glob = R.exact_quantile(df, [], "v", 0.5).first().q_v
    assert abs(glob - np.quantile([v for _, v in rows if v is not None], 0.5)) < 1e-12


def test_sizing_conf():
    from sparklab.session import sizing_conf

    c = sizing_conf(100 * 10**12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 << 20))
    assert int(sizing_conf(10**6, 8)["spark.sql.shuffle.partitions"]) == 16


def test_exact_global_quantile_bracketed_path(spark):
    import numpy as np

    rng = np.random.default_rng(9)
    vals = np.concatenate([rng.integers(0, 50, 150_000).astype(float), rng.normal(size=100_000)])  # heavy ties
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(6)
    for q in (0.5, 0.75, 0.999):
        got = R.exact_quantile(df, [], "v", q).first().q_v
        assert abs(got - np.quantile(vals, q)) < 1e-12, (q, got, np.quantile(vals, q))
