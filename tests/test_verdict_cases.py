"""Cases beyond the fixtures: gaps, hot values, large numbers, wide stencils, missing cells."""

import decimal
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sparklab.operators import climate, grid, relational
from sparklab.operators.check import diff_tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_compare_libraries_reports_each_gap(spark):
    rows = [("ref", 1, 2.0), ("ref", 2, 4.0), ("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0), ("b", 9, 1.0)]
    out = relational.compare_libraries(spark.createDataFrame(rows, "library string, query int, duration double"), "ref", "query")
    got = {(r.library, r["query"]): (r.duration, r.relative_diff) for r in out.collect()}
    assert got == {("ref", 1): (2.0, None), ("ref", 2): (4.0, None), ("a", 1): (1.0, -0.5), ("a", 2): (2.0, -0.5),
                   ("b", 1): (3.0, 0.5), ("b", 2): (None, None), ("b", 9): (1.0, None)}


@pytest.mark.parametrize("block", [None, 1, 2, 7, 64])
@pytest.mark.parametrize("boundary", ["none", "periodic"])
def test_stencil_depth_beyond_block(spark, block, boundary):
    n, depth = 40, 5
    rng = random.Random(1)
    v = {i: rng.randint(-9, 9) for i in range(n) if i % 11 or boundary == "periodic"}
    df = spark.createDataFrame([(i, float(x)) for i, x in v.items()], "i long, value double")
    for fn, f in (("sum", sum), ("max", max), ("mean", statistics.fmean)):
        got = {r.i: r[f"{fn}_value"] for r in grid.stencil(df, ["i"], depth, fn, boundary=boundary, shape={"i": n}, block=block).collect()}
        at = (lambda t: t % n) if boundary == "periodic" else (lambda t: t)
        want = {i: f([v[at(t)] for t in range(i - depth, i + depth + 1) if at(t) in v]) for i in v}
        assert got == pytest.approx(want)


def test_stencil_two_axes(spark):
    rng = random.Random(2)
    v = {(i, j): rng.randint(0, 99) for i in range(9) for j in range(8) if (i * j) % 7 != 3}
    df = spark.createDataFrame([(i, j, float(x)) for (i, j), x in v.items()], "i long, j long, value double")
    got = {(r.i, r.j): r.sum_value for r in grid.stencil(df, ["i", "j"], 2, "sum", block=3).collect()}
    want = {(i, j): sum(v.get((a, b), 0) for a in range(i - 2, i + 3) for b in range(j - 2, j + 3)) for i, j in v}
    assert got == want


def test_diff_tables_rows_nulls_and_columns(spark):
    a = spark.createDataFrame([(1, None, "x"), (2, 1.0, "y"), (3, 2.0, None), (None, 5.0, "n")], "k int, v double, t string")
    b = spark.createDataFrame([(2, 1.001, "y ", 7), (3, 2.5, None, None), (4, None, None, 8), (None, 5.0, "n", None)], "k int, v double, t string, e int")
    got = sorted((r.k is None, r.k, r.column, r.side) for r in diff_tables(a, b, ["k"]).collect())
    assert got == sorted([(False, 1, "<row>", "a"), (False, 3, "v", "both"), (False, 4, "<row>", "b"), (False, 2, "e", "both"),
                          (False, 3, "e", "both"), (False, 4, "e", "b"), (True, None, "e", "both")])


def test_regrid_missing_source_is_null(spark):
    weights = spark.createDataFrame([(0, 0, 0, 0, 0.5), (0, 0, 0, 1, 0.5), (0, 1, 1, 0, 1.0), (0, 2, 1, 1, 1.0)],
                                    "dst_i int, dst_j int, src_i int, src_j int, w double")
    src = spark.createDataFrame([(1, 0, 0, 4.0), (1, 0, 1, None), (1, 1, 0, None), (1, 1, 1, 3.0),
                                 (2, 0, 0, 4.0), (2, 0, 1, 6.0), (3, 0, 0, 1.0)], "time int, src_i int, src_j int, value double")
    got = {(r.time, r.dst_j): r.value for r in climate.regrid(src, weights).collect()}
    assert got == {(1, 0): None, (1, 1): None, (1, 2): 3.0, (2, 0): 5.0, (3, 0): None}


def test_fixed_sum_and_join_size_take_large_numbers(spark):
    assert spark.createDataFrame([(1e15,), (1e8,)], "v double").agg(grid.fixed_sum("v")).first()[0] == 1e15 + 1e8
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    ten = events.withColumn("_c", F.explode(F.sequence(F.lit(1), F.lit(10))))
    rows = climate.quadratic_mean(climate.events_grid(ten), "U", "V", ["level", "latitude", "longitude"], fixed=True).collect()
    assert rows and all(r.U2 > 1e6 for r in rows)
    big = spark.range(1).select(F.lit(1).alias("k"), F.lit(4_000_000_000).cast("long").alias("n"))
    lc = big.groupBy("k").agg(F.sum("n").alias("_cl"))
    assert lc.select((F.col("_cl").cast("decimal(19,0)") * F.col("_cl").cast("decimal(19,0)"))).first()[0] == decimal.Decimal(16 * 10 ** 18)
    size = relational.join_size(spark.range(300).select(F.lit(1).alias("k")), spark.range(500).select(F.lit(1).alias("k")), "k").first()
    assert (int(size["rows"]), size["cols"], int(size["size"])) == (150_000, 1, 150_000)


def test_exact_quantile_with_hot_value_and_nulls(spark):
    rng = random.Random(3)
    rows = [(g, 5.0 if rng.random() < 0.9 else rng.uniform(0, 10)) for g in ("a", "b", None) for _ in range(500)] + [("c", 1.0), ("a", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for q in (0.0, 0.25, 0.5, 0.97, 1.0):
        want = {r.g: r.x for r in df.groupBy("g").agg(F.percentile("v", q).alias("x")).collect()}
        got = {r.g: r.x for r in relational.exact_quantile(df, "g", "v", q, name="x").collect()}
        assert got == pytest.approx(want)
    assert relational.exact_quantile(df, [], "v", 0.75, name="x").first().x == df.agg(F.percentile("v", 0.75)).first()[0]


def test_first_per_group_has_no_sort_aggregate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    p = plan(relational.dedup(docs, "text", "doc_id"))
    assert "SortAggregate" not in p and "WindowGroupLimit" in p


def test_range_sort_spreads_a_hot_key(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("key"), "id")
    out = relational.range_sort(df, "key", n=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 40_000 / 8
    keys = [r.key for r in out.collect()]
    assert keys == sorted(keys)


def test_number_rows_over_many_partitions(spark):
    got = relational.number_rows(spark.range(500).select((F.col("id") * 7 % 500).alias("v")), "v", partitions=40, start=0)
    assert all(r.v == r.row_id for r in got.collect())


def test_rechunk_blocks_do_not_grow(spark):
    largest = []
    for n in (400, 4000):
        df = spark.range(n * 4).select(F.floor(F.col("id") / 4).cast("long").alias("i"), (F.col("id") % 4).alias("j"), F.col("id").cast("double").alias("value"))
        for blocks in ({"i": None, "j": 8}, {"i": 16, "j": None}):
            b = grid.rechunk(df, ["i", "j"], blocks, max_cells=256)
            largest.append(b.agg(F.max(F.size("cells"))).first()[0])
            assert b.agg(F.sum(F.size("cells"))).first()[0] == n * 4
    assert max(largest) <= 256


def test_residuals_and_anomalies_are_formed(spark):
    df = spark.createDataFrame([(i, j, float(i * i + j)) for i in range(5) for j in range(3)], "i int, j int, value double")
    r = {(x.i, x.j): x.residual for x in grid.residuals(df, "i", ["i", "j"]).collect()}
    assert r[(0, 0)] == -6.0 and r[(4, 2)] == 10.0 and len(r) == 15
    s = grid.sum_residuals(df, "i", ["i", "j"]).first()
    assert s.residual_sum == 0.0 and s.abs_sum > 1 and s.square_sum > 1


def test_eddy_flux_equals_mean_product_of_anomalies(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    g = climate.events_grid(events).toPandas()
    keys = ["time", "level", "latitude"]
    a = g.copy()
    for c in "UVTW":
        a[c] = g[c] - g.groupby(keys)[c].transform("mean")
    a["uv"] = a.U * a.V
    want = a.groupby(keys).uv.mean().reset_index()
    want["time"] = want.time.dt.floor("D")
    want = want.groupby(keys).uv.mean()
    got = climate.eddy_fluxes_daily(climate.events_grid(events), fixed=True).toPandas().set_index(keys).uv
    assert got.sort_index().to_numpy() == pytest.approx(want.sort_index().to_numpy(), abs=1e-6)


def test_read_grid_prunes_folders(spark, tmpdir_path):
    from sparklab import sinks, sources

    g = climate.ship_grid(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")).withColumn("year", F.year("time"))
    sinks.write_grid(g, tmpdir_path + "/g", {"latitude": 1, "longitude": 2}, sort_by="time", partition_dim="year")
    p = plan(sources.read_grid(spark, tmpdir_path + "/g", variables=["value"], time=("1996-01-01", "1997-12-31"), dims=["latitude", "longitude"]))
    assert "PartitionFilters: []" not in p and "year" in p.split("PartitionFilters")[1][:120]


def test_checkpoint_folder_is_required_off_local(spark, monkeypatch):
    from sparklab import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
