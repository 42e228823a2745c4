"""Grid and climate operators: invariants and brute-force checks on small
hand-made grids (numpy as the reference), year wrap and leap days."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from sparklab.operators import climate, grid


def _grid(spark, arr):
    rows = [(int(i), int(j), float(arr[i, j])) for i in range(arr.shape[0]) for j in range(arr.shape[1])]
    return spark.createDataFrame(rows, "i long, j long, value double")


def _to_np(df, shape, col="value"):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r.i, r.j] = r[col]
    return out


def test_matmul_and_gram_sum(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(7, 5))
    ga = _grid(spark, a)
    c = _to_np(grid.matmul(ga, grid.transpose(ga)), (7, 7))
    assert np.allclose(c, a @ a.T)
    assert abs(grid.gram_sum(ga).first().gram_sum - (a @ a.T).sum()) < 1e-5


def test_stencil_matches_numpy(spark):
    a = np.arange(20, dtype=float).reshape(4, 5) ** 1.5
    out = _to_np(grid.stencil(_grid(spark, a), ["i", "j"], 1, "max"), (4, 5), "max_value")
    ref = np.array([[a[max(i - 1, 0):i + 2, max(j - 1, 0):j + 2].max() for j in range(5)] for i in range(4)])
    assert np.allclose(out, ref)
    per = _to_np(grid.stencil(_grid(spark, a), ["i", "j"], 1, "sum", boundary="periodic", shape={"i": 4, "j": 5}),
                 (4, 5), "sum_value")
    ref2 = sum(np.roll(np.roll(a, di, 0), dj, 1) for di in (-1, 0, 1) for dj in (-1, 0, 1))
    assert np.allclose(per, ref2)


def test_double_diff(spark):
    a = np.arange(12, dtype=float).reshape(3, 4)
    b = a ** 2
    out = _to_np(grid.double_diff(_grid(spark, a), _grid(spark, b)), (2, 3), "diff")
    assert np.allclose(out, a[1:, 1:] - b[:-1, :-1])


def test_vorticity_wrap_pad(spark):
    rng = np.random.default_rng(1)
    u, v = rng.normal(size=(3, 2, 2)), rng.normal(size=(3, 2, 2))
    dx, dy = rng.normal(size=(4, 2)), rng.normal(size=(4, 2))

    def g3(x):
        return spark.createDataFrame([(i, j, k, float(x[i, j, k])) for i in range(3) for j in range(2) for k in range(2)],
                                     "i long, j long, k long, value double")

    def g2(x):
        return spark.createDataFrame([(i, j, float(x[i, j])) for i in range(4) for j in range(2)], "i long, j long, value double")

    r = grid.vorticity(g3(u), g3(v), g2(dx), g2(dy), n0=3)
    up = np.pad(u, [(0, 1), (0, 0), (0, 0)], mode="wrap")
    vp = np.pad(v, [(0, 1), (0, 0), (0, 0)], mode="wrap")
    ref = dx[..., None] * up - dy[..., None] * vp
    got = np.zeros_like(ref)
    for row in r.collect():
        got[row.i, row.j, row.k] = row.value
    assert r.count() == ref.size and np.allclose(got, ref)


def test_rechunk_keeps_sum_and_cells(spark):
    a = np.random.default_rng(2).random((30, 20))
    g = _grid(spark, a)
    for blocks in [{"i": 30, "j": 4}, {"i": 7, "j": 20}, {"i": 5, "j": 3}]:
        r = grid.rechunk(g, ["i", "j"], blocks)
        back = grid.unpack(r)
        assert back.count() == 600
        assert abs(back.agg(F.sum("value")).first()[0] - a.sum()) < 1e-9
        n_blocks = int(np.ceil(30 / blocks["i"]) * np.ceil(20 / blocks["j"]))
        assert r.count() == n_blocks


def test_ols_matches_lstsq(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(200, 4))
    y = X @ np.array([1.0, -2.0, 0.5, 3.0]) + rng.normal(scale=0.1, size=200)
    xdf = spark.createDataFrame([(i, j, float(X[i, j])) for i in range(200) for j in range(4)], "i long, j long, value double")
    ydf = spark.createDataFrame([(i, float(y[i])) for i in range(200)], "i long, y double")
    beta, fitted = grid.ols(xdf, y=ydf)
    b = np.array([r.beta for r in beta.orderBy("j").collect()])
    ref = np.linalg.lstsq(X, y, rcond=None)[0]
    assert np.allclose(b, ref, atol=1e-8)
    assert fitted.count() == 200


def test_sum_residuals_is_zero(spark):
    a = np.random.default_rng(4).random((10, 6))
    assert grid.sum_residuals(_grid(spark, a), "i", ["i", "j"]).first().residual_sum == 0.0


def _daily(spark, start, end, hours=(0,), skip=()):
    rows, d = [], start
    while d <= end:
        for h in hours:
            if d not in skip:
                rows.append((dt.datetime(d.year, d.month, d.day, h), 0, 0, float(d.timetuple().tm_yday % 17 + h)))
        d += dt.timedelta(days=1)
    return spark.createDataFrame(rows, "time timestamp_ntz, latitude int, longitude int, value double")


def _brute_climatology(pdf, fill, window=61):
    """Dense numpy version of the reference algorithm for one cell."""
    h = window // 2
    w = np.array([dict(climate.triangle(window)).get(k, 0) for k in range(-h, h + 1)], float)
    out = {}
    pdf = pdf.assign(hour=pdf.time.dt.hour, year=pdf.time.dt.year, doy=pdf.time.dt.dayofyear)
    L = pdf.doy.max()
    years = sorted(pdf.year.unique())
    for hour, g in pdf.groupby("hour"):
        arr = np.full((len(years), L), np.nan)
        for r in g.itertuples():
            arr[years.index(r.year), r.doy - 1] = r.value
        if fill == "day365":
            arr = np.where(np.isnan(arr), arr[:, [364]], arr) if L > 364 else arr
        else:
            prev = np.concatenate([np.full((len(years), 1), np.nan), arr[:, :-1]], axis=1)
            arr = np.where(np.isnan(arr), prev, arr)
        pad = np.pad(arr, [(0, 0), (h, h)], mode="wrap")
        for t in range(L):
            win = pad[:, t:t + window]
            m = ~np.isnan(win)
            den = (w[None, :] * m).sum()
            out[(hour, t + 1)] = (np.nansum(win * w[None, :]) / den) if den > 0 else None
    return out


def test_climatology_leap_and_gaps(spark):
    skip = {dt.date(2021, 3, 3), dt.date(2021, 12, 31), dt.date(2020, 12, 30), dt.date(2022, 1, 1)}
    g = _daily(spark, dt.date(2019, 11, 1), dt.date(2022, 2, 10), hours=(0, 6), skip=skip)
    pdf = g.toPandas()
    for fill in ["day365", "ffill"]:
        got = {(r.hour, r.dayofyear): r.value for r in climate.hourly_climatology(g, fill=fill).collect()}
        ref = _brute_climatology(pdf, fill)
        assert set(got) == set(ref)
        for k, v in ref.items():
            assert (v is None and got[k] is None) or abs(got[k] - v) < 1e-9, (fill, k, got[k], v)


def test_climatology_of_a_series_shorter_than_the_window(spark):
    g = _daily(spark, dt.date(2021, 1, 2), dt.date(2021, 1, 20), skip={dt.date(2021, 1, 9), dt.date(2021, 1, 10)})
    pdf = g.toPandas()
    for fill in ["day365", "ffill"]:
        got = {(r.hour, r.dayofyear): r.value for r in climate.hourly_climatology(g, fill=fill).collect()}
        ref = _brute_climatology(pdf, fill)
        assert set(got) == set(ref) and all(abs(got[k] - v) < 1e-9 for k, v in ref.items())
    # days far from any value have none
    lone = climate.hourly_climatology(_daily(spark, dt.date(2021, 12, 31), dt.date(2021, 12, 31)), fill="ffill")
    assert [r.dayofyear for r in lone.where("value IS NOT NULL").orderBy("dayofyear").collect()] == [*range(1, 30), *range(336, 366)]


def test_climatology_reads_the_grid_once_and_repeats(spark):
    import re

    from sparklab.plans.registry import registry

    runs = []
    for _ in range(3):
        df = registry().queries["climatology_ffill"](spark, "/root/testdata/sf0.001")
        runs.append(sorted(map(tuple, df.collect()), key=repr))
        final = df._jdf.queryExecution().executedPlan().toString().replace("\n", " ")
        done = re.sub(r"== Initial Plan ==.*?(?=ResultQueryStage|$)", "", final)
        assert "ReusedExchange" in done
    assert runs[0] == runs[1] == runs[2]


def test_bilinear_weights_sum_to_one(spark):
    w = climate.bilinear_weights(spark, -82.5, 15.0, 12, 24, -75.0, 30.0, 6, 12)
    sums = [r.s for r in w.groupBy("dst_i", "dst_j").agg(F.sum("w").alias("s")).collect()]
    assert len(sums) == 72 and all(abs(s - 1) < 1e-12 for s in sums)
    fine = climate.bilinear_weights(spark, -82.5, 15.0, 12, 24, -75.0, 30.0, 6, 48)
    wrap = {(r.src_j, round(r.w, 12)) for r in fine.filter((F.col("dst_j") == 47) & (F.col("dst_i") == 0)).collect()}
    assert {j for j, _ in wrap} == {23, 0}  # longitude 352.5 lies between 345 and 0 (periodic)


def test_moisture_harmonisation(spark):
    rows = [(dt.datetime(2022, 1, 24, 10), 0, 0, 3000.0, 1000.0), (dt.datetime(2022, 1, 24, 11), 0, 0, 9.0, 9.0),
            (dt.datetime(2022, 1, 26, 10), 0, 0, 3000.0, 500.0)]
    df = spark.createDataFrame(rows, "time timestamp_ntz, y int, x int, B08 double, B11 double")
    got = climate.moisture_by_month(df, "2022-01-25").first()
    # 24th: first scene, (3000-1000)/(4000); 26th harmonised: (2000-0)/(2000)
    assert abs(got.moisture - (0.5 + 1.0) / 2) < 1e-12


def test_stencil_halo_blocks_match_unblocked(spark):
    a = np.random.default_rng(8).random((11, 9))
    g = _grid(spark, a)
    ref = np.array([[a[max(i - 1, 0):i + 2, max(j - 1, 0):j + 2].mean() for j in range(9)] for i in range(11)])
    for block in (2, 3, 4, None):
        out = _to_np(grid.stencil(g, ["i", "j"], 1, "mean", block=block), (11, 9), "mean_value")
        assert np.allclose(out, ref), block
        per = _to_np(grid.stencil(g, ["i", "j"], 1, "sum", boundary="periodic", shape={"i": 11, "j": 9}, block=block),
                     (11, 9), "sum_value")
        ref2 = sum(np.roll(np.roll(a, di, 0), dj, 1) for di in (-1, 0, 1) for dj in (-1, 0, 1))
        assert np.allclose(per, ref2), block
    plan = grid.stencil(g, ["i", "j"], 1, "max", block=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1
