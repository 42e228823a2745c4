"""User functions over neighbourhoods, blocks and groups."""

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sparklab.operators import userfn
from sparklab.operators.userfn import Drawdown, Fold, apply_groups, fold_groups, map_blocks, map_overlap

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the folds below run on executors

NAMES = "ijk"
MODES = {"periodic": "wrap", "nearest": "edge", "reflect": "symmetric"}


def cells(spark, a, holes=()):
    dims = list(NAMES[:a.ndim])
    rows = [(*map(int, ix), None if np.isnan(v) else float(v)) for ix, v in np.ndenumerate(a) if tuple(ix) not in holes for ix in [ix]]
    return spark.createDataFrame(rows, ", ".join(f"{d} long" for d in dims) + ", value double").repartition(3), dims


def dense(df, shape, dims, name="value"):
    a = np.full(shape, np.nan)
    rows = df.collect()
    for r in rows:
        a[tuple(r[d] for d in dims)] = np.nan if r[name] is None else r[name]
    assert len({tuple(r[d] for d in dims) for r in rows}) == len(rows)
    return a


def box_sum(depth):
    """Sum over a box, NaN as nothing; uneven weights, so that a shifted or flipped array is seen."""
    def run(a):
        p = np.pad(np.nan_to_num(a), depth)
        out = np.zeros_like(a)
        for offset in np.ndindex(*[2 * depth + 1] * a.ndim):
            w = 1 + sum(o * 10 ** k for k, o in enumerate(offset))
            out += w * p[tuple(slice(o, o + n) for o, n in zip(offset, a.shape, strict=True))]
        return out

    return run


@pytest.mark.parametrize("boundary", ["none", "periodic", "nearest", "reflect", 2.5])
@pytest.mark.parametrize("shape,block,depth", [((9,), 4, 1), ((7,), 2, 5), ((8, 11), 3, 2), ((5, 6), 16, 1), ((4, 3, 5), 2, 1)])
def test_overlap_against_numpy(spark, boundary, shape, block, depth):
    a = np.random.default_rng(1).integers(0, 50, shape).astype(float)
    df, dims = cells(spark, a)
    got = dense(map_overlap(df, dims, box_sum(depth), depth, boundary=boundary, block=block), shape, dims)
    if boundary == "none":
        want = box_sum(depth)(a)
    else:
        padded = np.pad(a, depth, **({"constant_values": boundary} if boundary == 2.5 else {"mode": MODES[boundary]}))
        want = box_sum(depth)(padded)[tuple(slice(depth, -depth) for _ in shape)]
    assert np.array_equal(got, want)


def test_overlap_deeper_than_a_periodic_axis(spark):
    a = np.arange(3.0)
    df, dims = cells(spark, a)
    got = dense(map_overlap(df, dims, box_sum(7), 7, boundary="periodic", block=2), (3,), dims)
    assert np.array_equal(got, box_sum(7)(np.pad(a, 7, mode="wrap"))[7:-7])


def test_overlap_holes_nulls_and_region(spark):
    a = np.arange(60.0).reshape(6, 10)
    a[2, 3] = np.nan  # a NULL; the cell stays
    df, dims = cells(spark, a, holes={(0, 0), (5, 9)})
    b = a.copy()
    b[0, 0] = b[5, 9] = np.nan
    want = box_sum(1)(b)
    got = dense(map_overlap(df, dims, box_sum(1), 1, block=4, out="s"), (6, 10), dims, "s")
    there = ~np.isnan(b)
    there[2, 3] = True
    assert np.array_equal(got[there], want[there]) and np.isnan(got[~there]).all()
    part = map_overlap(df, dims, box_sum(1), 1, block=4, region={"i": (1, 3), "j": (2, None)})
    rows = {(r.i, r.j): r.value for r in part.collect()}
    assert rows == {(i, j): want[i, j] for i in (1, 2) for j in range(2, 10)}
    nan = map_overlap(df, dims, lambda x: np.where(x > 20, np.nan, x), 1).where("value IS NULL").count()
    assert nan == sum(v > 20 for v in b.ravel()) + 1


def test_overlap_arrays_are_as_large_as_a_block(spark):
    def bounded(x):
        assert x.shape[0] <= 12 and x.shape[1] <= 12, x.shape
        return x

    for n in (20, 60):
        df = spark.range(n * n).select((F.col("id") % n).alias("i"), F.expr(f"id div {n}").alias("j"), F.col("id").cast("double").alias("value"))
        got = map_overlap(df, ["i", "j"], bounded, 2, block=8)
        assert got.join(df, ["i", "j", "value"]).count() == n * n


def test_overlap_refuses_repeated_cells_and_other_shapes(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0)], "i long, value double")
    with pytest.raises(Exception, match="occurs twice"):
        map_overlap(df, ["i"], lambda x: x).collect()
    one = spark.createDataFrame([(0, 1.0), (1, 2.0)], "i long, value double")
    with pytest.raises(Exception, match="the kernel made"):
        map_overlap(one, ["i"], lambda x: x[:1]).collect()
    with pytest.raises(ValueError, match="boundary"):
        map_overlap(one, ["i"], lambda x: x, boundary="mirror")
    assert map_overlap(one.limit(0), ["i"], lambda x: x).collect() == []


def test_blocks_of_the_declared_shape(spark):
    a = np.random.default_rng(2).random((7, 5))
    df, dims = cells(spark, a, holes={(3, 2)})
    b = a.copy()
    b[3, 2] = np.nan

    def stats(arrays, origin):
        x = arrays["value"]
        return {"total": np.stack([np.nansum(x, 1), np.nanmax(x, 1)], 1)}

    got = map_blocks(df, dims, {"i": 3, "j": None}, stats, "total double", {"i": "same", "what": 2})
    assert got.columns == ["i", "what", "total"]
    assert np.array_equal(dense(got, (7, 2), ["i", "what"], "total"), np.stack([np.nansum(b, 1), np.nanmax(b, 1)], 1))
    # a cut axis that is reduced keeps the number of its block
    got = map_blocks(df, dims, {"i": 3, "j": 2}, lambda x, o: {"n": np.array([o["i"]])}, "n long", {"one": 1})
    assert sorted((r.block_i, r.block_j, r.n) for r in got.collect()) == [(i, j, 3 * i) for i in range(3) for j in range(3)]
    with pytest.raises(Exception, match="is declared"):
        map_blocks(df, dims, {"i": 3, "j": None}, lambda x, o: {"total": x["value"]}, "total double", {"i": "same"}).collect()
    with pytest.raises(Exception, match="are declared"):
        map_blocks(df, dims, {"i": 3, "j": None}, lambda x, o: {"other": x["value"]}, "total double", {"i": "same", "j": "same"}).collect()
    with pytest.raises(ValueError, match="more than"):
        map_blocks(df, dims, {"i": None, "j": None}, stats, "total double", {"i": "same", "what": 2}, max_cells=10)


# ------------------------------------------------------------------ groups
class Text(Fold):
    """Rows in order, joined: wrong whenever a slice is lost, doubled or moved."""

    def start(self):
        return ""

    def step(self, state, rows):
        assert rows.num_rows <= 10_000
        return state + "".join(f"{x}," for x in rows["x"].to_pylist())

    def finish(self, state):
        return {"text": [state]}


class Sliced(Text):
    def merge(self, a, b):
        return a + b


def hot_rows(spark, n=6000):
    """A third of all rows has the key "hot"; NULL and NaN are keys like others."""
    k = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 400).cast("string")))
    f = F.when(F.col("id") % 3 == 0, float("nan")).otherwise(0.5)
    return spark.range(n).select(k.alias("k"), f.alias("f"), F.col("id").alias("x")).repartition(7)


def joined(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r.x):
        key = (r.k, "nan" if r.f != r.f else r.f)
        out[key] = out.get(key, "") + f"{r.x},"
    return out


@pytest.mark.parametrize("fold", [Text(), Sliced()])
@pytest.mark.parametrize("bound", [0, 100, 10_000])
def test_groups_of_any_size_give_the_same(spark, fold, bound):
    df = hot_rows(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "113")  # groups go over many batches
    try:
        got = apply_groups(df, ["k", "f"], lambda t: fold.finish(fold.step("", t)), "text string", "x", bound=bound, fold=fold).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.k, "nan" if r.f != r.f else r.f): r.text for r in got} == joined(df.collect())
    assert len(got) == len(joined(df.collect()))


def test_a_hot_group_is_cut_into_slices(spark):
    from pyspark import TaskContext

    class Where(Fold):
        def start(self):
            return {}

        def step(self, state, rows):
            part = TaskContext.get().partitionId()
            return {**state, part: state.get(part, 0) + rows.num_rows}

        def merge(self, a, b):
            return {k: a.get(k, 0) + b.get(k, 0) for k in {*a, *b}}

        def finish(self, state):
            return {"tasks": [len(state)], "most": [max(state.values())], "n": [sum(state.values())]}

    rows = {r.k: r for r in fold_groups(hot_rows(spark), "k", Where(), "tasks int, most long, n long", "x", partitions=12).collect()}
    assert rows["hot"].n == 2000 and rows["hot"].tasks >= 4 and rows["hot"].most < 1000
    # also when all its rows are equal
    same = spark.range(3000).select(F.lit("a").alias("k"), F.lit(1).alias("x")).repartition(6)
    r = fold_groups(same, "k", Where(), "tasks int, most long, n long", "x", partitions=12).first()
    assert r.n == 3000 and r.tasks >= 6


def test_groups_above_the_bound_need_a_fold(spark):
    with pytest.raises(Exception, match="more than 100 rows"):
        apply_groups(hot_rows(spark), "k", lambda t: {"n": [t.num_rows]}, "n long", bound=100).collect()


def test_results_of_any_shape(spark):
    df = hot_rows(spark, 600)
    top = apply_groups(df, "k", userfn.largest(2, "x"), "x long, of long").collect()
    by = {}
    for r in df.collect():
        by.setdefault(r.k, []).append(r.x)
    assert sorted((r.k or "", r.x, r.of) for r in top) == sorted((k or "", x, len(v)) for k, v in by.items() for x in sorted(v)[-2:])
    frame = apply_groups(df, "k", lambda t: t.to_pandas()[["x"]].describe().loc[["min", "max"]].astype("int64"), "x long")
    assert sorted((r.k or "", r.x) for r in frame.collect()) == sorted((k or "", x) for k, v in by.items() for x in (min(v), max(v)))
    none = apply_groups(df, "k", lambda t: {"x": pa.array([], pa.int64())}, "x long")
    assert none.collect() == []
    assert apply_groups(df.limit(0), "k", lambda t: {"x": [1]}, "x long").collect() == []
    assert fold_groups(df.limit(0), "k", Sliced(), "text string", "x").collect() == []
    with pytest.raises(Exception, match="are declared"):
        apply_groups(df, "k", lambda t: {"y": [1]}, "x long").collect()
    with pytest.raises(ValueError, match="come with the result"):
        apply_groups(df, "k", lambda t: {"k": [1]}, "k string")


def test_results_of_many_groups_are_built_together(spark):
    """What groups make is converted for many at a time, whatever sorts of columns they make; the groups are spread over all cores."""
    keys = pa.schema([("k", pa.string())])
    made = [[1, None], [2.5], np.array([3.0, np.nan]), pa.array([4, 5], pa.int8()), pa.chunked_array([[6], [7]]), [], [float("nan")]]
    out = userfn._Out(["k"], pa.schema([*keys, ("x", pa.float64())]))
    for i, x in enumerate(made):
        out.put(pa.table({"k": [None if i == 1 else f"g{i}"]}, keys), {"x": x}, of=10)
    assert len(out.noted) == 6 and not out.held  # nothing is converted yet; the empty result has no rows
    got = pa.Table.from_batches(out.ready(0))
    assert got.to_pydict() == {"k": ["g0", "g0", None, "g2", "g2", "g3", "g3", "g4", "g4", "g6"], "x": [1.0, None, 2.5, 3.0, None, 4.0, 5.0, 6.0, 7.0, None]}
    assert list(out.ready(0)) == []
    out.put(pa.table({"k": ["big"]}, keys), {"x": [1.0]}, of=userfn.OF_ROWS)  # no batches are kept for a large group's key
    assert not out.noted and out.held
    with pytest.raises(ValueError, match="rows"):
        userfn._Out(["k"], pa.schema([*keys, ("x", pa.int64()), ("y", pa.int64())])).put(None, {"x": [1], "y": [1, 2]})
    df = spark.range(4000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("x"))
    top = apply_groups(df, "k", userfn.largest(2, "x"), "x long, of long")
    assert top.withColumn("p", F.spark_partition_id()).agg(F.count_distinct("p")).first()[0] >= spark.sparkContext.defaultParallelism
    assert top.count() == 2000 and top.agg(F.min("x")).first()[0] == 2000


def test_drawdown_merges_to_the_same(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(0, 1000, 500)
    fold = Drawdown("v")
    whole = fold.step(fold.start(), pa.table({"v": v}))
    state = fold.start()
    for part in np.array_split(v, 13):
        state = fold.merge(state, fold.step(fold.start(), pa.table({"v": part})))
    assert whole == state and whole[2] == max(int(v[:i + 1].max() - v[i]) for i in range(500))
    assert fold.finish(fold.step(fold.start(), pa.table({"v": pa.nulls(3, pa.int64())})))["drawdown"].to_pylist() == [None]
    assert pc.max(pa.array(v)).as_py() == whole[0]
