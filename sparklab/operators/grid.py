"""n-d arrays as grid tables: one row per cell, integer dimension columns and
one or more value columns (D8/D9).

Reductions are ``groupBy`` of the kept dimensions, neighbourhood operators
are shift-joins or an explode of offsets followed by one partial aggregate,
and re-layouts compute block ids by integer division. Only p x p (OLS) and
per-block arrays of a chosen block size are ever materialised as one value.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

col = F.col
FIXED_BITS = 40


def fixed_sum(c, bits: int = FIXED_BITS) -> Column:
    """Order-independent sum: each value is rounded to a multiple of 2**-bits,
    summed exactly as decimal(38,0) and returned as double: values up to about
    1e25 fit. Same result in any engine and any row order (floating sums are not)."""
    c = col(c) if isinstance(c, str) else c
    scale = float(2 ** bits)
    return F.sum(F.round(c.cast("double") * scale).cast("decimal(38,0)")).cast("double") / scale


def fixed_sum_sql(expr: str, bits: int = FIXED_BITS) -> str:
    scale = float(2 ** bits)
    return f"(cast(sum(cast(round(cast({expr} as double) * {scale}) as decimal(38,0))) as double) / {scale})"


def _agg(fn: str, c: str, fixed: bool) -> Column:
    if fn == "sum":
        return fixed_sum(c) if fixed else F.sum(c)
    if fn == "mean":
        return (fixed_sum(c) / F.count(c)) if fixed else F.avg(c)
    return {"max": F.max, "min": F.min, "count": F.count, "std": F.stddev_samp}[fn](c)


# ----------------------------------------------------------------- build
def embedding_grid(embeddings: DataFrame) -> DataFrame:
    """(i = vec_id, j = position, value) from the ``embeddings`` table."""
    return embeddings.select(col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "value")).select(
        "i", col("j").cast("long").alias("j"), col("value").cast("double").alias("value"))


# ------------------------------------------------------------ reductions
def grid_reduce(df: DataFrame, keep, aggs: dict, fixed: bool = False) -> DataFrame:
    """Reduce over every dimension not in ``keep`` (G1): ``{col: fn}`` or
    ``{col: [fn, ...]}`` with fn in sum/mean/max/min/count/std. Output
    columns are ``<fn>_<col>``."""
    keep = [keep] if isinstance(keep, str) else list(keep or [])
    exprs = []
    for c, fns in aggs.items():
        for fn in ([fns] if isinstance(fns, str) else fns):
            exprs.append(_agg(fn, c, fixed).alias(f"{fn}_{c}"))
    return df.groupBy(*keep).agg(*exprs) if keep else df.agg(*exprs)


def residuals(df: DataFrame, axis: str, dims, value: str = "value") -> DataFrame:
    """``a - a.mean(axis)`` as a grid (G1b): one partial aggregate per line, joined
    back on the line's dimensions; AQE splits a long line's partition."""
    others = [d for d in dims if d != axis]
    lines = df.groupBy(*others).agg((fixed_sum(value) / F.count(value)).alias("_mean"))
    return df.join(lines, others).select(*dims, (col(value) - col("_mean")).alias("residual"))


def sum_residuals(df: DataFrame, axis: str, dims, value: str = "value") -> DataFrame:
    """Sum of the residuals (G1b; zero up to rounding), of their sizes and of their squares."""
    r = residuals(df, axis, dims, value)
    return r.agg((F.round(fixed_sum("residual"), 6) + F.lit(0.0)).alias("residual_sum"),
                 fixed_sum(F.abs("residual")).alias("abs_sum"), fixed_sum(col("residual") * col("residual")).alias("square_sum"))


def filtered_mean(df: DataFrame, thresholds, value: str = "value", fixed: bool = False) -> DataFrame:
    """Mean of the values above each threshold (P11), all thresholds in one
    scan; rows ``(threshold, mean, n)``."""
    aggs = []
    for k, t in enumerate(thresholds):
        v = F.when(col(value) > F.lit(t), col(value))
        mean = (fixed_sum(v) / F.count(v)) if fixed else F.avg(v)
        aggs += [mean.alias(f"_m{k}"), F.count(v).alias(f"_n{k}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), col(f"_m{k}").alias("mean"),
                                        col(f"_n{k}").alias("n")) for k, t in enumerate(thresholds)]))
    return wide.select(rows.alias("_r")).select("_r.*")


def grid_slice(df: DataFrame, sel: dict) -> DataFrame:
    """Index a grid (P12): ``{dim: k}`` picks one index (``isel``), ``{dim: (lo, hi)}``
    keeps ``lo <= dim < hi`` (numpy slice). Predicates reach the scan."""
    cond = F.lit(True)
    for d, s in sel.items():
        if isinstance(s, tuple):
            lo, hi = s
            if lo is not None:
                cond = cond & (col(d) >= lo)
            if hi is not None:
                cond = cond & (col(d) < hi)
        else:
            cond = cond & (col(d) == s)
    return df.filter(cond)


def _unary(f):
    """``f`` with one visible argument, as higher-order functions ask for."""
    return lambda x: f(x)


# ------------------------------------------------------- neighbourhoods
def stencil(df: DataFrame, dims, depth: int = 1, fn: str = "mean", value: str = "value",
            boundary: str = "none", shape: dict | None = None, block: int | None = 256) -> DataFrame:
    """Neighbourhood reduction over a (2*depth+1)^d box (G2, ``map_overlap``).

    The box is separable: one pass per axis reduces 2*depth+1 neighbours, so a
    cell is sent d * (2*depth+1) times, not (2*depth+1)^d. With ``block``
    (default) the grid is laid out in blocks of ``block`` cells per dimension:
    every cell goes to all blocks that its box reaches, also when ``depth`` is
    larger than a block, and the passes run inside the blocks, so the only
    shuffle is the one by block. ``block=None`` shuffles once per axis.
    ``boundary="none"`` uses the neighbours that exist; ``"periodic"`` wraps
    indices modulo ``shape``.
    """
    dims = list(dims)
    periodic = boundary == "periodic"

    def wrap(t, d):
        return F.pmod(t, F.lit(shape[d])) if periodic else t

    # sums and counts, or extremes, combine over the axes; a target is a cell
    # of the grid iff a row arrives there over offset 0 in every pass
    d0 = df.select(*dims, col(value).alias("_v"), F.when(col(value).isNotNull(), 1).otherwise(0).cast("long").alias("_n"),
                   F.lit(1).alias("_self"))
    fold = {"mean": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[fn]

    bcols: list[str] = []
    if block is not None:
        for d in dims:
            if periodic:
                block_of = lambda t, n=shape[d]: F.floor(F.pmod(t, F.lit(n)) / block)
                reach = F.array_distinct(F.transform(F.sequence(col(d) - depth, col(d) + depth), _unary(block_of)))
            else:
                reach = F.sequence(F.floor((col(d) - depth) / block), F.floor((col(d) + depth) / block))
            d0 = d0.withColumn("_blk_" + d, F.explode(reach))
        bcols = ["_blk_" + d for d in dims]
        d0 = d0.repartition(*bcols)
    for d in dims:
        sent = d0.withColumn("_o", F.explode(F.sequence(F.lit(-depth), F.lit(depth))))
        sent = sent.withColumn(d, wrap(col(d) + col("_o"), d)).withColumn("_self", F.when(col("_o") == 0, col("_self")).otherwise(0))
        if block is not None:  # only targets that the block owns on this axis
            sent = sent.filter(F.floor(col(d) / block) == col("_blk_" + d))
        d0 = sent.groupBy(*bcols, *dims).agg(fold("_v").alias("_v"), F.sum("_n").alias("_n"), F.max("_self").alias("_self"))
    result = col("_v") / col("_n") if fn == "mean" else col("_v")
    return d0.filter(col("_self") == 1).select(*dims, result.alias(f"{fn}_{value}"))


def double_diff(a: DataFrame, b: DataFrame, dims=("i", "j"), value: str = "value") -> DataFrame:
    """``a[1:, 1:] - b[:-1, :-1]`` (G4) as an equi-join on shifted indices;
    output indices are those of the result array (0-based)."""
    dims = list(dims)
    sa = a.select(*[(col(d) - 1).alias(d) for d in dims], col(value).alias("_a"))
    sb = b.select(*dims, col(value).alias("_b"))
    return sa.join(sb, dims).select(*dims, (col("_a") - col("_b")).alias("diff"))


def wrap_pad(df: DataFrame, dim: str, n: int) -> DataFrame:
    """Pad one element at the end of ``dim`` in "wrap" mode: index ``n`` copies index 0."""
    return df.unionByName(df.filter(col(dim) == 0).withColumn(dim, F.lit(n).cast(df.schema[dim].dataType)))


def vorticity(u: DataFrame, v: DataFrame, dx: DataFrame, dy: DataFrame, n0: int,
              dims=("i", "j", "k")) -> DataFrame:
    """``dx[..., None] * pad(u) - dy[..., None] * pad(v)`` (G4b): u, v are 3-D
    grids padded by one wrapped row on the first axis; dx, dy are 2-D over the
    first two axes and are joined on them."""
    i, j, k = dims
    up = wrap_pad(u, i, n0).withColumnRenamed("value", "_u")
    vp = wrap_pad(v, i, n0).withColumnRenamed("value", "_v")
    d2 = dx.withColumnRenamed("value", "_dx").join(dy.withColumnRenamed("value", "_dy"), [i, j])
    return up.join(vp, [i, j, k]).join(d2, [i, j]).select(
        i, j, k, (col("_dx") * col("_u") - col("_dy") * col("_v")).alias("value"))


# --------------------------------------------------------- linear algebra
def matmul(a: DataFrame, b: DataFrame, value: str = "value", block: int = 1024) -> DataFrame:
    """C = A B for grids a(i, k), b(k, j) (G5), in blocks of the result.

    Cells of A are copied to every column block and cells of B to every row
    block of C, so the join key (k, row block, column block) meets at most
    ``block`` x ``block`` pairs however large n and m are. For the workload's
    reduction (the sum of A A^T) use :func:`gram_sum`, which never forms it."""
    last = lambda df, c: F.coalesce(F.floor(df.agg(F.max(c)).scalar() / block), F.lit(0)).cast("long")
    zero = F.lit(0).cast("long")
    l = a.select("i", col("j").alias("_k"), col(value).alias("_a"), F.floor(col("i") / block).cast("long").alias("_bi"),
                 F.explode(F.sequence(zero, last(b, "j"))).alias("_bj"))
    r = b.select(col("i").alias("_k"), "j", col(value).alias("_b"), F.floor(col("j") / block).cast("long").alias("_bj"),
                 F.explode(F.sequence(zero, last(a, "i"))).alias("_bi"))
    return l.join(r, ["_k", "_bi", "_bj"]).groupBy("i", "j").agg(fixed_sum(col("_a") * col("_b")).alias(value))


def transpose(a: DataFrame) -> DataFrame:
    return a.select(col("j").alias("i"), col("i").alias("j"), *[c for c in a.columns if c not in ("i", "j")])


def gram_sum(a: DataFrame, value: str = "value", fixed: bool = True) -> DataFrame:
    """sum(A @ A.T) without forming the product (G5): it equals
    sum_k (sum_i a_ik)^2, one column-sum aggregate and one scalar aggregate."""
    colsum = a.groupBy("j").agg((fixed_sum(value) if fixed else F.sum(value)).alias("_c"))
    return colsum.agg(F.round(F.sum(col("_c") * col("_c")), 6).alias("gram_sum"))


def ols(df: DataFrame, row: str = "i", feature: str = "j", value: str = "value", y: DataFrame | None = None,
        y_col: str = "y"):
    """Least squares by the normal equations (G5b) on a long design matrix
    ``(row, feature, value)`` and targets ``y(row, y)``.

    Each row's p values are gathered once (bounded by p). A task multiplies
    blocks of rows - outer products of whole blocks, in numpy - and gives one
    p x p sum; these are added up by a partial aggregate, and the p^2 + p
    totals reach the driver in one job, which solves the p x p system (bounded
    by p, not by rows). Fitted values use the p coefficients as a map literal -
    no join, no shuffle. A value that isn't there counts as 0.
    Returns ``(beta_df, fitted_df)``."""
    import numpy as np
    import pyarrow as pa

    yy = y.select(col(row).alias("_r"), col(y_col).cast("double").alias("_y"))
    rows = (df.groupBy(col(row).alias("_r"))
            .agg(F.map_from_entries(F.collect_list(F.struct(col(feature), col(value).cast("double")))).alias("_x"))
            .join(yy, "_r"))
    ftype = df.schema[feature].dataType.simpleString()

    def products(batches):
        names, total = np.array([]), np.zeros((1, 1))  # the last row and column are y's
        for batch in batches:
            if not batch.num_rows:
                continue
            m = batch["x"]
            lengths = np.diff(m.offsets.to_numpy())
            keys, values = m.keys.to_numpy(zero_copy_only=False), m.items.to_numpy(zero_copy_only=False)
            first, last = m.offsets[0].as_py(), m.offsets[-1].as_py()
            keys, values = keys[first:last], np.nan_to_num(values[first:last])
            both = np.union1d(names, keys) if names.size else np.unique(keys)
            grown, at = np.zeros((len(both) + 1, len(both) + 1)), np.append(np.searchsorted(both, names), len(both))
            grown[np.ix_(at, at)] = total
            names, total = both, grown
            for lo in range(0, batch.num_rows, 1024):  # a block of rows at a time
                n = min(1024, batch.num_rows - lo)
                a, z = lengths[:lo].sum(), lengths[:lo + n].sum()
                block = np.zeros((n, len(names) + 1))
                block[np.repeat(np.arange(n), lengths[lo:lo + n]), np.searchsorted(names, keys[a:z])] = values[a:z]
                block[:, -1] = batch["y"].slice(lo, n).to_numpy(zero_copy_only=False)
                total += block.T @ block
        if names.size:
            p = len(names)
            i, j = np.indices((p, p + 1)).reshape(2, -1)
            g = pa.array(names[np.minimum(j, p - 1)], mask=j == p)
            kind = batch.schema.field("x").type.key_type
            yield pa.RecordBatch.from_arrays([pa.array(names[i]).cast(kind), g.cast(kind), pa.array(total[i, j])], ["f", "g", "s"])

    sums = rows.select(col("_x").alias("x"), col("_y").alias("y")).where("y IS NOT NULL").mapInArrow(products, f"f {ftype}, g {ftype}, s double")
    totals = sums.groupBy("f", "g").agg(F.sum("s").alias("s")).collect()  # p^2 + p values
    feats = sorted({r["f"] for r in totals})
    pos = {f: n for n, f in enumerate(feats)}
    p = len(feats)
    A, bvec = np.zeros((p, p)), np.zeros(p)
    for r in totals:
        if r["g"] is None:
            bvec[pos[r["f"]]] = r["s"]
        else:
            A[pos[r["f"]], pos[r["g"]]] = r["s"]
    beta = np.linalg.solve(A, bvec)
    spark = df.sparkSession
    beta_df = spark.createDataFrame([(f, float(b)) for f, b in zip(feats, beta)], f"{feature} {ftype}, beta double")
    coef = F.create_map(*[x for f, b in zip(feats, beta) for x in (F.lit(f).cast(ftype), F.lit(float(b)))])
    fitted = rows.select(col("_r").alias(row), F.aggregate(
        F.map_entries("_x"), F.lit(0.0), lambda acc, e: acc + e["value"] * F.coalesce(F.element_at(coef, e["key"]), F.lit(0.0))
    ).alias("y_hat"))
    return beta_df, fitted


# -------------------------------------------------------------- re-layout
def rechunk(df: DataFrame, dims, blocks: dict, value: str = "value", max_cells: int = 8192) -> DataFrame:
    """Re-layout into blocks (O7): block id per dimension = index div size;
    one shuffle by block id; each block packed as a sorted array of
    (index..., value) structs.

    A size of ``None`` asks for the whole axis. A block never holds more than
    ``max_cells`` cells, so arrays stay the same size as data grow: a whole
    axis longer than that is split into numbered pieces, and the other axes
    are narrowed to what is left of the budget."""
    dims = list(dims)
    left, size = F.lit(max_cells).cast("long"), {}
    for d in sorted(dims, key=lambda d: blocks.get(d) is not None):  # whole axes first
        want = F.lit(blocks[d]).cast("long") if blocks.get(d) is not None else df.agg((F.max(d) + 1).cast("long")).scalar()
        size[d] = F.greatest(F.lit(1).cast("long"), F.least(want, left))
        left = F.greatest(F.lit(1).cast("long"), F.floor(left / size[d]).cast("long"))
    bnames = [f"block_{d}" for d in dims]
    keyed = df.select(*[F.floor(col(d) / size[d]).cast("long").alias(n) for d, n in zip(dims, bnames, strict=True)], *dims, value)
    return (keyed.repartition(*bnames)
            .groupBy(*bnames)
            .agg(F.sort_array(F.collect_list(F.struct(*dims, value))).alias("cells")))


def unpack(blocks_df: DataFrame) -> DataFrame:
    return blocks_df.select(F.explode("cells").alias("_c")).select("_c.*")


# ============================================================ registration
LAYOUTS = {
    # name: block sizes over (i, j) of the embedding grid, None for the whole axis
    "tiles_to_rows": {"i": None, "j": 8},
    "swap_axes": {"i": 16, "j": None},
    "adjacent_groups": {"i": 50, "j": 5},
    "heal_oversplit": {"i": 128, "j": 64},
}


def register(reg) -> None:
    from sparklab.tables import Tables

    def g(s, d):
        return Tables.of(s, d).memo("embedding_grid", lambda t: embedding_grid(t.embeddings))

    E = """eg as (select vec_id as i, cast(generate_subscripts(embedding, 1) - 1 as bigint) as j,
                  cast(unnest(embedding) as double) as value from embeddings)"""

    def sql(body):
        from sparklab.plans.tpch_sql import with_duckdb_ctes
        return with_duckdb_ctes(body, {"eg": E})

    reg.add("grid_reduce", lambda s, d: grid_reduce(g(s, d), "j", {"value": ["sum", "mean", "max", "count"]}, fixed=True),
            sql(f"""select j, {fixed_sum_sql('value')} as sum_value, {fixed_sum_sql('value')} / count(value) as mean_value,
                    max(value) as max_value, count(value) as count_value from eg group by j"""))
    reg.add("grid_total", lambda s, d: grid_reduce(g(s, d), [], {"value": ["sum", "count"]}, fixed=True),
            sql(f"select {fixed_sum_sql('value')} as sum_value, count(value) as count_value from eg"))
    reg.add("sum_residuals", lambda s, d: sum_residuals(g(s, d), "i", ["i", "j"]),
            sql(f"""select round({fixed_sum_sql('r')}, 6) + 0.0 as residual_sum, {fixed_sum_sql('abs(r)')} as abs_sum,
                   {fixed_sum_sql('r * r')} as square_sum
                   from (select eg.value - m.mean as r from eg join
                     (select j, {fixed_sum_sql('value')} / count(value) as mean from eg group by j) m on eg.j = m.j)"""))
    ths = [0.05, 0.1, 0.2, 0.3]
    reg.add("filtered_mean", lambda s, d: filtered_mean(g(s, d), ths, fixed=True),
            sql(" union all ".join(
                f"select cast({t} as double) as threshold, {fixed_sum_sql('case when value > ' + str(t) + ' then value end')} / "
                f"count(case when value > {t} then value end) as mean, count(case when value > {t} then value end) as n from eg"
                for t in ths)))
    reg.add("grid_slice", lambda s, d: grid_slice(g(s, d), {"i": (0, 75), "j": (0, 75)}),
            sql("select i, j, value from eg where i >= 0 and i < 75 and j >= 0 and j < 75"))
    reg.add("grid_isel", lambda s, d: grid_slice(g(s, d), {"i": 20, "j": 40}),
            sql("select i, j, value from eg where i = 20 and j = 40"))
    reg.add("stencil", lambda s, d: stencil(g(s, d), ["i", "j"], 1, "max"),
            sql("""select a.i, a.j, max(b.value) as max_value from eg a join eg b
                   on b.i between a.i - 1 and a.i + 1 and b.j between a.j - 1 and a.j + 1 group by a.i, a.j"""))

    def dd(s, d):
        a = g(s, d)
        b = a.withColumn("value", col("value") * col("value"))
        return double_diff(a, b).agg(fixed_sum("diff").alias("sum_diff"), F.count("diff").alias("n"))

    reg.add("double_diff", dd, sql(f"""select {fixed_sum_sql('a.value - b.value * b.value')} as sum_diff, count(*) as n
                   from eg a join eg b on a.i = b.i + 1 and a.j = b.j + 1"""))

    def vort(s, d):
        e = g(s, d)
        u = e.select((col("j") % 8).alias("i"), (col("j") / 8).cast("long").alias("j"), col("i").alias("k"), "value")
        v = u.withColumn("value", col("value") * 2.0 + 1.0)
        idx = u.select("i", "j").distinct()
        cells = idx.unionByName(idx.filter(col("i") == 0).withColumn("i", F.lit(8).cast("long")))
        dx = cells.withColumn("value", (col("i") + 1).cast("double") / (col("j") + 1).cast("double"))
        dy = cells.withColumn("value", (col("i") - col("j")).cast("double"))
        r = vorticity(u, v, dx, dy, n0=8)
        return r.agg(fixed_sum("value").alias("sum_value"), F.count("value").alias("n"))

    reg.add("vorticity", vort, sql(f"""with u as (select j % 8 as i, j // 8 as j, i as k, value from eg),
        up as (select * from u union all select 8 as i, j, k, value from u where i = 0)
        select {fixed_sum_sql('(cast(i + 1 as double) / cast(j + 1 as double)) * value - cast(i - j as double) * (value * 2.0 + 1.0)')}
               as sum_value, count(*) as n from up"""))
    reg.add("gram_sum", lambda s, d: gram_sum(g(s, d)),
            sql(f"select round(sum(c * c), 6) as gram_sum from (select j, {fixed_sum_sql('value')} as c from eg group by j)"))

    def ols_fit(s, d):
        t = Tables.of(s, d)
        y = t.embeddings.select(col("vec_id").alias("i"), col("label").cast("double").alias("y"))
        _, fitted = ols(g(s, d), y=y)
        # the normal equations hold: X'(y - y_hat) = 0 for every feature
        e = g(s, d).join(y, "i").join(fitted, "i")
        return e.groupBy("j").agg(fixed_sum(col("value") * col("y")).alias("xty"),
                                  (F.round(fixed_sum(col("value") * (col("y") - col("y_hat"))), 4) + F.lit(0.0)).alias("gradient"))

    reg.add("ols", ols_fit, sql(f"""select eg.j, {fixed_sum_sql('eg.value * e.label')} as xty, cast(0.0 as double) as gradient
                   from eg join embeddings e on eg.i = e.vec_id group by eg.j"""))

    def coefficients(s, d):
        e = Tables.of(s, d).events.select(col("event_id").alias("i"), col("value").alias("a"), (col("user_id") % 7).cast("double").alias("b"),
                                          (col("value") * 3 + col("user_id") % 7 * 2 + col("event_id") % 5).alias("y"))
        long = e.select("i", F.explode(F.array(*[F.struct(F.lit(n).alias("j"), col(n).alias("value")) for n in "ab"])).alias("c")).select("i", "c.j", "c.value")
        beta, _ = ols(long, y=e.select("i", "y"))
        return beta.select("j", F.round("beta", 6).alias("beta"))

    reg.add("ols_coefficients", coefficients, """
with e as (select value as a, cast(user_id % 7 as double) as b, value * 3 + user_id % 7 * 2 + event_id % 5 as y from events),
s as (select sum(a * a) as aa, sum(a * b) as ab, sum(b * b) as bb, sum(a * y) as ay, sum(b * y) as yb from e)
select 'a' as j, round((ay * bb - yb * ab) / (aa * bb - ab * ab), 6) as beta from s
union all select 'b', round((yb * aa - ay * ab) / (aa * bb - ab * ab), 6) from s""")

    def relayout(s, d):
        e = g(s, d)
        outs = []
        for name, b in LAYOUTS.items():
            r = rechunk(e, ["i", "j"], b)
            outs.append(r.select(F.lit(name).alias("layout"), F.size("cells").alias("_n"),
                                 F.aggregate("cells", F.lit(0).cast("decimal(38,0)"),
                                             lambda acc, c: acc + F.round(c["value"] * float(2 ** FIXED_BITS)).cast("decimal(38,0)")
                                             ).alias("_s"))
                        .groupBy("layout").agg(F.count(F.lit(1)).alias("n_blocks"), F.sum("_n").cast("bigint").alias("n_cells"),
                                               (F.sum("_s").cast("double") / float(2 ** FIXED_BITS)).alias("total")))
        return reduce(DataFrame.unionByName, outs)

    def sized(b, d, other):
        """Size of axis d in SQL, by the same rule."""
        full = f"(select max({d}) + 1 from eg)"
        if b[d] is None:
            return f"least({full}, 8192)"
        if b[other] is None:
            return f"greatest(1, least({b[d]}, 8192 // least((select max({other}) + 1 from eg), 8192)))"
        return str(b[d])

    reg.add("rechunk", relayout, sql(" union all ".join(
        f"""select '{name}' as layout, count(distinct (i // {sized(b, 'i', 'j')}, j // {sized(b, 'j', 'i')})) as n_blocks,
                   count(*) as n_cells, {fixed_sum_sql('value')} as total from eg""" for name, b in LAYOUTS.items())))
    reg.add("matmul", lambda s, d: matmul(transpose(g(s, d)), g(s, d), block=16),
            sql(f"""select a.j as i, b.j as j, {fixed_sum_sql('a.value * b.value')} as value
                    from eg a join eg b on a.i = b.i group by 1, 2"""))
