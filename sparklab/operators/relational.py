"""Relational operators: first/extreme rows, shares and counts, joins of
several shapes, alignment, ordering, de-duplication, splitting, column
reshaping.

Aggregates are written so Spark can combine them map-side (``min_by``,
``sum``, ``count``), which keeps a hot key to one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

col = F.col

# sums over every column of both sides of the big join
BIG_JOIN_SQL = """with k as (select *, cast(round(l_extendedprice * 100) as bigint) as key from lineitem)
select count(*) as rows, cast(sum(a.key) as bigint) as sum_key, """ + ", ".join(
    [f"cast(sum({t}.{c}) as bigint) as sum_{p}{c}" for t, p in (("a", ""), ("b", "r_"))
     for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    + [f"cast(sum(cast(round({t}.{c} * 100) as bigint)) as bigint) as sum_{p}{c}" for t, p in (("a", ""), ("b", "r_"))
       for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    + [f"cast(sum(ascii({t}.{c})) as bigint) as sum_{p}{c}" for t, p in (("a", ""), ("b", "r_")) for c in ("l_returnflag", "l_linestatus")]
    + [f"cast(sum(date_diff('day', date '1990-01-01', cast({t}.l_shipdate as date))) as bigint) as sum_{p}l_shipdate"
       for t, p in (("a", ""), ("b", "r_"))]) + " from k a join k b on a.key = b.key"


# ---------------------------------------------------------------- first rows
def first_per_group(df: DataFrame, keys, order, cols=None) -> DataFrame:
    """Row values of the first row per group under a total ``order``.

    The ``row_number() = 1`` filter gets a map-side WindowGroupLimit: each task
    sends one row per key, so a hot key costs one row per task. String keys
    are grouped by their SHA-256 digest, so whole texts are not sort keys.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    cols = [c for c in (cols or df.columns) if c not in keys]
    strings = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    by = {f"_k{n}": F.unhex(F.sha2(col(k).cast("binary"), 256)) if k in strings else col(k) for n, k in enumerate(keys)}
    w = Window.partitionBy(*by).orderBy(*order)
    d = df.withColumns(by).withColumn("_rn", F.row_number().over(w))
    return d.filter(col("_rn") == 1).select(*keys, *cols)


def filter_first(df: DataFrame, column: str, order) -> DataFrame:
    """Rows whose ``column`` equals its value on the first row by ``order``."""
    order = [order] if isinstance(order, str) else list(order)
    first = df.agg(F.min_by(col(column), F.struct(*[col(c) for c in order]))).scalar()  # scalar subquery
    return df.filter(col(column) == first)


def series_extremes(df: DataFrame, key: str, value: str) -> DataFrame:
    """Arg-min, arg-max and first key with a non-zero value (A18); ties go to
    the smallest key."""
    return df.agg(
        F.min_by(col(key), F.struct(col(value), col(key))).alias("argmin_key"),
        F.min_by(col(key), F.struct(-col(value), col(key))).alias("argmax_key"),
        F.min(F.when(col(value) != 0, col(key))).alias("first_nonzero_key"),
    )


# ---------------------------------------------------------- shares / counts
def bool_share(df: DataFrame, flag, by=None, name: str = "share") -> DataFrame:
    """Mean of a boolean, overall or per group (A10)."""
    f = (F.col(flag) if isinstance(flag, str) else flag).cast("int")
    agg = (F.sum(f).cast("double") / F.count(f)).alias(name)
    if by is None:
        return df.agg(agg)
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(agg)


def value_counts(df: DataFrame, by, value: str, name: str = "n") -> DataFrame:
    """Count of each value per group."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias(name))


def mean_by(df: DataFrame, key, value: str, scale: int | None = None, name: str | None = None) -> DataFrame:
    """Mean of ``value`` per key (X5); with ``scale`` the sum is exact decimal."""
    v = col(value) if scale is None else col(value).cast(f"decimal(18,{scale})")
    key = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*key).agg((F.sum(v).cast("double") / F.count(v)).alias(name or f"mean_{value}"))


def map_values(df: DataFrame, column: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Replace values by a mapping; unmapped values are kept (K3)."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col(column) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col(column) == F.lit(k), F.lit(v)))
    expr = col(column) if expr is None else expr.otherwise(col(column))
    return df.withColumn(out or column, expr)


def tip_analysis(df: DataFrame, license_col: str, tips_col: str, companies: dict) -> DataFrame:
    """Company from the licence, tipped = tips > 0; per company the rides,
    tipped rides and share, next to the overall share."""
    d = map_values(df, license_col, companies, out="company").withColumn("tipped", col(tips_col) > 0)
    per = d.groupBy("company").agg(
        F.count(F.lit(1)).alias("rides"),
        F.sum(col("tipped").cast("int")).cast("bigint").alias("tipped_rides"),
    ).withColumn("tipped_share", col("tipped_rides").cast("double") / col("rides"))
    return per.withColumn("overall_share", bool_share(d, "tipped").scalar())  # scalar subquery


# ------------------------------------------------------------------- joins
def join_size(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Rows, columns and size (rows x columns) of an inner equi-join.

    Exact without forming the pairs: both sides are counted per key first
    (partial aggregation), the counts are joined, and sum(cl * cr) is the
    number of joined rows. A key holding a third of all rows costs one row.
    """
    on = [on] if isinstance(on, str) else list(on)
    n_cols = len(left.columns) + len(right.columns) - len(on)
    lc = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_cl"))
    rc = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_cr"))
    wide = "decimal(19,0)"  # counts multiply past 2**63
    rows = lc.join(rc, on).agg(F.coalesce(F.sum(col("_cl").cast(wide) * col("_cr").cast(wide)), F.lit(0)).cast("decimal(38,0)").alias("rows"))
    return rows.select("rows", F.lit(n_cols).alias("cols"), (col("rows") * F.lit(n_cols).cast("decimal(10,0)")).cast("decimal(38,0)").alias("size"))


def join_big(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Big-big equi-join that returns the joined rows with all columns of both
    sides (J6); columns of ``right`` that clash are prefixed ``r_``. Both sides
    are shuffled on the key and AQE splits skewed partitions."""
    on = [on] if isinstance(on, str) else list(on)
    taken = set(left.columns)
    r = right.select(*on, *[col(c).alias("r_" + c if c in taken else c) for c in right.columns if c not in on])
    return left.join(r, on, how)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Big-small equi-join (J7). No hint: AQE broadcasts ``small`` when its
    measured bytes are below ``spark.sql.autoBroadcastJoinThreshold`` and
    joins by shuffle otherwise."""
    return big.join(small, on, how)


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all shared column names (J9); float keys compare exactly."""
    common = [c for c in a.columns if c in set(b.columns)]
    if not common:
        raise ValueError("no shared columns")
    return a.join(b, common, how)


def mean_row_sum(df: DataFrame, x: str, y: str, name: str = "mean_xy", fixed: bool = False) -> DataFrame:
    """avg(x + y); NULL when either is NULL (X6). ``fixed``: a sum that doesn't depend on the order of rows."""
    from sparklab.operators.grid import fixed_sum

    v = col(x) + col(y)
    return df.agg((fixed_sum(v) / F.count(v) if fixed else F.avg(v)).alias(name))


def align_subtract(a: DataFrame, b: DataFrame, on, cols, scale: int | None = None) -> DataFrame:
    """Per-column mean of ``b - a`` after aligning on the index ``on``.

    Alignment is a full outer join, but an index present on one side only
    yields NULL, which ``avg`` skips; so the means equal those over the inner
    join, which is what is planned. Disjoint indexes give all-NULL means.
    """
    on = [on] if isinstance(on, str) else list(on)
    la = a.select(*on, *[col(c).alias(f"_a_{c}") for c in cols])
    rb = b.select(*on, *[col(c).alias(f"_b_{c}") for c in cols])
    j = la.join(rb, on, "inner")

    def diff(c):
        d = col(f"_b_{c}") - col(f"_a_{c}")
        if scale is not None:
            d = col(f"_b_{c}").cast(f"decimal(18,{scale})") - col(f"_a_{c}").cast(f"decimal(18,{scale})")
            return (F.sum(d).cast("double") / F.count(d)).alias(c)
        return F.avg(d).alias(c)

    return j.agg(*[diff(c) for c in cols])


# --------------------------------------------------------------- ordering
def range_sort(df: DataFrame, column, n: int | None = None, persist: bool = False) -> DataFrame:
    """Global sort into ``n`` range partitions (O3, ``set_index``): sampled
    range boundaries, one shuffle, then a local sort per partition. A hash of
    the whole row breaks ties, so equal keys spread over partitions. With
    ``persist`` the input is kept (memory, spilling to disk) so the sampling
    pass and the shuffle read it once (O8); ``unpersist`` it when done."""
    from pyspark import StorageLevel

    cols = [column] if isinstance(column, str) else list(column)
    parts = n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df
    tie = F.xxhash64(*[col(f"`{c}`") for c in df.columns])
    return src.repartitionByRange(parts, *cols, tie).sortWithinPartitions(*cols, tie)


def top_n_per_group(df: DataFrame, keys, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows per group under ``order`` (W1, W2). The row_number
    filter is planned with a map-side WindowGroupLimit, so at most ``n`` rows
    per group and task cross the shuffle."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(col("_rn") <= n).drop("_rn")


def number_rows(df: DataFrame, order, name: str = "row_id", start: int = 1, partitions: int | None = None) -> DataFrame:
    """Consecutive numbers ``start, start+1, ...`` in ``order`` without
    moving the rows to one partition: a range-partitioned sort, the position
    inside each partition from ``monotonically_increasing_id`` (partition id
    in the upper bits, position in the lower 33), and each partition's offset
    from the row counts per partition, joined on the partition id. The sorted
    rows are checkpointed once so both see the same partitions. ``order``
    should be a total order for repeatable numbers."""
    order = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    from sparklab.session import cut_lineage

    # materialised once (reliable checkpoint in spark.checkpoint.dir): the
    # counts and the numbering must see the same partitions, and range bounds
    # from sampling are not guaranteed equal across two executions
    ordered = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumns(
        {"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))
    # one row per partition, whatever the data; their running sum is the offset
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offsets = counts.select("_pid", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    pos = col("_mid") - F.shiftleft(col("_pid").cast("long"), 33)
    return ordered.join(offsets, "_pid").withColumn(name, col("_off") + pos + F.lit(start)).drop("_pid", "_mid", "_off")


def _null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    r = right.select(*[col(k).alias("_r_" + k) for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r["_r_" + k])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*["_r_" + k for k in keys])


def rank_within_groups(df: DataFrame, keys, order, name: str = "_pos", partitions: int | None = None) -> DataFrame:
    """0-based position of every row inside its group under ``order`` (a
    ``row_number() - 1``) without holding any group in one task.

    Rows are range-partitioned on (keys, order), so a hot group spans many
    partitions; inside a partition a group's rows are contiguous and their
    position comes from ``monotonically_increasing_id``. Offsets come from the
    row counts per (group, partition) - one row per partition a group
    touches - with a running sum per group. The sorted rows are checkpointed
    once so counts and positions see the same partitions.
    """
    from sparklab.session import cut_lineage

    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sort_cols = keys + order
    ordered = cut_lineage(df.repartitionByRange(n, *sort_cols).sortWithinPartitions(*sort_cols).withColumns(
        {"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()}))
    counts = ordered.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_mid").alias("_first"))
    w = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_pid", "_first", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    j = _null_safe_join(ordered, offsets, keys + ["_pid"])
    return j.withColumn(name, col("_off") + col("_mid") - col("_first")).drop("_pid", "_mid", "_first", "_off")


#: rows of a group that one task sorts (with spilling); larger groups are narrowed to a bracket first
SORT_ROWS = 1 << 24
#: relative rank error of the bracket's ends is one in so many
SKETCH = 10_000


def _at_ranks(r: DataFrame, by, first, last, q: float, name: str) -> DataFrame:
    """Interpolated quantile from rows (by, _v, _n) that stand for ranks first..last (from 0) of their group."""
    p = (col("_n") - 1).cast("double") * F.lit(float(q))
    r = r.withColumns({"_p": p, "_first": first, "_last": last}).withColumns({"_lo": F.floor("_p"), "_hi": F.ceil("_p")})
    at = lambda k: (col(k) >= col("_first")) & (col(k) <= col("_last"))
    g = r.groupBy(*by).agg(F.max("_p").alias("_p"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
                           F.max(F.when(at("_lo"), col("_v"))).alias("_vl"), F.max(F.when(at("_hi"), col("_v"))).alias("_vh"))
    lost = F.raise_error(F.lit("exact_quantile: rank not found")).cast("double")
    val = (F.when(col("_vl").isNull() | col("_vh").isNull(), lost)
           .when((col("_hi") == col("_lo")) | (col("_vl") == col("_vh")), col("_vl")).otherwise(
        (col("_hi") - col("_p")) * col("_vl") + (col("_p") - col("_lo")) * col("_vh")))
    return g.select(*by, val.alias(name))


def exact_quantile(df: DataFrame, keys, value: str, q: float = 0.5, name: str | None = None, bound: int = SORT_ROWS,
                   accuracy: int = SKETCH) -> DataFrame:
    """Exact, interpolated quantile of ``value`` per group (``percentile`` /
    ``quantile_cont``); lazy, nothing is run or written while it is built.

    Groups of up to ``bound`` rows are ranked by a window. A larger group is
    never sorted: a mergeable sketch (``percentile_approx``) gives two values
    between which the rank must lie - its rank error is at most 1/accuracy,
    the bracket is twice as wide on each side -, rows below them are only
    counted, equal values inside become one counted row on the map side, and
    just those are ranked. A rank outside the bracket would raise, as would
    any other that is not found. At most one key per ``bound`` rows is
    broadcast to tell the two kinds of groups apart.

    Position (n - 1) * q; between ranks lo and hi the value is
    (hi - pos) * v_lo + (pos - lo) * v_hi. NULLs don't count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    name = name or f"q_{value}"
    by = keys or ["_all"]
    d = df.filter(col(value).isNotNull()).select(*keys, col(value).cast("double").alias("_v"), *([] if keys else [F.lit(0).alias("_all")]))
    large = F.broadcast(d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(col("_n") > bound))
    # groups that a task can sort
    w = Window.partitionBy(*by)
    few = _null_safe_join(d, large.drop("_n"), by, "left_anti")
    few = few.withColumns({"_r": F.row_number().over(w.orderBy("_v")) - 1, "_n": F.count(F.lit(1)).over(w)})
    few = _at_ranks(few, by, col("_r"), col("_r"), q, name)
    # large groups: bracket, count, rank what is inside
    hot = _null_safe_join(d, large, by)
    wide = 2 / accuracy + 2 / max(bound, 1)  # and both neighbours of a position between two ranks
    ends = F.percentile_approx("_v", [max(0.0, q - wide), min(1.0, q + wide)], accuracy)
    bracket = F.broadcast(hot.groupBy(*by).agg(ends.alias("_e")))
    inside = _null_safe_join(hot, bracket, by).where(col("_v") <= F.get("_e", F.lit(1)))
    below = float("-inf")  # rows below the bracket count as one value
    inside = inside.groupBy(*by, "_n", F.when(col("_v") < F.get("_e", F.lit(0)), below).otherwise(col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    inside = inside.withColumn("_end", F.sum("_c").over(w.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    many = _at_ranks(inside, by, col("_end") - col("_c"), col("_end") - 1, q, name)
    out = few.unionByName(many)
    return out if keys else out.drop("_all")


def dedup(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row per key under ``order`` (O5), globally (not per
    input partition), like :func:`first_per_group`."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return first_per_group(df, keys, order).select(*df.columns)


def repartition_to_size(df: DataFrame, target_bytes: int) -> DataFrame:
    """Re-balance into partitions of about ``target_bytes`` (O6): the number
    follows from the optimizer's size estimate of ``df``; no session setting
    is changed."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(1, -(-size // int(target_bytes))))


def hash_bucket(key_cols, seed: int = 0, buckets: int = 10000, portable: bool = False) -> Column:
    """Hash bucket in [0, buckets) of the key columns and a seed.

    Default: ``xxhash64`` (JVM-side, no strings; the same in every Spark run).
    ``portable=True``: the first 8 hex digits of md5(key || '-' || seed) as an
    integer, which other engines can compute too (used to check results
    against DuckDB)."""
    if not portable:
        return F.pmod(F.xxhash64(*[F.col(c) for c in key_cols], F.lit(seed)), F.lit(buckets))
    parts = []
    for i, c in enumerate(key_cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.col(c).cast("string"))
    text = F.concat(*parts, F.lit(f"-{seed}"))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def hash_split(df: DataFrame, key, weights, seed: int = 0, portable: bool = False) -> list[DataFrame]:
    """Seeded split by weights (O9). A row's side depends only on its key, so
    the split is stable when a task is re-run (unlike ``randomSplit``)."""
    keys = [key] if isinstance(key, str) else list(key)
    total = float(sum(weights))
    b = hash_bucket(keys, seed, portable=portable)
    out, lo = [], 0.0
    for i, w in enumerate(weights):
        hi = lo + w / total
        lo_b, hi_b = int(round(lo * 10000)), int(round(hi * 10000))
        cond = (b >= lo_b) & (b < hi_b) if i < len(weights) - 1 else (b >= lo_b)
        out.append(df.filter(cond))
        lo = hi
    return out


def split_label(df: DataFrame, key, weights, seed: int = 0, name: str = "split", portable: bool = False) -> DataFrame:
    """The split index of each row as a column (same rule as :func:`hash_split`)."""
    keys = [key] if isinstance(key, str) else list(key)
    total = float(sum(weights))
    b = hash_bucket(keys, seed, portable=portable)
    expr, lo = None, 0.0
    for i, w in enumerate(weights[:-1]):
        lo += w / total
        cond = b < int(round(lo * 10000))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    last = F.lit(len(weights) - 1)
    return df.withColumn(name, last if expr is None else expr.otherwise(last))


# --------------------------------------------------------- filters/quantile
def remove_outliers(df: DataFrame, column: str, lower: float = 0.0, q: float = 0.75, factor: float = 1.5,
                    exact: bool = False, accuracy: int = 100000) -> DataFrame:
    """Keep ``lower <= x <= Q3 + factor * (Q3 - lower)``.

    The quantile is one global value joined back as a one-row scalar.
    ``exact=True`` selects it by rank (:func:`exact_quantile`, a distributed
    sort; no task holds the column); the default is the bounded-memory
    ``percentile_approx`` sketch.
    """
    if exact:
        qv = exact_quantile(df, [], column, q, name="_q").scalar()
    else:
        qv = df.agg(F.percentile_approx(col(column), q, accuracy).cast("double")).scalar()
    upper = qv + F.lit(factor) * (qv - F.lit(lower))  # scalar subquery, evaluated once
    return df.filter((col(column) >= F.lit(lower)) & (col(column) <= upper))


# ------------------------------------------------------------ column shape
def select_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """Columns from label ``first`` to ``last`` inclusive, in frame order (K4)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return df.select(*cols[i:j + 1])


def cast_all(df: DataFrame, types: dict, safe: bool = False) -> DataFrame:
    """Cast columns by name (K6); ``safe`` uses try_cast for dirty data."""
    return df.withColumns({c: (col(c).try_cast(t) if safe else col(c).cast(t)) for c, t in types.items()})


def relax_schema(df: DataFrame) -> DataFrame:
    """Decimal -> double, date -> timestamp (K9, V2); one projection."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t == "decimal":
            out.append(col(f.name).cast("double").alias(f.name))
        elif t == "date":
            out.append(col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            out.append(col(f.name))
    return df.select(*out)


def clean_wide(df: DataFrame, rename: dict | None = None, replace: dict | None = None, fill: dict | None = None,
               cast: dict | None = None, keep: tuple | None = None) -> DataFrame:
    """Rename, replace string values, fill nulls, cast and slice a label range
    in a single projection (C1, K3-K6)."""
    rename, replace, fill, cast = rename or {}, replace or {}, fill or {}, cast or {}
    exprs = []
    for f in df.schema.fields:
        name = rename.get(f.name, f.name)
        e = col(f.name)
        if replace and f.dataType.typeName() == "string":
            for k, v in replace.items():
                e = F.when(e == F.lit(k), F.lit(v)).otherwise(e)
        if name in fill:
            e = F.coalesce(e, F.lit(fill[name]))
        if name in cast:
            e = e.cast(cast[name])
        exprs.append(e.alias(name))
    out = df.select(*exprs)
    if keep:
        out = select_range(out, *keep)
    return out


# ============================================================ registration
def register(reg) -> None:
    from sparklab.tables import Tables

    def ev(s, d):
        return Tables.of(s, d).events

    def li(s, d):
        return Tables.of(s, d).raw("lineitem")

    reg.add("first_per_group",
            lambda s, d: first_per_group(ev(s, d), "event_type", ["ts", "event_id"], ["ts", "event_id", "user_id", "value"]),
            """select event_type, ts, event_id, user_id, value from (
                 select *, row_number() over (partition by event_type order by ts, event_id) as rn from events) where rn = 1""")
    reg.add("filter_first",
            lambda s, d: filter_first(Tables.of(s, d).documents, "text", "doc_id").select("doc_id", "source", "n_chars"),
            """select doc_id, source, n_chars from documents
               where text = (select text from documents order by doc_id limit 1)""")
    reg.add("series_extremes",
            lambda s, d: series_extremes(
                ev(s, d).groupBy(F.date_trunc("day", "ts").alias("day")).agg(
                    F.sum(F.when(col("event_type") == "purchase", 1).otherwise(0)).cast("bigint").alias("purchases")),
                "day", "purchases"),
            """with s as (select date_trunc('day', ts) as day,
                   cast(sum(case when event_type = 'purchase' then 1 else 0 end) as bigint) as purchases
                 from events group by 1)
               select (select day from s order by purchases, day limit 1) as argmin_key,
                      (select day from s order by purchases desc, day limit 1) as argmax_key,
                      (select min(day) from s where purchases <> 0) as first_nonzero_key""")
    reg.add("bool_share",
            lambda s, d: bool_share(ev(s, d), col("value") > 100, by="event_type", name="tipped_share"),
            """select event_type, cast(sum(cast(value > 100 as integer)) as double) / count(*) as tipped_share
               from events group by event_type""")
    reg.add("value_counts",
            lambda s, d: value_counts(ev(s, d).withColumn("tipped", col("value") > 100), "event_type", "tipped"),
            "select event_type, value > 100 as tipped, count(*) as n from events group by 1, 2")
    reg.add("mean_by",
            lambda s, d: mean_by(ev(s, d).withColumn("hour", F.hour("ts")), "hour", "value", scale=2),
            """select cast(hour(ts) as integer) as hour, cast(sum(cast(value as decimal(18,2))) as double) / count(value) as mean_value
               from events group by 1""")
    reg.add("tip_analysis",
            lambda s, d: tip_analysis(ev(s, d), "event_type", "value",
                                      {"click": "Juno", "view": "Uber", "purchase": "Via", "signup": "Lyft"}),
            """with e as (select case event_type when 'click' then 'Juno' when 'view' then 'Uber'
                   when 'purchase' then 'Via' when 'signup' then 'Lyft' else event_type end as company,
                   value > 0 as tipped from events)
               select company, count(*) as rides, cast(sum(cast(tipped as integer)) as bigint) as tipped_rides,
                      cast(sum(cast(tipped as integer)) as double) / count(*) as tipped_share,
                      (select cast(sum(cast(tipped as integer)) as double) / count(*) from e) as overall_share
               from e group by company""")

    def price_key(df, c):
        return df.withColumn("key", F.round(col(c) * 100).cast("bigint"))

    reg.add("join_size",
            lambda s, d: join_size(price_key(li(s, d), "l_extendedprice"), price_key(li(s, d), "l_extendedprice"), "key").select(
                *[col(c).cast("bigint").alias(c) for c in ("rows", "cols", "size")]),
            """with k as (select cast(round(l_extendedprice * 100) as bigint) as key from lineitem)
               select cast(count(*) as bigint) as rows, cast(23 as bigint) as cols, cast(count(*) * 23 as bigint) as size
               from k a join k b on a.key = b.key""")

    def big_join(s, d):
        a = price_key(li(s, d), "l_extendedprice")
        j = join_big(a, a, "key")
        whole = [c for c, t in j.dtypes if t in ("bigint", "int")]
        cents = [c for c, t in j.dtypes if t == "double"]
        text = [c for c, t in j.dtypes if t == "string"]
        time = [c for c, t in j.dtypes if t.startswith("timestamp")]
        return j.agg(
            F.count(F.lit(1)).alias("rows"), *[F.sum(c).cast("bigint").alias(f"sum_{c}") for c in whole],
            *[F.sum(F.rint(col(c) * 100).cast("bigint")).alias(f"sum_{c}") for c in cents],
            *[F.sum(F.ascii(c).cast("bigint")).alias(f"sum_{c}") for c in text],
            *[F.sum(F.datediff(col(c), F.lit("1990-01-01").cast("date")).cast("bigint")).alias(f"sum_{c}") for c in time])

    reg.add("join_big", big_join, BIG_JOIN_SQL)

    def small_join(s, d):
        t = Tables.of(s, d)
        j = join_small(price_key(t.raw("lineitem"), "l_extendedprice"),
                       price_key(t.raw("part"), "p_retailprice"), "key")
        return j.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(j.columns)).alias("cols"))

    reg.add("join_small", small_join,
            """select count(*) as rows, 18 as cols from lineitem l join part p
               on cast(round(l.l_extendedprice * 100) as bigint) = cast(round(p.p_retailprice * 100) as bigint)""")

    from sparklab.operators.grid import fixed_sum_sql

    def nat(s, d):
        e = ev(s, d)
        a = e.select("event_id", "user_id", col("value").alias("x"), (col("user_id") / 4.0).alias("y"))
        b = e.select("event_id", "user_id", (col("value") * 2).alias("z"))
        before = mean_row_sum(a, "x", "y", name="mean_before", fixed=True)
        return mean_row_sum(natural_join(a, b), "x", "y", name="mean_after", fixed=True).select(before.scalar().alias("mean_before"), "mean_after")

    reg.add("natural_join", nat,
            f"""with a as (select event_id, user_id, value as x, user_id / 4.0 as y from events)
               select (select {fixed_sum_sql('x + y')} / count(x + y) from a) as mean_before, {fixed_sum_sql('x + y')} / count(x + y) as mean_after from a
               natural join (select event_id, user_id, value * 2 as z from events) b""")

    def align(lo_a, hi_a, lo_b, hi_b):
        def run(s, d):
            e = ev(s, d)
            a = e.filter((col("ts") >= F.lit(lo_a).cast("timestamp_ntz")) & (col("ts") < F.lit(hi_a).cast("timestamp_ntz")))
            b = e.filter((col("ts") >= F.lit(lo_b).cast("timestamp_ntz")) & (col("ts") < F.lit(hi_b).cast("timestamp_ntz")))
            return align_subtract(a, b, "ts", ["value", "user_id"], scale=2)
        sql = f"""select cast(sum(cast(b.value as decimal(18,2)) - cast(a.value as decimal(18,2))) as double)
                     / count(b.value - a.value) as value,
                   cast(sum(cast(b.user_id as decimal(18,2)) - cast(a.user_id as decimal(18,2))) as double)
                     / count(b.user_id - a.user_id) as user_id
              from (select * from events where ts >= timestamp '{lo_a}' and ts < timestamp '{hi_a}') a
              full outer join (select * from events where ts >= timestamp '{lo_b}' and ts < timestamp '{hi_b}') b
              on a.ts = b.ts"""
        return run, sql

    run, sql = align("2024-01-01", "2024-01-20", "2024-01-10", "2024-02-01")
    reg.add("align_overlap", run, sql)
    run, sql = align("2024-01-01", "2024-01-10", "2024-01-15", "2024-02-01")
    reg.add("align_disjoint", run, sql)

    reg.add("range_sort",
            lambda s, d: range_sort(price_key(li(s, d), "l_extendedprice"), "key").select(
                "key", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
            """select cast(round(l_extendedprice * 100) as bigint) as key, l_orderkey, l_linenumber, l_partkey, l_suppkey
               from lineitem""")
    reg.add("top_n_per_group",
            lambda s, d: top_n_per_group(ev(s, d), "user_id", [col("value").desc(), col("event_id")], 3).select(
                "user_id", "event_id", "value"),
            """select user_id, event_id, value from (select *, row_number() over
                 (partition by user_id order by value desc, event_id) as rn from events) where rn <= 3""")
    reg.add("dedup_documents",
            lambda s, d: dedup(Tables.of(s, d).documents, "text", "doc_id").select("doc_id", "lang", "source", "n_chars"),
            """select doc_id, lang, source, n_chars from (select *, row_number() over
                 (partition by text order by doc_id) as rn from documents) where rn = 1""")
    reg.add("repartition_to_size",
            lambda s, d: repartition_to_size(ev(s, d), 64 << 20).select("event_id", "user_id", "event_type"),
            "select event_id, user_id, event_type from events")
    reg.add("hash_split",
            lambda s, d: split_label(ev(s, d), "event_id", [0.8, 0.2], seed=42, portable=True).groupBy("split").agg(
                F.count(F.lit(1)).alias("n")),
            """select case when (cast(('0x' || substr(md5(cast(event_id as varchar) || '-42'), 1, 8)) as bigint) % 10000)
                    < 8000 then 0 else 1 end as split, count(*) as n from events group by 1""")
    reg.add("remove_outliers",
            lambda s, d: remove_outliers(ev(s, d), "value", exact=True).select("event_id", "value"),
            """select event_id, value from events
               where value >= 0 and value <= (select quantile_cont(value, 0.75) * 2.5 from events)""")
    reg.add("clean_wide",
            lambda s, d: clean_wide(
                li(s, d), rename={"l_orderkey": "orderkey"}, replace={"N": "NN"},
                fill={"l_tax": 0.0}, cast={"l_quantity": "int"}, keep=("l_partkey", "l_returnflag")),
            """select l_partkey, l_suppkey, l_linenumber, cast(l_quantity as integer) as l_quantity, l_extendedprice,
                 l_discount, coalesce(l_tax, 0.0) as l_tax,
                 case when l_returnflag = 'N' then 'NN' else l_returnflag end as l_returnflag from lineitem""")
    reg.add("relax_schema",
            lambda s, d: relax_schema(li(s, d).select(
                "l_orderkey", col("l_extendedprice").cast("decimal(12,2)").alias("price"),
                F.to_date("l_shipdate").alias("ship"))),
            """select l_orderkey, cast(cast(l_extendedprice as decimal(12,2)) as double) as price,
                 cast(cast(l_shipdate as date) as timestamp) as ship from lineitem""")
    register_more(reg)


# ------------------------------------------------------------- area filter
def _edges(rings):
    out = []
    for ring in rings:
        pts = [tuple(map(float, p)) for p in ring]
        if pts[0] != pts[-1]:
            pts.append(pts[0])
        out.extend((x1, y1, x2, y2) for (x1, y1), (x2, y2) in zip(pts[:-1], pts[1:]) if y1 != y2)
    return out


def point_in_polygon(lon: Column, lat: Column, rings) -> Column:
    """Even-odd rule over all rings (outer rings and holes alike), as one
    higher-order ``aggregate`` over the polygon's edges (an array literal
    whose size is the polygon's, independent of the data)."""
    edges = F.array(*[F.struct(F.lit(x1).alias("x1"), F.lit(y1).alias("y1"), F.lit(x2).alias("x2"), F.lit(y2).alias("y2"))
                      for x1, y1, x2, y2 in _edges(rings)])

    def step(acc, e):
        crosses = ((e["y1"] > lat) != (e["y2"] > lat)) & (
            lon < (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])
        return acc + F.when(crosses, 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), step) % 2 == 1


def filter_area(items: DataFrame, rings, lon: str = "lon", lat: str = "lat", time: str | None = None,
                period: tuple | None = None) -> DataFrame:
    """Items inside an area of interest and a period (P10). A bounding-box
    and period predicate comes first (pushed into the scan), then the exact
    point-in-polygon test on the survivors."""
    from sparklab.functions.dates import ts_lit

    xs = [float(p[0]) for r in rings for p in r]
    ys = [float(p[1]) for r in rings for p in r]
    cond = col(lon).between(min(xs), max(xs)) & col(lat).between(min(ys), max(ys))
    if period is not None:
        cond = cond & col(time).between(ts_lit(period[0]), ts_lit(period[1]))
    return items.filter(cond).filter(point_in_polygon(col(lon), col(lat), rings))


def point_in_polygon_sql(lon: str, lat: str, rings) -> str:
    def d(v):
        return f"cast('{v!r}' as double)"
    terms = [f"(case when (({d(y1)} > {lat}) <> ({d(y2)} > {lat})) and {lon} < ({d(x2)} - {d(x1)}) * ({lat} - {d(y1)}) "
             f"/ ({d(y2)} - {d(y1)}) + {d(x1)} then 1 else 0 end)" for x1, y1, x2, y2 in _edges(rings)]
    return "((" + " + ".join(terms) + ") % 2 = 1)"


# ------------------------------------------------------ library comparison
def compare_libraries(df: DataFrame, reference: str, on, library: str = "library", value: str = "duration",
                      scale: int | None = 2) -> DataFrame:
    """Mean ``value`` per (library, keys), and for every other library its
    ratio to the reference library on the same keys minus one (J12, R4): a
    full outer join, so keys the reference lacks (or a library lacks) stay,
    with NULL ratios. Rows: ``(library, keys..., value, relative_diff)``."""
    on = [on] if isinstance(on, str) else list(on)
    v = col(value) if scale is None else col(value).cast(f"decimal(18,{scale})")
    means = df.groupBy(library, *on).agg((F.sum(v).cast("double") / F.count(v)).alias(value))
    ref = means.filter(col(library) == reference).select(*on, col(value).alias("_ref"))
    others = means.filter(col(library) != reference).withColumnRenamed(library, "_lib")
    # like an outer merge per library: every key of the reference appears for
    # every other library. Their names are a handful of values, expanded from
    # an array that a scalar subquery fills.
    libs = others.agg(F.collect_set("_lib")).scalar()
    lacking = ref.select("*", F.explode(libs).alias("_lib")).join(others.select("_lib", *on), ["_lib", *on], "left_anti")
    merged = others.join(ref, on, "left").unionByName(lacking.withColumn(value, F.lit(None).cast("double")))
    out = merged.select(col("_lib").alias(library), *on, col(value),
                        (F.try_divide(col(value), col("_ref")) - 1).alias("relative_diff"))
    base = means.filter(col(library) == reference).withColumn("relative_diff", F.lit(None).cast("double"))
    return base.unionByName(out)


def register_more(reg) -> None:
    from sparklab.operators.runs import RUNS_CTE, derive_runs
    from sparklab.plans.tpch_sql import with_duckdb_ctes
    from sparklab.tables import Tables

    aoi = [[(5.9, 47.3), (10.5, 47.5), (13.8, 48.8), (14.9, 51.0), (14.2, 53.9), (8.6, 54.9), (6.0, 53.5),
            (5.9, 50.8), (5.9, 47.3)]]

    def items(s, d):
        o = Tables.of(s, d).orders
        return o.select("o_orderkey", col("o_orderdate").alias("time"),
                        ((col("o_custkey") % 200) / 10.0).alias("lon"), (40 + (col("o_orderkey") % 200) / 10.0).alias("lat"))

    reg.add("filter_area", lambda s, d: filter_area(items(s, d), aoi, time="time", period=("1996-01-01", "1998-12-31")),
            f"""select * from (select o_orderkey, o_orderdate as time, cast(o_custkey % 200 as double) / 10.0 as lon,
                   40 + cast(o_orderkey % 200 as double) / 10.0 as lat from orders)
                where lon between 5.9 and 14.9 and lat between 47.3 and 54.9
                  and time between timestamp '1996-01-01' and timestamp '1998-12-31'
                  and {point_in_polygon_sql('lon', 'lat', aoi)}""")
    reg.add("compare_libraries",
            lambda s, d: compare_libraries(
                # gaps on both sides: two libraries run one query under a number of their own
                derive_runs(Tables.of(s, d).events).filter(col("call_outcome") == "passed").withColumn(
                    "query", F.when((col("library") == "dataframe") & (col("query") == 3), 103)
                    .when((col("library") == "duckdb") & (col("query") == 2), 102).otherwise(col("query"))),
                "dataframe", "query"),
            with_duckdb_ctes("""
with g as (select library, duration, case when library = 'dataframe' and query = 3 then 103
             when library = 'duckdb' and query = 2 then 102 else query end as query from runs where call_outcome = 'passed'),
m as (select library, query, cast(sum(cast(duration as decimal(18,2))) as double) / count(duration) as duration from g group by 1, 2),
ref as (select query, duration as ref from m where library = 'dataframe'),
libs as (select distinct library from m where library <> 'dataframe')
select library, query, duration, cast(null as double) as relative_diff from m where library = 'dataframe'
union all
select l.library, coalesce(o.query, r.query) as query, o.duration, o.duration / r.ref - 1 as relative_diff
from libs l join (select * from m where library <> 'dataframe') o on o.library = l.library
full outer join ref r on o.query = r.query and l.library = o.library
where l.library is not null
union all
select l.library, r.query, cast(null as double), cast(null as double) from ref r cross join libs l
where not exists (select 1 from m o where o.library = l.library and o.query = r.query)""", {"runs": RUNS_CTE}))
