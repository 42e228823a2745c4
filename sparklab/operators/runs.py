"""Run-history analytics (R1-R9): regression detection, bootstrap A/B
confidence, labels, relative durations, summaries, latest runs, axis bounds,
retention/merging and rule-based fixes, on a ``test_run``-shaped table.

Nothing is gathered per test into driver memory or into one array: per-test
statistics are conditional aggregates over ranked rows, and bootstrap draws
are a seeded, portable hash, made and summed in the task that has the runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklab.functions.dates import ts_lit
from sparklab.operators.relational import exact_quantile, top_n_per_group
from sparklab.operators.userfn import Fold, fold_groups

col = F.col
GIB = 1024 ** 3
METRICS = ("duration", "average_memory", "peak_memory")


def derive_runs(events: DataFrame) -> DataFrame:
    """A ``test_run``-shaped table from ``events`` (FIXTURES.md §5)."""
    u = col("user_id")
    lib = F.when(u % 4 == 0, "dataframe").when(u % 4 == 1, "duckdb").when(u % 4 == 2, "polars").otherwise("pyspark")
    return events.select(
        col("event_id").alias("id"),
        F.expr("event_id div 10").alias("session_id"),
        F.concat(col("event_type"), F.lit("["), (u % 5).cast("string"), F.lit("]")).alias("name"),
        col("event_type").alias("originalname"),
        F.concat(F.lit("suite/test_"), col("event_type"), F.lit(".py")).alias("path"),
        F.concat(F.lit("py"), (u % 2).cast("string")).alias("runtime"),
        F.concat(F.lit("3."), (10 + u % 3).cast("string"), F.lit("."), (u % 7).cast("string")).alias("python_version"),
        F.when(u % 6 == 0, "AB_baseline").when(u % 6 == 1, "AB_candidate")
         .otherwise(F.concat(F.lit("0."), (u % 4).cast("string"), F.lit(".0"))).alias("runtime_version"),
        F.lit("linux").alias("platform"),
        col("ts").alias("start"),
        (col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), col("value").cast("decimal(18,6)"))).alias("end"),
        col("value").alias("duration"),
        (col("value") * 4000000.0).alias("average_memory"),
        (col("value") * 10000000.0).alias("peak_memory"),
        F.when(col("event_id") % 17 == 0, "failed").otherwise("passed").alias("call_outcome"),
        lib.alias("library"),
        (col("event_id") % 22 + 1).cast("int").alias("query"),
    )


RUNS_CTE = """runs as (select event_id as id, event_id // 10 as session_id,
    event_type || '[' || cast(user_id % 5 as varchar) || ']' as name, event_type as originalname,
    'suite/test_' || event_type || '.py' as path, 'py' || cast(user_id % 2 as varchar) as runtime,
    '3.' || cast(10 + user_id % 3 as varchar) || '.' || cast(user_id % 7 as varchar) as python_version,
    case when user_id % 6 = 0 then 'AB_baseline' when user_id % 6 = 1 then 'AB_candidate'
         else '0.' || cast(user_id % 4 as varchar) || '.0' end as runtime_version,
    'linux' as platform, ts as start, ts + to_microseconds(cast(round(value * 1000000) as bigint)) as "end",
    value as duration, value * 4000000.0 as average_memory, value * 10000000.0 as peak_memory,
    case when event_id % 17 = 0 then 'failed' else 'passed' end as call_outcome,
    case user_id % 4 when 0 then 'dataframe' when 1 then 'duckdb' when 2 then 'polars' else 'pyspark' end as library,
    cast(event_id % 22 + 1 as integer) as query from events)"""


def load_runs(runs: DataFrame, platform: str | None = "linux", outcomes=("passed",), since: str | None = None) -> DataFrame:
    """Run-history read with predicate (S13); filters reach the scan."""
    if platform is not None:
        runs = runs.filter(col("platform") == platform)
    if outcomes is not None:
        runs = runs.filter(col("call_outcome").isin(list(outcomes)))
    if since is not None:
        runs = runs.filter(col("start") >= ts_lit(since))
    return runs


# ------------------------------------------------------------------ R3
def label_runs(runs: DataFrame) -> DataFrame:
    """Derived labels (R3): runtime label, category, source and full names."""
    crv, pyv, path = col("runtime_version"), col("python_version"), col("path")
    major_minor = F.concat_ws(".", F.split_part(pyv, F.lit("."), F.lit(1)), F.split_part(pyv, F.lit("."), F.lit(2)))
    return runs.withColumns({
        "runtime_label": F.when(crv.startswith("AB_"), F.substring(crv, 4, 1 << 20))
                          .otherwise(F.concat(F.lit("Python "), major_minor)),
        "category": F.split_part(path, F.lit("/"), F.lit(1)),
        "sourcename": F.concat(path, F.lit("::"), col("originalname")),
        "fullname": F.concat(path, F.lit("::"), col("name")),
        "fullname_no_category": F.concat(
            F.when(F.instr(path, "/") > 0, F.expr("substr(path, instr(path, '/') + 1)")).otherwise(F.lit("")),
            F.lit("::"), col("name")),
        "name_short": F.coalesce(F.nullif(F.regexp_extract(col("name"), r"\w+\[(.+)\]", 1), F.lit("")), col("name")),
    })


# ------------------------------------------------------------------ R1
def detect_regressions(runs: DataFrame, now: str, n_last: int = 3, n_std: float = 3.0,
                       idle_days: int = 7, keys=("runtime", "name")) -> DataFrame:
    """Flag (test, metric) whose last ``n_last`` values are all at or above
    mean + max(n_std * std, 1 unit) of the 10 runs before them.

    Runs are ranked newest first by (start, id). Only the newest 10+n rows per
    test are kept by a row_number filter (planned with a map-side group
    limit); counts and the latest start come from a partial aggregate.
    """
    keys = list(keys)
    passed = load_runs(runs).select(*keys, "path", "start", "id", *[col(m).cast("double").alias(m) for m in METRICS])
    # the order (start, id) is the same for all metrics: rank once, then unpivot
    # the 10 + n rows that are left of each test
    totals = passed.groupBy(*keys).agg(
        *[F.count(m).alias(f"_nn_{m}") for m in METRICS], F.max("start").alias("_latest"),
        F.min(F.split_part(col("path"), F.lit("/"), F.lit(1))).alias("category"))
    w = Window.partitionBy(*keys).orderBy(col("start").desc(), col("id").desc())
    recent = passed.withColumn("_rn", F.row_number().over(w)).filter(col("_rn") <= 10 + n_last)
    long = recent.select(*keys, "_rn", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), col(m).alias("v")) for m in METRICS])).alias("_m"))
    base = F.when(col("_rn") > n_last, col("_m.v"))
    last = F.when(col("_rn") <= n_last, col("_m.v"))
    stats = long.groupBy(*keys, col("_m.metric").alias("metric")).agg(
        F.avg(base).alias("mean"), F.stddev_samp(base).alias("_std"),
        F.min(last).alias("_last_min"), F.count(last).alias("_last_n"),
        *[F.max(F.when(col("_rn") == i + 1, col("_m.v"))).alias(f"_last{i}") for i in range(max(n_last, 3))],
    )
    nonnull = None
    for m in METRICS:
        hit = col("metric") == m
        nonnull = F.when(hit, col(f"_nn_{m}")) if nonnull is None else nonnull.when(hit, col(f"_nn_{m}"))
    unit = F.when(col("metric") == "duration", F.lit(1.0)).otherwise(F.lit(float(GIB)))
    norm = F.when(col("metric") == "duration", F.lit(1.0)).otherwise(F.lit(1.0 / GIB))
    threshold = col("mean") + F.greatest(F.lit(n_std) * col("_std"), unit)
    out = (
        stats.join(totals, keys)
        .filter((nonnull > 10 + n_last) & (col("_latest") >= ts_lit(now) - F.expr(f"INTERVAL {idle_days} DAYS")))
        .withColumn("threshold", threshold)
        .filter((col("_last_n") == n_last) & (col("_last_min") >= col("threshold")))
    )
    return out.select(
        *keys, "category", col("metric").alias("type"),
        F.round(col("mean") * norm, 6).alias("mean"),
        *[F.round(col(f"_last{i}") * norm, 6).alias("last" if i == 0 else f"last_{i}") for i in range(3)],
        F.round(col("threshold") * norm, 6).alias("threshold"),
    )


# ------------------------------------------------------------------ R2
#: replicates that a task draws for a test, and draws that it holds at a time
SHARE, HELD = 1000, 1 << 15


def md5_heads(sources: list[bytes], reps: range):
    """First 32 bits of md5(source || replicate): (sources, reps). Sources of one length, replicates of as many digits.

    Texts of one block (55 bytes) go through the steps of RFC 1321 all at once, longer ones through hashlib; the last
    three steps don't touch the word that is read."""
    import hashlib
    import math

    import numpy as np

    numbers = [b"%d" % r for r in reps]
    at, end = len(sources[0]), len(sources[0]) + len(numbers[0])
    if end > 55:
        return np.array([[int.from_bytes(hashlib.md5(s + n).digest()[:4], "big") for n in numbers] for s in sources], np.uint32)
    own, rep = np.zeros((len(sources), 64), np.uint8), np.zeros((len(numbers), 64), np.uint8)
    own[:, :at] = np.frombuffer(b"".join(sources), np.uint8).reshape(len(sources), at)
    rep[:, at:end] = np.frombuffer(b"".join(numbers), np.uint8).reshape(len(numbers), end - at)
    rep[:, end], rep[:, 56], rep[:, 57] = 0x80, end * 8 % 256, end * 8 // 256
    own, rep = own.view("<u4"), rep.view("<u4")
    words = [own[:, g:g + 1] if not rep[:, g].any() else rep[None, :, g] if not own[:, g].any() else own[:, g:g + 1] | rep[None, :, g] for g in range(16)]
    begin = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
    shifts = [x for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for x in four * 4]
    a, b, c, d = (np.full((len(sources), len(numbers)), x, np.uint32) for x in begin)
    f, t = np.empty_like(a), np.empty_like(a)
    for i in range(61):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += words[(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16] + np.uint32(int(abs(math.sin(i + 1)) * WORD))
        np.left_shift(f, np.uint32(shifts[i]), out=t)
        f >>= np.uint32(32 - shifts[i])
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    b += np.uint32(begin[0])
    return b.byteswap()


def xxhash_int(x, h):
    """Spark's ``xxhash64`` of 32-bit integers after columns whose hash is ``h`` (uint64)."""
    import numpy as np

    p1, p2, p3, _, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    h = (h + p5 + np.uint64(4)) ^ (np.asarray(x, np.int64).astype(np.uint64) & np.uint64(WORD - 1)) * p1
    h = (h << np.uint64(23) | h >> np.uint64(41)) * p2 + p3
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


def _drawn_sums(values, sources, reps: range, seed: int, portable: bool):
    """Sum of the values that each replicate draws from a group: one per source, see :func:`ab_confidence`."""
    import numpy as np

    sums, n = np.zeros(len(reps), values.dtype), len(values)
    if portable:  # replicates with as many digits lie together
        parts = [range(max(reps.start, 10 ** k if k else 0), min(reps.stop, 10 ** (k + 1))) for k in range(len(str(reps.stop)))]
    else:
        parts = [reps]
    for i in range(0, len(sources), 1 << 12):
        some = sources.slice(i, 1 << 12)
        if portable:
            lengths: dict[int, list] = {}
            for s in some.to_pylist():
                if s is None:  # no hash: position 0
                    sums += values[0]
                else:
                    lengths.setdefault(len(s.encode()), []).append(s.encode())
            lots = list(lengths.values())
        else:
            lots = [some.to_numpy(zero_copy_only=False).view(np.uint64)]
        for part in filter(len, parts):
            step = max(1, HELD // len(part))
            for lot in lots:
                for j in range(0, len(lot), step):
                    if portable:
                        at = md5_heads(lot[j:j + step], part) % np.uint32(n)
                    else:
                        at = xxhash_int(seed, xxhash_int(part, lot[j:j + step, None])).view(np.int64) % n
                    sums[part.start - reps.start:part.stop - reps.start] += values[at].sum(axis=0)
    return sums


def ab_confidence(runs: DataFrame, metric: str, a: str, b: str, reps: int = 10000, seed: int = 0,
                  by=("fullname",), runtime_col: str = "runtime", scale: int | None = 2,
                  portable: bool = False) -> DataFrame:
    """Bootstrap P(B/A - 1 < x) for x in -80%..0 and P(B/A - 1 > x) for x in
    0..80% (5 % steps) per test, runtimes ``a`` and ``b`` (R2).

    Replicate r of a group with n runs draws, for each of its runs j, the run
    at position hash(id_j, r, seed) mod n: ``xxhash64`` by default, or with
    ``portable=True`` the first 8 hex digits of md5(id_j || '-' || r) (which
    other engines can reproduce; the seed is then not used).

    A run is sent once per ``SHARE`` replicates; the draws are made and summed
    in the task that has the runs of a test, in order, for these replicates,
    so none is written or shuffled. A task holds some bytes for every run of
    one test, and ``HELD`` draws.
    """
    from pyspark.sql import types as T

    from sparklab.operators.userfn import _arrow, _Out, _runs

    if not -(1 << 31) <= seed < 1 << 31:
        raise ValueError("the seed has 32 bits")
    by = list(by)
    d = runs.filter(col(runtime_col).isin(a, b) & col(metric).isNotNull())
    # exact: integer units of 10^-scale summed as bigint
    value = col(metric).cast("double") if scale is None else F.round(col(metric) * (10 ** scale)).cast("bigint")
    keys = [*by, "_first"]
    d = d.select(*by, (col(runtime_col) == b).cast("int").alias("_side"), "start", "id", value.alias("_v"),
                 F.explode(F.sequence(F.lit(0), F.lit(reps - 1), F.lit(SHARE))).alias("_first"))
    source = F.concat(col("id").cast("string"), F.lit("-")) if portable else F.xxhash64("id")
    spark = runs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    # a number of partitions: AQE would put this little data into few tasks
    d = d.repartition(parts, *keys).sortWithinPartitions(*keys, "_side", "start", "id", "_v").select(*keys, "_side", "_v", source.alias("_src"))
    full = T.StructType([*[d.schema[k] for k in keys], T.StructField("_n", T.LongType()), T.StructField("_valid", T.LongType()),
                         T.StructField("_hits", T.ArrayType(T.LongType()))])
    arrow = _arrow(full)
    ks = list(range(-16, 1)) + list(range(0, 17))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        out, held, key = _Out(keys, arrow), [], None

        def end():
            t = pa.concat_tables(held)
            first = key["_first"][0].as_py()
            drawn = range(first, min(first + SHARE, reps))
            side, v, src = t["_side"].to_numpy(), t["_v"].to_numpy(), t["_src"].combine_chunks()
            cut = int(np.searchsorted(side, 1))
            sides = (slice(None), slice(None)) if a == b else (slice(0, cut), slice(cut, None))
            if not all(len(side[s]) for s in sides):  # runs of one runtime only
                return
            ma, mb = (_drawn_sums(v[s], src[s], drawn, seed, portable).astype(np.float64) / (1.0 if scale is None else float(10 ** scale)) / len(v[s])
                      for s in sides)
            valid = ma != 0
            diff = mb[valid] / ma[valid] - 1
            hits = [int((diff < k / 20.0).sum() if i < 17 else ((diff > k / 20.0) | np.isnan(diff)).sum()) for i, k in enumerate(ks)]
            out.put(key, {"_n": [len(drawn)], "_valid": [int(valid.sum())], "_hits": pa.array([hits], pa.list_(pa.int64()))})

        for goes_on, t in _runs(batches, keys):
            if not goes_on:
                if key is not None:
                    end()
                    yield from out.ready()
                held, key = [], t.select(keys).slice(0, 1)
            held.append(t.select(["_side", "_v", "_src"]))
        if key is not None:
            end()
        yield from out.ready(0)

    # a replicate whose A is 0 has no ratio: it counts, but for no side; no ratio at all gives NULL
    per = d.mapInArrow(run, full).groupBy(*by).agg(*[
        F.when(F.sum("_valid") > 0, F.sum(col("_hits")[i]).cast("double") / F.sum("_n")).alias(f"_p{i}") for i in range(len(ks))])
    rows = F.explode(F.array(*[
        F.struct(F.lit(k / 20.0).alias("x"),
                 F.lit(("<" if i < 17 else ">") + f"{k * 5}%").alias("xlabel"),
                 col(f"_p{i}").alias("p"),
                 (F.lit(-1.0 if i < 17 else 1.0) * col(f"_p{i}") / 2 + 0.5).alias("color"))
        for i, k in enumerate(ks)]))
    return per.select(*by, rows.alias("_r")).select(*by, "_r.x", "_r.xlabel", "_r.p", "_r.color")


#: Multipliers of the replicate hash; thresholds of a Poisson(1) draw, as shares of 2^32
HASH = (2654435761, 2246822519, 3266489917)
WORD = 1 << 32


def poisson_thresholds() -> list[int]:
    """A 32-bit hash h draws as many as there are thresholds <= h; no draw of 13 or more has a hash of its own."""
    import math

    share, out = 0.0, []
    for k in range(13):
        share += math.exp(-1) / math.factorial(k)
        out.append(round(share * WORD))
    return out


def replicate_weights(ids, reps: int, seed: int = 0):
    """How often each replicate draws each run: (ids, reps), a function of (id, replicate, seed) alone."""
    import numpy as np

    a, b, c = (np.uint64(m) for m in HASH)
    low = np.uint64(WORD - 1)
    x = ((ids.astype(np.uint64) & low) * a & low)[:, None] + (np.arange(reps, dtype=np.uint64) * b & low)[None] + np.uint64(seed * HASH[2] % WORD)
    x &= low
    x ^= x >> np.uint64(15)
    x = x * b & low
    x ^= x >> np.uint64(13)
    x = x * c & low
    x ^= x >> np.uint64(16)
    return np.searchsorted(np.array(poisson_thresholds(), np.uint64), x.ravel(), "right").reshape(x.shape)


class Replicates(Fold):
    """Per side (0, 1) and replicate the weighted sum of the values and the sum of the weights, as integers."""

    def __init__(self, reps: int, seed: int, scale: int):
        self.reps, self.seed, self.scale = reps, seed, scale

    def start(self):
        import numpy as np

        return np.zeros((2, 2, self.reps), np.int64)

    def step(self, state, rows):
        import numpy as np

        side, ids, units = (rows[c].to_numpy() for c in ("_side", "id", "_units"))
        for i in range(0, len(ids), 64):  # 64 x replicates weights at a time
            w = replicate_weights(ids[i:i + 64], self.reps, self.seed)
            for s in (0, 1):
                own = side[i:i + 64] == s
                state[s, 0] += units[i:i + 64][own] @ w[own]
                state[s, 1] += w[own].sum(axis=0, dtype=np.int64)
        return state

    def merge(self, a, b):
        return a + b

    def finish(self, state):
        import numpy as np

        drawn = (state[0, 1] > 0) & (state[1, 1] > 0)
        if not drawn.any():
            return {"x": [], "xlabel": [], "p": [], "color": []}
        a, b = (state[s, 0][drawn] / float(10 ** self.scale) / state[s, 1][drawn] for s in (0, 1))
        diff = b / np.where(a == 0, np.nan, a) - 1
        out = {"x": [], "xlabel": [], "p": [], "color": []}
        for k, less in [(k, True) for k in range(-16, 1)] + [(k, False) for k in range(17)]:
            x = k / 20.0
            p = float((diff < x).sum() if less else (diff > x).sum()) / len(diff)
            for name, v in zip(out, (x, ("<" if less else ">") + f"{k * 5}%", p, (-1.0 if less else 1.0) * p / 2 + 0.5), strict=True):
                out[name].append(v)
        return out


def ab_confidence_onepass(runs: DataFrame, metric: str, a: str, b: str, reps: int = 10000, seed: int = 0, by=("fullname",),
                          runtime_col: str = "runtime", scale: int = 2) -> DataFrame:
    """``ab_confidence`` from one pass over the runs: each replicate weighs each run by a Poisson(1) draw, which is a
    hash of (id, replicate, seed), so there are no draws to write, join or shuffle; tasks add up arrays of ``reps``
    sums per test, and only tests that a partition's end cuts meet again.

    A replicate's size varies around n instead of being n; the shares differ from the other form's by sampling noise
    and, for small n, by that: on tests with 50 runs and more within 0.05. Replicates that draw no run of a side are
    left out, as is a test without runs of both sides. Values have ``scale`` decimals and are summed as integers.
    """
    d = runs.filter(col(runtime_col).isin(a, b) & col(metric).isNotNull())
    d = d.select(*by, F.when(col(runtime_col) == b, 1).otherwise(0).alias("_side"), col("id").cast("long").alias("id"),
                 F.round(col(metric) * 10 ** scale).cast("long").alias("_units"))
    return fold_groups(d, list(by), Replicates(reps, seed, scale), "x double, xlabel string, p double, color double", ["id"])


# ------------------------------------------------------------------ R4, R6
def latest_runs(runs: DataFrame, keys=("library", "query"), n: int = 1) -> DataFrame:
    """Latest ``n`` runs per (library, query)."""
    return top_n_per_group(runs, list(keys), [col("start").desc(), col("id").desc()], n)


def relative_duration(runs: DataFrame, reference: str = "dataframe", metric: str = "duration") -> DataFrame:
    """Duration relative to the reference library's latest run of the same
    query (R4, W6); queries the reference lacks get NULL."""
    last = latest_runs(load_runs(runs)).select("library", "query", metric)
    w = Window.partitionBy("query")
    ref = F.max(F.when(col("library") == reference, col(metric))).over(w)
    return last.withColumn("relative_" + metric, F.try_divide(col(metric), ref))


# ------------------------------------------------------------------ R5, R7
def summarise(runs: DataFrame, by, metric: str = "duration", days: int = 7, scale: int | None = 2) -> DataFrame:
    """count/min/median/mean/max/std of ``metric`` per ``by`` over passed runs
    that ended within ``days`` of the newest end (R5, A21)."""
    by = [by] if isinstance(by, str) else list(by)
    cutoff = runs.agg(F.max("end")).scalar()  # scalar subquery
    recent = runs.filter((col("end") > cutoff - F.expr(f"INTERVAL {days} DAYS")) & (col("call_outcome") == "passed"))
    v = col(metric)
    mean = F.avg(v) if scale is None else F.sum(v.cast(f"decimal(18,{scale})")).cast("double") / F.count(v)
    rest = recent.groupBy(*by).agg(
        F.count(v).alias("count"), F.min(v).alias("min"), mean.alias("mean"), F.max(v).alias("max"),
        F.round(F.stddev_samp(v), 6).alias("std"))
    # by rank selection: no task holds the values of a test
    middle = exact_quantile(recent, by, metric, 0.5, name="median").select(*[col(k).alias(f"_k_{k}") for k in by], "median")
    on = None
    for k in by:
        c = rest[k].eqNullSafe(middle[f"_k_{k}"])
        on = c if on is None else on & c
    return rest.join(middle, on, "left").select(*by, "count", "min", "median", "mean", "max", "std")


def axis_bounds(runs: DataFrame, by, metric: str = "duration", days: int = 30) -> DataFrame:
    """y-range per test: max(mean + 3 std, 1.05 max), min(mean - 3 std, 0.95 min)
    over runs started within ``days`` of the test's newest start (R7)."""
    by = [by] if isinstance(by, str) else list(by)
    newest = runs.groupBy(*by).agg(F.max("start").alias("_newest"))  # partial aggregate, joined back
    recent = runs.join(newest, by).filter(col("start") > col("_newest") - F.expr(f"INTERVAL {days} DAYS"))
    g = recent.groupBy(*by).agg(F.avg(metric).alias("_m"), F.stddev_samp(metric).alias("_s"),
                                F.max(metric).alias("_max"), F.min(metric).alias("_min"))
    return g.select(*by,
                    F.round(F.greatest(col("_m") + 3 * col("_s"), col("_max") * 1.05), 6).alias("y_max"),
                    F.round(F.least(col("_m") - 3 * col("_s"), col("_min") * 0.95), 6).alias("y_min"))


# ------------------------------------------------------------------ R8, R9
def retain(runs: DataFrame, now: str, days: int = 90) -> DataFrame:
    """Keep sessions with at least one run in the last ``days``."""
    fresh = runs.filter(col("start") > ts_lit(now) - F.expr(f"INTERVAL {days} DAYS")).select("session_id")
    return runs.join(fresh, "session_id", "left_semi")


def merge_runs(*dfs: DataFrame, order=("start", "id")) -> DataFrame:
    """Union run tables and give them fresh consecutive ids (R8), in the
    order (source, start, id), numbered by :func:`relational.number_rows`
    without moving the rows to one partition."""
    tagged = None
    for i, df in enumerate(dfs):
        t = df.withColumn("_src", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    from sparklab.operators.relational import number_rows

    cols = [c for c in tagged.columns if c not in ("id", "_src")]
    numbered = number_rows(tagged, ["_src", *order], name="id")
    return numbered.select(col("id").cast("long").alias("id"), *cols)


def apply_rules(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Rule-based fixes (R9): ``{"rename": col, "from": a, "to": b}`` sets equal
    values to b; ``{"prefix": col, "from": p, "to": q}`` rewrites a leading p;
    ``{"delete": "<SQL predicate>"}`` drops matching rows (NULL predicate keeps)."""
    for r in rules:
        if "rename" in r:
            c = r["rename"]
            df = df.withColumn(c, F.when(col(c) == F.lit(r["from"]), F.lit(r["to"])).otherwise(col(c)))
        elif "prefix" in r:
            c, p = r["prefix"], r["from"]
            df = df.withColumn(c, F.when(col(c).startswith(p),
                                         F.concat(F.lit(r["to"]), F.substring(col(c), len(p) + 1, 1 << 30)))
                               .otherwise(col(c)))
        elif "delete" in r:
            df = df.filter(~F.coalesce(F.expr(r["delete"]), F.lit(False)))
        else:
            raise ValueError(f"unknown rule {r}")
    return df


# ============================================================ registration
NOW = "2024-02-03"


def register(reg) -> None:
    from sparklab.plans.tpch_sql import with_duckdb_ctes
    from sparklab.tables import Tables

    def runs(s, d):
        return Tables.of(s, d).memo("runs", lambda t: derive_runs(t.events))

    def add(name, fn, sql):
        reg.add(name, fn, None if sql is None else with_duckdb_ctes(sql, {"runs": RUNS_CTE}))

    add("load_runs", lambda s, d: load_runs(runs(s, d), "linux", ("passed", "failed"), since="2024-01-15").select(
        "id", "name", "start", "call_outcome"), """
select id, name, start, call_outcome from runs
where platform = 'linux' and call_outcome in ('passed', 'failed') and start >= timestamp '2024-01-15'""")
    def regressions_sql(n):
        return f"""
with passed as (select * from runs where platform = 'linux' and call_outcome = 'passed'),
long as (select runtime, name, path, start, id, 'duration' as metric, cast(duration as double) as v from passed
   union all select runtime, name, path, start, id, 'average_memory', cast(average_memory as double) from passed
   union all select runtime, name, path, start, id, 'peak_memory', cast(peak_memory as double) from passed),
ranked as (select *, row_number() over (partition by runtime, name, metric order by start desc, id desc) as rn from long),
totals as (select runtime, name, metric, count(v) as nn, max(start) as latest,
           min(split_part(path, '/', 1)) as category from long group by 1, 2, 3),
stats as (select runtime, name, metric,
    avg(case when rn > {n} and rn <= {n + 10} then v end) as mean,
    stddev_samp(case when rn > {n} and rn <= {n + 10} then v end) as sd,
    min(case when rn <= {n} then v end) as last_min, count(case when rn <= {n} then v end) as last_n,
    max(case when rn = 1 then v end) as l0, max(case when rn = 2 then v end) as l1,
    max(case when rn = 3 then v end) as l2
  from ranked where rn <= {n + 10} group by 1, 2, 3),
j as (select s.*, t.category, t.nn, t.latest,
    s.mean + greatest(3.0 * s.sd, case when s.metric = 'duration' then 1.0 else {float(GIB)} end) as threshold,
    case when s.metric = 'duration' then 1.0 else {1.0 / GIB!r} end as norm
  from stats s join totals t using (runtime, name, metric))
select runtime, name, category, metric as type, round(mean * norm, 6) as mean, round(l0 * norm, 6) as last,
  round(l1 * norm, 6) as last_1, round(l2 * norm, 6) as last_2, round(threshold * norm, 6) as threshold
from j where nn > {n + 10} and latest >= timestamp '{NOW}' - interval 7 days and last_n = {n} and last_min >= threshold"""

    add("regressions", lambda s, d: detect_regressions(runs(s, d), NOW, n_last=1), regressions_sql(1))
    add("regressions_last3", lambda s, d: detect_regressions(runs(s, d), NOW, n_std=0.0), regressions_sql(3).replace("3.0 * s.sd", "0.0 * s.sd"))

    def recent(s, d):
        r = label_runs(runs(s, d))
        cutoff = r.agg(F.max("end")).scalar()
        return r.filter((col("end") > cutoff - F.expr("INTERVAL 7 DAYS")) & (col("call_outcome") == "passed"))

    shares = """
diffs as (select fullname, b / a - 1 as diff from piv where a is not null and b is not null),
xs as (select cast(k as double) / 20.0 as x, '<' || cast(k * 5 as varchar) || '%' as xlabel, 0 as side from range(-16, 1) t(k)
       union all
       select cast(k as double) / 20.0, '>' || cast(k * 5 as varchar) || '%', 1 from range(0, 17) t(k))
select fullname, x, xlabel,
  cast(sum(case when (side = 0 and diff < x) or (side = 1 and diff > x) then 1 else 0 end) as double) / count(*) as p,
  case when side = 0 then -1.0 else 1.0 end
    * (cast(sum(case when (side = 0 and diff < x) or (side = 1 and diff > x) then 1 else 0 end) as double) / count(*)) / 2 + 0.5
    as color
from diffs cross join xs group by fullname, x, xlabel, side"""

    add("ab_confidence", lambda s, d: ab_confidence(recent(s, d), "duration", "py0", "py1", reps=10000, seed=0, portable=True), """
with r as (select *, path || '::' || name as fullname from runs),
recent as (select * from r where "end" > (select max("end") from r) - interval 7 days and call_outcome = 'passed'),
d as (select fullname, runtime, id, start, duration from recent where runtime in ('py0', 'py1') and duration is not null),
numbered as (select *, row_number() over (partition by fullname, runtime order by start, id) - 1 as pos,
             count(*) over (partition by fullname, runtime) as n from d),
draws as (select n1.fullname, n1.runtime, rep.r as rep,
             cast(('0x' || substr(md5(cast(n1.id as varchar) || '-' || cast(rep.r as varchar)), 1, 8)) as bigint) % n1.n as pos
          from numbered n1, range(10000) rep(r)),
means as (select dr.fullname, dr.runtime, dr.rep,
             (cast(sum(cast(round(v.duration * 100) as bigint)) as double) / 100.0) / count(v.duration) as m
          from draws dr join numbered v on dr.fullname = v.fullname and dr.runtime = v.runtime and dr.pos = v.pos
          group by 1, 2, 3),
piv as (select fullname, rep, max(case when runtime = 'py0' then m end) as a,
           max(case when runtime = 'py1' then m end) as b from means group by 1, 2),""" + shares)

    u = lambda m: f"{m}::UBIGINT"
    a, b, c = map(u, HASH)
    word = u(WORD)
    steps = " + ".join(f"(h >= {t})::INT" for t in poisson_thresholds())
    add("ab_confidence_onepass", lambda s, d: ab_confidence_onepass(recent(s, d), "duration", "py0", "py1"), f"""
with r as (select *, path || '::' || name as fullname from runs),
d as (select fullname, runtime, (id::UBIGINT % {word}) * {a} % {word} as i, cast(round(duration * 100) as bigint) as units from r
  where "end" > (select max("end") from r) - interval 7 days and call_outcome = 'passed' and runtime in ('py0', 'py1') and duration is not null),
h0 as (select fullname, runtime, units, rep.r as rep, (i + rep.r::UBIGINT * {b} % {word}) % {word} as h from d, range(10000) rep(r)),
h1 as (select * replace (xor(h, h >> 15) * {b} % {word} as h) from h0),
h2 as (select * replace (xor(h, h >> 13) * {c} % {word} as h) from h1),
h3 as (select * replace (xor(h, h >> 16) as h) from h2),
w as (select fullname, runtime, rep, sum(units * w)::BIGINT as s, sum(w)::BIGINT as n from (select *, {steps} as w from h3) group by 1, 2, 3),
piv as (select fullname, rep, max(case when runtime = 'py0' and n > 0 then s / 100.0::DOUBLE / n end) as a,
           max(case when runtime = 'py1' and n > 0 then s / 100.0::DOUBLE / n end) as b from w group by 1, 2),""" + shares)
    add("label_runs", lambda s, d: label_runs(runs(s, d)).select(
        "id", "runtime_label", "category", "sourcename", "fullname", "fullname_no_category", "name_short"), """
select id,
  case when runtime_version like 'AB\\_%' escape '\\' then substr(runtime_version, 4)
       else 'Python ' || split_part(python_version, '.', 1) || '.' || split_part(python_version, '.', 2) end as runtime_label,
  split_part(path, '/', 1) as category, path || '::' || originalname as sourcename, path || '::' || name as fullname,
  case when strpos(path, '/') > 0 then substr(path, strpos(path, '/') + 1) else '' end || '::' || name as fullname_no_category,
  coalesce(nullif(regexp_extract(name, '\\w+\\[(.+)\\]', 1), ''), name) as name_short
from runs""")
    add("relative_duration", lambda s, d: relative_duration(runs(s, d)), """
with last as (select library, query, duration from (select *, row_number() over
   (partition by library, query order by start desc, id desc) as rn from runs
   where platform = 'linux' and call_outcome = 'passed') where rn = 1)
select library, query, duration, duration / nullif(max(case when library = 'dataframe' then duration end)
  over (partition by query), 0) as relative_duration from last""")
    add("latest_runs", lambda s, d: latest_runs(runs(s, d), n=2).select("library", "query", "id", "start", "duration"), """
select library, query, id, start, duration from (select *, row_number() over
  (partition by library, query order by start desc, id desc) as rn from runs) where rn <= 2""")
    add("summarise", lambda s, d: summarise(label_runs(runs(s, d)), "fullname"), """
with r as (select *, path || '::' || name as fullname from runs),
recent as (select * from r where "end" > (select max("end") from r) - interval 7 days and call_outcome = 'passed')
select fullname, count(duration) as count, min(duration) as min, median(duration) as median,
  cast(sum(cast(duration as decimal(18,2))) as double) / count(duration) as mean, max(duration) as max,
  round(stddev_samp(duration), 6) as std from recent group by fullname""")
    add("axis_bounds", lambda s, d: axis_bounds(runs(s, d), ["runtime", "name"]), """
with r as (select *, max(start) over (partition by runtime, name) as newest from runs),
g as (select runtime, name, avg(duration) as m, stddev_samp(duration) as sd, max(duration) as mx, min(duration) as mn
      from r where start > newest - interval 30 days group by 1, 2)
select runtime, name, round(greatest(m + 3 * sd, mx * 1.05), 6) as y_max, round(least(m - 3 * sd, mn * 0.95), 6) as y_min
from g""")
    add("retain", lambda s, d: retain(runs(s, d), "2024-03-01", days=40).select("id", "session_id"), """
select id, session_id from runs where session_id in
  (select session_id from runs where start > timestamp '2024-03-01' - interval 40 days)""")

    def merged(s, d):
        r = runs(s, d)
        a = r.filter(col("runtime") == "py0").select("id", "name", "start", "duration")
        b = r.filter(col("runtime") == "py1").select("id", "name", "start", "duration")
        return merge_runs(a, b)

    add("merge_runs", merged, """
select row_number() over (order by src, start, id) as id, name, start, duration from (
  select 0 as src, * from (select id, name, start, duration from runs where runtime = 'py0')
  union all select 1 as src, * from (select id, name, start, duration from runs where runtime = 'py1'))""")
    rules = [
        {"rename": "originalname", "from": "click", "to": "tap"},
        {"prefix": "path", "from": "suite/test_v", "to": "workflows/test_v"},
        {"delete": "runtime_version LIKE 'AB_%'"},
    ]
    add("apply_rules", lambda s, d: apply_rules(runs(s, d), rules).select("id", "originalname", "path"), """
select id, case when originalname = 'click' then 'tap' else originalname end as originalname,
  case when starts_with(path, 'suite/test_v') then 'workflows/test_v' || substr(path, 13) else path end as path
from runs where not coalesce(runtime_version like 'AB_%', false)""")
