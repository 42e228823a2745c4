"""h2o group-by benchmark q1-q9 (A1-A8, W1) as operators on a frame with
columns id1..id6, v1..v3.

Every query is one ``groupBy().agg()`` (partial aggregation before the shuffle,
so a hot key costs one partial row per map task) except q8, the top-2 per
group, which is a ``row_number`` filter that Spark turns into a partial
``WindowGroupLimit`` on the map side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklab.functions.exact import money_sum, units
from sparklab.tables import Tables

col = F.col


def _mean(c: str, scale: int | None):
    """Mean; with ``scale`` the values (which have ``scale`` decimals) are
    summed exactly in integer units (see ``functions.exact``)."""
    if scale is None:
        return F.avg(c)
    return money_sum(units(c, scale), scale) / F.count(c)


def _sum(c: str, scale: int | None):
    if scale is None:
        return F.sum(c)
    return money_sum(units(c, scale), scale)


def h2o_q1(df: DataFrame) -> DataFrame:
    return df.groupBy("id1").agg(F.sum("v1").alias("v1"))


def h2o_q2(df: DataFrame) -> DataFrame:
    return df.groupBy("id1", "id2").agg(F.sum("v1").alias("v1"))


def h2o_q3(df: DataFrame, scale: int | None = None) -> DataFrame:
    return df.groupBy("id3").agg(F.sum("v1").alias("v1"), _mean("v3", scale).alias("v3"))


def h2o_q4(df: DataFrame, scale: int | None = None) -> DataFrame:
    return df.groupBy("id4").agg(
        (F.sum("v1") / F.count("v1")).alias("v1"), (F.sum("v2") / F.count("v2")).alias("v2"),
        _mean("v3", scale).alias("v3"))


def h2o_q5(df: DataFrame, scale: int | None = None) -> DataFrame:
    return df.groupBy("id6").agg(F.sum("v1").alias("v1"), F.sum("v2").alias("v2"), _sum("v3", scale).alias("v3"))


def h2o_q6(df: DataFrame, approx: bool = False, digits: int | None = None) -> DataFrame:
    """Median and sample std of v3 per (id4, id5). The exact median is a
    rank selection over a range-partitioned sort (a hot group spans many
    tasks); ``approx=True`` uses the ``percentile_approx`` sketch instead.
    The std is a partial aggregate."""
    from sparklab.operators.relational import _null_safe_join, exact_quantile

    std = F.stddev_samp("v3")
    if digits is not None:
        std = F.round(std, digits)
    if approx:
        return df.groupBy("id4", "id5").agg(F.percentile_approx("v3", 0.5, 10000).alias("median_v3"), std.alias("sd_v3"))
    sd = df.groupBy("id4", "id5").agg(std.alias("sd_v3"))
    med = exact_quantile(df, ["id4", "id5"], "v3", 0.5, name="median_v3")
    return _null_safe_join(sd, med, ["id4", "id5"], "left").select("id4", "id5", "median_v3", "sd_v3")


def h2o_q7(df: DataFrame) -> DataFrame:
    return df.groupBy("id3").agg((F.max("v1") - F.min("v2")).alias("range_v1_v2"))


def h2o_q8(df: DataFrame, n: int = 2) -> DataFrame:
    """Largest ``n`` v3 per id6, nulls dropped."""
    w = Window.partitionBy("id6").orderBy(col("v3").desc())
    return (df.filter(col("v3").isNotNull()).select("id6", "v3")
            .withColumn("_rn", F.row_number().over(w)).filter(col("_rn") <= n).drop("_rn"))


def h2o_q9(df: DataFrame) -> DataFrame:
    """Squared Pearson correlation of v1, v2 per (id2, id4), from count and
    sums (no division by zero under ANSI: zero variance gives NULL)."""
    v1, v2 = col("v1").cast("double"), col("v2").cast("double")
    g = df.filter(col("v1").isNotNull() & col("v2").isNotNull()).groupBy("id2", "id4").agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.sum(v1).alias("_sx"), F.sum(v2).alias("_sy"),
        F.sum(v1 * v1).alias("_sxx"), F.sum(v2 * v2).alias("_syy"), F.sum(v1 * v2).alias("_sxy"))
    cov = col("_n") * col("_sxy") - col("_sx") * col("_sy")
    vx = col("_n") * col("_sxx") - col("_sx") * col("_sx")
    vy = col("_n") * col("_syy") - col("_sy") * col("_sy")
    return g.select("id2", "id4", F.when(vx * vy == 0, F.lit(None)).otherwise((cov * cov) / (vx * vy)).alias("r2"))


def h2o_frame(lineitem: DataFrame) -> DataFrame:
    """h2o-shaped columns derived from lineitem (FIXTURES.md §5)."""
    return lineitem.select(
        col("l_returnflag").alias("id1"), col("l_linestatus").alias("id2"),
        F.concat(F.lit("id"), col("l_partkey").cast("string")).alias("id3"),
        col("l_linenumber").alias("id4"), col("l_suppkey").alias("id5"), col("l_orderkey").alias("id6"),
        (col("l_quantity").cast("int") % 5 + 1).alias("v1"), (col("l_partkey") % 15 + 1).alias("v2"),
        F.when(col("l_orderkey") % 50 == 0, F.lit(None)).otherwise(col("l_extendedprice")).alias("v3"),
    )


H2O_CTE = """h2o as (select l_returnflag as id1, l_linestatus as id2, 'id' || cast(l_partkey as varchar) as id3,
    l_linenumber as id4, l_suppkey as id5, l_orderkey as id6,
    cast(l_quantity as integer) % 5 + 1 as v1, l_partkey % 15 + 1 as v2,
    case when l_orderkey % 50 = 0 then null else l_extendedprice end as v3 from lineitem)"""

_V3SUM = "cast(sum(cast(v3 as decimal(18,2))) as double)"

SQL = {
    "h2o_q1": "select id1, cast(sum(v1) as bigint) as v1 from h2o group by id1",
    "h2o_q2": "select id1, id2, cast(sum(v1) as bigint) as v1 from h2o group by id1, id2",
    "h2o_q3": f"select id3, cast(sum(v1) as bigint) as v1, {_V3SUM} / count(v3) as v3 from h2o group by id3",
    "h2o_q4": f"""select id4, cast(sum(v1) as double) / count(v1) as v1, cast(sum(v2) as double) / count(v2) as v2,
        {_V3SUM} / count(v3) as v3 from h2o group by id4""",
    "h2o_q5": f"select id6, cast(sum(v1) as bigint) as v1, cast(sum(v2) as bigint) as v2, {_V3SUM} as v3 from h2o group by id6",
    "h2o_q6": "select id4, id5, median(v3) as median_v3, round(stddev_samp(v3), 4) as sd_v3 from h2o group by id4, id5",
    "h2o_q7": "select id3, max(v1) - min(v2) as range_v1_v2 from h2o group by id3",
    "h2o_q8": """select id6, v3 from (select id6, v3, row_number() over (partition by id6 order by v3 desc) as rn
        from h2o where v3 is not null) where rn <= 2""",
    "h2o_q9": """select id2, id4, case when vx * vy = 0 then null else (cov * cov) / (vx * vy) end as r2 from (
        select id2, id4, n * sxy - sx * sy as cov, n * sxx - sx * sx as vx, n * syy - sy * sy as vy from (
          select id2, id4, cast(count(*) as double) as n, sum(cast(v1 as double)) as sx, sum(cast(v2 as double)) as sy,
            sum(cast(v1 as double) * cast(v1 as double)) as sxx, sum(cast(v2 as double) * cast(v2 as double)) as syy,
            sum(cast(v1 as double) * cast(v2 as double)) as sxy
          from h2o where v1 is not null and v2 is not null group by id2, id4) s) t""",
}


def register(reg) -> None:
    from sparklab.plans.tpch_sql import with_duckdb_ctes

    def frame(spark, sf_dir):
        return Tables.of(spark, sf_dir).memo("h2o", lambda t: h2o_frame(t.raw("lineitem")))

    runs = {
        "h2o_q1": lambda s, d: h2o_q1(frame(s, d)),
        "h2o_q2": lambda s, d: h2o_q2(frame(s, d)),
        "h2o_q3": lambda s, d: h2o_q3(frame(s, d), scale=2),
        "h2o_q4": lambda s, d: h2o_q4(frame(s, d), scale=2),
        "h2o_q5": lambda s, d: h2o_q5(frame(s, d), scale=2),
        "h2o_q6": lambda s, d: h2o_q6(frame(s, d), digits=4),
        "h2o_q7": lambda s, d: h2o_q7(frame(s, d)),
        "h2o_q8": lambda s, d: h2o_q8(frame(s, d)),
        "h2o_q9": lambda s, d: h2o_q9(frame(s, d)),
    }
    for name, fn in runs.items():
        reg.add(name, fn, with_duckdb_ctes(SQL[name], {"h2o": H2O_CTE}))
