"""Table comparison with tolerance (V1, V2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.operators.relational import rank_within_groups, relax_schema

col = F.col
NUMERIC = {"double", "float", "integer", "long", "short", "byte", "decimal"}


def _digest(df: DataFrame, cols, numeric, strip: bool):
    """Two 64-bit hashes of a row: numbers as doubles, the rest as (stripped) strings, NULLs by their places."""
    values = []
    for c in cols:
        v = col(c).cast("double") if c in numeric else col(c).cast("string")
        values.append(F.trim(v) if strip and c not in numeric else v)
    nulls = F.concat(F.lit("_"), *[F.when(col(c).isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(F.lit(i), nulls, *values).alias(f"_h{i}") for i in range(2)]


def diff_tables(a: DataFrame, b: DataFrame, keys, atol: float = 1e-2, strip: bool = True) -> DataFrame:
    """Cells that differ between ``a`` and ``b`` (V1), as multisets of rows.

    Rows that are equal on both sides cancel first, by counts per digest (one
    partial aggregate; a key or a row that a third of all rows have is one
    row per task). Only what is left is paired: by ``keys`` and by the rank
    among the left rows of a key, numbered by a range-partitioned sort.
    Strings are compared stripped, numbers within ``atol`` regardless of type
    (decimal/date relaxed first). Output ``(keys..., _row, column, a_num,
    b_num, a_str, b_str, side)``. A row present on one side only is reported
    once, with column ``<row>`` and the side it is on, whatever its cells
    hold; a column of one side only is reported for every row of that side.
    ``side`` is ``both`` for cells; ``_row`` counts the left rows of a key
    from 1 (0: a row that was cancelled). A NULL key is a key like any other."""
    from sparklab.session import cut_lineage

    keys = list(keys)
    a, b = relax_schema(a), relax_schema(b)
    shared = [c for c in a.columns if c not in keys and c in b.columns]
    lone = [(c, "a") for c in a.columns if c not in b.columns] + [(c, "b") for c in b.columns if c not in a.columns]
    is_num = lambda df, c: df.schema[c].dataType.typeName() in NUMERIC
    numeric = {c for c in keys + shared if is_num(a, c) and is_num(b, c)}
    hashed = {s: df.select("*", *_digest(df, keys + shared, numeric, strip)) for s, df in (("a", a), ("b", b))}
    h = ["_h0", "_h1"]
    both = hashed["a"].select(*h, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(hashed["b"].select(*h, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    counts = both.groupBy(*h).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    uneven = cut_lineage(counts.where("_a <> _b"))

    def left(side):
        """Rows of a side that have no equal on the other; of a row that both have, the surplus."""
        d = hashed[side].join(uneven, h)
        mine, other = col(f"_{side}"), col("_b" if side == "a" else "_a")
        surplus = rank_within_groups(d.where((other > 0) & (mine > other)), h, keys, name="_of").where(col("_of") >= other).drop("_of")
        return d.where(other == 0).unionByName(surplus).drop("_a", "_b")

    def ranked(side):
        d = rank_within_groups(left(side), keys, shared, name="_row")
        return d.select(*[col(k).alias(f"_{side}k_{k}") for k in keys], (col("_row") + 1).cast("int").alias(f"_{side}_row"),
                        *[col(c).alias(f"_{side}_{c}") for c in d.columns if c not in (*keys, *h, "_row")])

    # null-safe match, so a NULL key is a key like any other
    on = col("_a_row") == col("_b_row")
    for k in keys:
        on = on & col(f"_ak_{k}").eqNullSafe(col(f"_bk_{k}"))
    j = ranked("a").join(ranked("b"), on, "full_outer")
    side = F.when(col("_b_row").isNull(), "a").when(col("_a_row").isNull(), "b").otherwise("both")
    none = {"a_num": "double", "b_num": "double", "a_str": "string", "b_str": "string"}

    def cell(name, differs, **values):
        return F.struct(F.lit(name).alias("column"), *[values.get(n, F.lit(None).cast(t)).cast(t).alias(n) for n, t in none.items()],
                        differs.alias("_differs"))

    cells = [cell("<row>", col("_side") != "both")]
    for c in shared:
        x, y = col("_a_" + c), col("_b_" + c)
        if c in numeric:
            same = (x.isNull() & y.isNull()) | (F.abs(x.cast("double") - y.cast("double")) <= atol)
            cells.append(cell(c, (col("_side") == "both") & ~F.coalesce(same, F.lit(False)), a_num=x, b_num=y))
        else:
            xs, ys = (F.trim(x.cast("string")), F.trim(y.cast("string"))) if strip else (x.cast("string"), y.cast("string"))
            cells.append(cell(c, (col("_side") == "both") & ~xs.eqNullSafe(ys), a_str=xs, b_str=ys))
    for c, s in lone:
        cells.append(cell(c, col(f"_{s}_row").isNotNull(), **{f"{s}_str": col(f"_{s}_{c}").cast("string")}))
    out = j.withColumn("_side", side).select(
        *[F.coalesce(f"_ak_{k}", f"_bk_{k}").alias(k) for k in keys], F.coalesce("_a_row", "_b_row").alias("_row"), col("_side").alias("side"),
        F.explode(F.array(*cells)).alias("_c"))
    names = [*keys, "_row", "column", *none, "side"]
    out = out.filter(col("_c._differs")).select(*keys, "_row", *[f"_c.{c}" for c in ("column", *none)], "side").select(*names)
    for s in {s for _, s in lone}:  # rows that were cancelled have such a column too
        mine, other = col(f"_{s}"), col("_b" if s == "a" else "_a")
        d = hashed[s].join(uneven, h, "left_anti")
        part = rank_within_groups(hashed[s].join(uneven.where(other > 0), h), h, keys, name="_of").where((col("_of") < other) | (mine <= other))
        d = d.unionByName(part.drop("_a", "_b", "_of"))
        more = [cell(c, F.lit(True), **{f"{s}_str": col(c).cast("string")}) for c, of in lone if of == s]
        d = d.select(*keys, F.lit(0).alias("_row"), F.explode(F.array(*more)).alias("_c"), F.lit("both").alias("side"))
        out = out.unionByName(d.select(*keys, "_row", *[f"_c.{c}" for c in ("column", *none)], "side"))
    return out


def register(reg) -> None:
    from sparklab.tables import Tables

    def run(s, d):
        """All orders against an edited copy: some prices moved, some statuses NULL, some rows missing, one column more."""
        o = Tables.of(s, d).raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
        gone = o.filter(col("o_orderkey") % 97 != 3)
        b = gone.select("o_orderkey", "o_custkey", F.when(col("o_orderkey") % 89 != 5, col("o_orderstatus")).alias("o_orderstatus"),
                        (col("o_totalprice") + F.when(col("o_orderkey") % 83 == 7, 1.0).otherwise(0.001)).alias("o_totalprice"),
                        F.when(col("o_orderkey") % 10 < 9, 1).alias("extra"))
        a = o.filter(col("o_orderkey") % 101 != 11)
        r = diff_tables(a, b, ["o_orderkey"])
        return r.groupBy("column", "side").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"),
                                               F.count("a_num").alias("a_nums"), F.count("b_str").alias("b_strs"))

    reg.add("diff_tables", run, """
with a as (select * from orders where o_orderkey % 101 <> 11),
b as (select o_orderkey, o_custkey, case when o_orderkey % 89 <> 5 then o_orderstatus end as o_orderstatus,
        o_totalprice + case when o_orderkey % 83 = 7 then 1.0 else 0.001 end as o_totalprice,
        case when o_orderkey % 10 < 9 then 1 end as extra from orders where o_orderkey % 97 <> 3),
j as (select coalesce(a.o_orderkey, b.o_orderkey) as k, a.o_orderkey is not null as ina, b.o_orderkey is not null as inb,
        a.o_orderstatus as sa, b.o_orderstatus as sb, a.o_totalprice as pa, b.o_totalprice as pb, b.extra
      from a full outer join b on a.o_orderkey = b.o_orderkey),
c as (select '<row>' as "column", k, case when ina then 'a' else 'b' end as side, null::double as a_num, null::varchar as b_str from j where not (ina and inb)
  union all select 'o_orderstatus', k, 'both', null, sb from j where ina and inb and sa is distinct from sb
  union all select 'o_totalprice', k, 'both', pa, null from j where ina and inb and not coalesce(abs(pa - pb) <= 0.01, false)
  union all select 'extra', k, case when ina then 'both' else 'b' end, null, extra::varchar from j where inb)
select "column", side, count(*) as n, cast(sum(k) as bigint) as keys, count(a_num) as a_nums, count(b_str) as b_strs from c group by 1, 2""")
