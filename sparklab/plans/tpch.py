"""The 22 TPC-H queries as DataFrame plans.

``qNN(t, **params)`` takes a :class:`~sparklab.tables.Tables` and returns a
DataFrame. Defaults are the TPC-H validation constants; the fixture bindings
are passed by the registry. Money is summed as DECIMAL and returned as double
(see :mod:`sparklab.functions.exact`). Only the fixed-size dimensions
``nation`` (25 rows) and ``region`` (5 rows) are broadcast by hint; every other
join strategy is left to AQE, which broadcasts at run time only when the
measured side is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparklab.functions.dates import add_months_str, ts_lit
from sparklab.functions.exact import money_sum, round_units, units, units_sum, units_to_double
from sparklab.tables import Tables

col = F.col


def _revenue():
    """extendedprice * (1 - discount) in units of 1e-4 (cents x percent)."""
    return units("l_extendedprice") * (F.lit(100) - units("l_discount"))


def _rev_sum():
    return money_sum(_revenue(), 4)


def sort_small(df: DataFrame, *cols) -> DataFrame:
    """Order a result whose row count is bounded by the schema (flags,
    nations, years, ship modes...): one tiny shuffle to a single partition and
    a local sort, instead of a range-partitioned sort with its sampling job.
    The aggregation before it stays parallel."""
    return df.repartition(1).sortWithinPartitions(*cols)


def _nations(t: Tables, names=None, region=None) -> DataFrame:
    """Bounded lookup: nation (25 rows) optionally restricted by name/region."""
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    if names is not None:
        n = n.filter(col("n_name").isin(list(names)))
    if region is not None:
        r = t.region.filter(col("r_name") == region).select("r_regionkey")
        n = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left_semi")
    return F.broadcast(n)


def q01(t: Tables, ship_cutoff: str = "1998-09-02") -> DataFrame:
    li = t.lineitem.filter(col("l_shipdate") <= ts_lit(ship_cutoff))
    disc_price = _revenue()
    price = money_sum(units("l_extendedprice"), 2)
    return (
        li.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            price.alias("sum_base_price"),
            money_sum(disc_price, 4).alias("sum_disc_price"),
            money_sum(disc_price * (F.lit(100) + units("l_tax")), 6).alias("sum_charge"),
            (F.sum("l_quantity") / F.count("l_quantity")).alias("avg_qty"),
            (price / F.count("l_extendedprice")).alias("avg_price"),
            (money_sum(units("l_discount"), 2) / F.count("l_discount")).alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .transform(lambda d: sort_small(d, "l_returnflag", "l_linestatus"))
    )


def q02(t: Tables, size=15, type_suffix: str = "BRASS", region: str = "EUROPE") -> DataFrame:
    lo, hi = (size, size) if isinstance(size, int) else size
    nations = _nations(t, region=region)
    supp = t.supplier.join(nations, col("s_nationkey") == col("n_nationkey"))
    parts = t.part.filter(col("p_size").between(lo, hi) & col("p_type").endswith(type_suffix))
    ps = t.partsupp.join(parts.select("p_partkey", "p_mfgr"), col("ps_partkey") == col("p_partkey"), "inner")
    cand = ps.join(supp, col("ps_suppkey") == col("s_suppkey"))
    # cheapest in-region supplier per part: a window over the candidates of the
    # same part replaces the correlated MIN subquery and its second join
    w = Window.partitionBy("p_partkey")
    best = cand.withColumn("_min_cost", F.min("ps_supplycost").over(w)).filter(col("ps_supplycost") == col("_min_cost"))
    return (
        best.select("s_acctbal", "s_name", "n_name", "p_partkey", "p_mfgr", "s_address", "s_phone", "s_comment")
        .orderBy(col("s_acctbal").desc(), "n_name", "s_name", "p_partkey")
        .limit(100)
    )


def q03(t: Tables, segment: str = "BUILDING", date: str = "1995-03-15") -> DataFrame:
    c = t.customer.filter(col("c_mktsegment") == segment).select("c_custkey")
    o = t.orders.filter(col("o_orderdate") < ts_lit(date)).select("o_orderkey", "o_custkey", "o_orderdate", "o_shippriority")
    o = o.join(c, col("o_custkey") == col("c_custkey"), "left_semi")
    li = t.lineitem.filter(col("l_shipdate") > ts_lit(date))
    j = li.join(o, col("l_orderkey") == col("o_orderkey"))
    return (
        j.groupBy("l_orderkey", "o_orderdate", "o_shippriority")
        .agg(_rev_sum().alias("revenue"))
        .select("l_orderkey", "revenue", "o_orderdate", "o_shippriority")
        .orderBy(col("revenue").desc(), "o_orderdate", "l_orderkey")
        .limit(10)
    )


def q04(t: Tables, date: str = "1993-07-01", months: int = 3) -> DataFrame:
    o = t.orders.filter((col("o_orderdate") >= ts_lit(date)) & (col("o_orderdate") < ts_lit(add_months_str(date, months))))
    late = t.lineitem.filter(col("l_commitdate") < col("l_receiptdate")).select("l_orderkey")
    return (
        o.join(late, col("o_orderkey") == col("l_orderkey"), "left_semi")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .transform(lambda d: sort_small(d, "o_orderpriority"))
    )


def q05(t: Tables, region: str = "ASIA", date: str = "1994-01-01", end: str | None = None) -> DataFrame:
    end = end or add_months_str(date, 12)
    nations = _nations(t, region=region)
    o = t.orders.filter((col("o_orderdate") >= ts_lit(date)) & (col("o_orderdate") < ts_lit(end)))
    supp = t.supplier.join(nations, col("s_nationkey") == col("n_nationkey")).select("s_suppkey", "s_nationkey", "n_name")
    j = (
        t.lineitem.join(o, col("l_orderkey") == col("o_orderkey"))
        .join(t.customer, col("o_custkey") == col("c_custkey"))
        .join(supp, (col("l_suppkey") == col("s_suppkey")) & (col("c_nationkey") == col("s_nationkey")))
    )
    return (
        j.groupBy("n_name").agg(_rev_sum().alias("revenue"))
        .transform(lambda d: sort_small(d, col("revenue").desc(), "n_name"))
    )


def q06(t: Tables, date: str = "1994-01-01", discount: float = 0.06, quantity: float = 24) -> DataFrame:
    lo, hi = round(discount - 0.01, 2), round(discount + 0.01, 2)
    li = t.lineitem.filter(
        (col("l_shipdate") >= ts_lit(date)) & (col("l_shipdate") < ts_lit(add_months_str(date, 12)))
        & col("l_discount").between(lo, hi) & (col("l_quantity") < quantity)
    )
    return li.agg(money_sum(units("l_extendedprice") * units("l_discount"), 4).alias("revenue"))


def q07(t: Tables, nation1: str = "FRANCE", nation2: str = "GERMANY",
        start: str = "1995-01-01", end: str = "1996-12-31") -> DataFrame:
    pair = [nation1, nation2]
    n1 = _nations(t, names=pair).select(col("n_nationkey").alias("sn_key"), col("n_name").alias("supp_nation"))
    n2 = _nations(t, names=pair).select(col("n_nationkey").alias("cn_key"), col("n_name").alias("cust_nation"))
    supp = t.supplier.join(n1, col("s_nationkey") == col("sn_key")).select("s_suppkey", "supp_nation")
    cust = t.customer.join(n2, col("c_nationkey") == col("cn_key")).select("c_custkey", "cust_nation")
    li = t.lineitem.filter(col("l_shipdate").between(ts_lit(start), ts_lit(end)))
    j = (
        li.join(supp, col("l_suppkey") == col("s_suppkey"))
        .join(t.orders.select("o_orderkey", "o_custkey"), col("l_orderkey") == col("o_orderkey"))
        .join(cust, col("o_custkey") == col("c_custkey"))
        .filter(col("supp_nation") != col("cust_nation"))
    )
    return (
        j.groupBy("supp_nation", "cust_nation", F.year("l_shipdate").alias("l_year"))
        .agg(_rev_sum().alias("revenue"))
        .transform(lambda d: sort_small(d, "supp_nation", "cust_nation", "l_year"))
    )


def q08(t: Tables, nation: str = "BRAZIL", region: str = "AMERICA", part_type: str = "ECONOMY ANODIZED STEEL",
        start: str = "1995-01-01", end: str = "1996-12-31") -> DataFrame:
    cust_nations = _nations(t, region=region).select(col("n_nationkey").alias("cn_key"))
    supp_nations = _nations(t).select(col("n_nationkey").alias("sn_key"), col("n_name").alias("nation"))
    parts = t.part.filter(col("p_type") == part_type).select("p_partkey")
    o = t.orders.filter(col("o_orderdate").between(ts_lit(start), ts_lit(end))).select("o_orderkey", "o_custkey", "o_orderdate")
    cust = t.customer.join(cust_nations, col("c_nationkey") == col("cn_key"), "left_semi").select("c_custkey")
    supp = t.supplier.join(supp_nations, col("s_nationkey") == col("sn_key")).select("s_suppkey", "nation")
    j = (
        t.lineitem.join(parts, col("l_partkey") == col("p_partkey"), "left_semi")
        .join(o, col("l_orderkey") == col("o_orderkey"))
        .join(cust, col("o_custkey") == col("c_custkey"), "left_semi")
        .join(supp, col("l_suppkey") == col("s_suppkey"))
    )
    vol = _revenue()
    return (
        j.groupBy(F.year("o_orderdate").alias("o_year"))
        .agg(money_sum(F.when(col("nation") == nation, vol).otherwise(F.lit(0).cast("bigint")), 4).alias("_n"),
             money_sum(vol, 4).alias("_all"))
        .select("o_year", F.round(col("_n") / col("_all"), 2).alias("mkt_share"))
        .transform(lambda d: sort_small(d, "o_year"))
    )


def q09(t: Tables, name_pattern: str = "%green%") -> DataFrame:
    parts = t.part.filter(col("p_name").like(name_pattern)).select("p_partkey")
    li = t.lineitem.join(parts, col("l_partkey") == col("p_partkey"), "left_semi")
    ps = t.partsupp.join(parts, col("ps_partkey") == col("p_partkey"), "left_semi")
    supp = t.supplier.join(_nations(t), col("s_nationkey") == col("n_nationkey")).select("s_suppkey", "n_name")
    j = (
        li.join(ps, (col("l_partkey") == col("ps_partkey")) & (col("l_suppkey") == col("ps_suppkey")))
        .join(supp, col("l_suppkey") == col("s_suppkey"))
        .join(t.orders.select("o_orderkey", "o_orderdate"), col("l_orderkey") == col("o_orderkey"))
    )
    amount = _revenue() - units("ps_supplycost") * units("l_quantity")
    return (
        j.groupBy(col("n_name").alias("nation"), F.year("o_orderdate").alias("o_year"))
        .agg(round_units(units_sum(amount), 4, 2).alias("sum_profit"))
        .transform(lambda d: sort_small(d, "nation", col("o_year").desc()))
    )


def q10(t: Tables, date: str = "1993-10-01", months: int = 3, flag: str = "R") -> DataFrame:
    o = t.orders.filter((col("o_orderdate") >= ts_lit(date)) & (col("o_orderdate") < ts_lit(add_months_str(date, months))))
    li = t.lineitem.filter(col("l_returnflag") == flag)
    # aggregate per customer before attaching the wide customer columns
    per_cust = (
        li.join(o.select("o_orderkey", "o_custkey"), col("l_orderkey") == col("o_orderkey"))
        .groupBy("o_custkey").agg(round_units(units_sum(_revenue()), 4, 2).alias("revenue"))
    )
    c = t.customer.join(_nations(t), col("c_nationkey") == col("n_nationkey"))
    return (
        per_cust.join(c, col("o_custkey") == col("c_custkey"))
        .select("c_custkey", "c_name", "revenue", "c_acctbal", "n_name",
                F.trim("c_address").alias("c_address"), "c_phone", F.trim("c_comment").alias("c_comment"))
        .orderBy(col("revenue").desc(), "c_custkey")
        .limit(20)
    )


def q11(t: Tables, nation: str = "GERMANY", fraction: float = 0.0001) -> DataFrame:
    supp = t.supplier.join(_nations(t, names=[nation]), col("s_nationkey") == col("n_nationkey"), "left_semi")
    ps = t.partsupp.join(supp.select("s_suppkey"), col("ps_suppkey") == col("s_suppkey"), "left_semi")
    stock = units("ps_supplycost") * col("ps_availqty").cast("bigint")  # cents
    per_part = ps.groupBy("ps_partkey").agg(units_sum(stock).alias("_v"))
    num, den = Decimal(str(fraction)).as_integer_ratio()
    # scalar threshold (a scalar subquery over the per-part sums);
    # v > total * num / den compared exactly as v * den > total * num
    total = per_part.agg(F.sum("_v")).scalar()
    return (
        per_part
        .filter(col("_v") * F.lit(den).cast("decimal(38,0)") > total * F.lit(num).cast("decimal(38,0)"))
        .select("ps_partkey", units_to_double(col("_v"), 2).alias("value"))
        .orderBy(col("value").desc(), "ps_partkey")
    )


def q12(t: Tables, modes=("MAIL", "SHIP"), date: str = "1994-01-01") -> DataFrame:
    li = t.lineitem.filter(
        col("l_shipmode").isin(list(modes))
        & (col("l_commitdate") < col("l_receiptdate")) & (col("l_shipdate") < col("l_commitdate"))
        & (col("l_receiptdate") >= ts_lit(date)) & (col("l_receiptdate") < ts_lit(add_months_str(date, 12)))
    )
    high = col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return (
        li.join(t.orders.select("o_orderkey", "o_orderpriority"), col("l_orderkey") == col("o_orderkey"))
        .groupBy("l_shipmode")
        .agg(F.sum(F.when(high, 1).otherwise(0)).cast("bigint").alias("high_line_count"),
             F.sum(F.when(~high, 1).otherwise(0)).cast("bigint").alias("low_line_count"))
        .transform(lambda d: sort_small(d, "l_shipmode"))
    )


def q13(t: Tables, word1: str = "special", word2: str = "requests") -> DataFrame:
    # count orders per customer first (partial aggregation on the big side),
    # then one left join of the counts to customer
    o = t.orders.filter(~col("o_comment").like(f"%{word1}%{word2}%"))
    per_cust = o.groupBy("o_custkey").agg(F.count("o_orderkey").alias("_n"))
    c = t.customer.select("c_custkey").join(per_cust, col("c_custkey") == col("o_custkey"), "left")
    return (
        c.groupBy(F.coalesce(col("_n"), F.lit(0)).cast("bigint").alias("c_count"))
        .agg(F.count(F.lit(1)).alias("custdist"))
        .transform(lambda d: sort_small(d, col("custdist").desc(), col("c_count").desc()))
    )


def q14(t: Tables, date: str = "1995-09-01") -> DataFrame:
    li = t.lineitem.filter((col("l_shipdate") >= ts_lit(date)) & (col("l_shipdate") < ts_lit(add_months_str(date, 1))))
    j = li.join(t.part.select("p_partkey", "p_type"), col("l_partkey") == col("p_partkey"))
    rev = _revenue()
    return j.agg(
        F.round(
            F.lit(100.0) * money_sum(F.when(col("p_type").like("PROMO%"), rev).otherwise(F.lit(0).cast("bigint")), 4)
            / money_sum(rev, 4), 2).alias("promo_revenue")
    )


def q15(t: Tables, date: str = "1996-01-01", months: int = 3) -> DataFrame:
    li = t.lineitem.filter((col("l_shipdate") >= ts_lit(date)) & (col("l_shipdate") < ts_lit(add_months_str(date, months))))
    revenue = li.groupBy(col("l_suppkey").alias("supplier_no")).agg(units_sum(_revenue()).alias("total_revenue"))
    best = revenue.filter(col("total_revenue") == revenue.agg(F.max("total_revenue")).scalar())  # exact equality
    return (
        t.supplier.join(best, col("s_suppkey") == col("supplier_no"))
        .select("s_suppkey", "s_name", "s_address", "s_phone", units_to_double(col("total_revenue"), 4).alias("total_revenue"))
        .orderBy("s_suppkey")
    )


def q16(t: Tables, brand: str = "Brand#45", type_prefix: str = "MEDIUM POLISHED",
        sizes=(49, 14, 23, 45, 19, 3, 36, 9)) -> DataFrame:
    parts = t.part.filter((col("p_brand") != brand) & ~col("p_type").startswith(type_prefix) & col("p_size").isin(list(sizes)))
    complaints = t.supplier.filter(col("s_comment").like("%Customer%Complaints%")).select("s_suppkey")
    ps = (
        t.partsupp.join(parts.select("p_partkey", "p_brand", "p_type", "p_size"), col("ps_partkey") == col("p_partkey"))
        .join(complaints, col("ps_suppkey") == col("s_suppkey"), "left_anti")  # NOT IN on a non-null key
    )
    return (
        ps.groupBy("p_brand", "p_type", "p_size")
        .agg(F.countDistinct("ps_suppkey").alias("supplier_cnt"))
        # at most brands x types x sizes rows (a schema bound, not a data one)
        .transform(lambda d: sort_small(d, col("supplier_cnt").desc(), "p_brand", "p_type", "p_size"))
    )


def q17(t: Tables, brand: str = "Brand#23", container: str = "MED BOX", factor: float = 0.2) -> DataFrame:
    parts = t.part.filter((col("p_brand") == brand) & (col("p_container") == container)).select("p_partkey")
    li = t.lineitem.join(parts, col("l_partkey") == col("p_partkey"), "left_semi")
    # average per chosen part as a partial aggregate (one row per part), joined
    # back: no window, so a hot part is neither sorted nor held by one task
    avg_q = li.groupBy(col("l_partkey").alias("_pk")).agg(F.avg("l_quantity").alias("_avg"))
    small = li.join(avg_q, col("l_partkey") == col("_pk")).filter(col("l_quantity") < F.lit(factor) * col("_avg"))
    return small.agg(F.round(money_sum(units("l_extendedprice"), 2) / F.lit(7.0), 2).alias("avg_yearly"))


def q18(t: Tables, quantity: float = 300) -> DataFrame:
    # the per-order quantity of the HAVING subquery is also the reported sum,
    # so lineitem is aggregated once and never joined back
    big = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("col6")).filter(col("col6") > quantity)
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    j = big.join(o, col("l_orderkey") == col("o_orderkey")).join(
        t.customer.select("c_custkey", "c_name"), col("o_custkey") == col("c_custkey"))
    return (
        j.select("c_name", "c_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "col6")
        .orderBy(col("o_totalprice").desc(), "o_orderdate", "o_orderkey")
        .limit(100)
    )


DEFAULT_Q19 = [
    {"brand": "Brand#12", "containers": ["SM CASE", "SM BOX", "SM PACK", "SM PKG"], "qty": (1, 11), "size": (1, 5)},
    {"brand": "Brand#23", "containers": ["MED BAG", "MED BOX", "MED PKG", "MED PACK"], "qty": (10, 20), "size": (1, 10)},
    {"brand": "Brand#34", "containers": ["LG CASE", "LG BOX", "LG PACK", "LG PKG"], "qty": (20, 30), "size": (1, 15)},
]


def q19(t: Tables, branches=None, modes=("AIR", "AIR REG"), instruct: str = "DELIVER IN PERSON") -> DataFrame:
    branches = branches or DEFAULT_Q19
    li = t.lineitem.filter(
        col("l_shipmode").isin(list(modes)) & (col("l_shipinstruct") == instruct)
        & col("l_quantity").between(min(b["qty"][0] for b in branches), max(b["qty"][1] for b in branches))
    )
    parts = t.part.filter(col("p_brand").isin([b["brand"] for b in branches]))
    j = li.join(parts, col("l_partkey") == col("p_partkey"))  # the equi key stays outside the OR
    cond = None
    for b in branches:
        c = ((col("p_brand") == b["brand"]) & col("p_container").isin(list(b["containers"]))
             & col("l_quantity").between(*b["qty"]) & col("p_size").between(*b["size"]))
        cond = c if cond is None else (cond | c)
    return j.filter(cond).agg(round_units(units_sum(_revenue()), 4, 2).alias("revenue"))


def q20(t: Tables, name_prefix: str = "forest", date: str = "1994-01-01", nation: str = "CANADA",
        factor: float = 0.5) -> DataFrame:
    parts = t.part.filter(col("p_name").startswith(name_prefix)).select("p_partkey")
    shipped = (
        t.lineitem.filter((col("l_shipdate") >= ts_lit(date)) & (col("l_shipdate") < ts_lit(add_months_str(date, 12))))
        .join(parts, col("l_partkey") == col("p_partkey"), "left_semi")
        .groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("_q"))
    )
    ps = (
        t.partsupp.join(parts, col("ps_partkey") == col("p_partkey"), "left_semi")
        .join(shipped, (col("ps_partkey") == col("l_partkey")) & (col("ps_suppkey") == col("l_suppkey")))
        .filter(col("ps_availqty") > F.lit(factor) * col("_q"))
        .select("ps_suppkey")
    )
    supp = t.supplier.join(_nations(t, names=[nation]), col("s_nationkey") == col("n_nationkey"), "left_semi")
    return (
        supp.join(ps, col("s_suppkey") == col("ps_suppkey"), "left_semi")
        .select("s_name", F.trim("s_address").alias("s_address"))
        .orderBy("s_name")
    )


def q21(t: Tables, nation: str = "SAUDI ARABIA") -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_suppkey", (col("l_receiptdate") > col("l_commitdate")).alias("_late"))
    # EXISTS another supplier  <=> min(suppkey) < max(suppkey) over the order;
    # NOT EXISTS another late supplier <=> all late lines share one supplier.
    # Plain min/max: one partially-aggregated shuffle, no self joins.
    per_order = li.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("_smin"), F.max("l_suppkey").alias("_smax"),
        F.min(F.when(col("_late"), col("l_suppkey"))).alias("_lmin"),
        F.max(F.when(col("_late"), col("l_suppkey"))).alias("_lmax"),
    ).filter((col("_smin") < col("_smax")) & (col("_lmin") == col("_lmax"))).select(col("l_orderkey").alias("_ok"))
    supp = t.supplier.join(_nations(t, names=[nation]), col("s_nationkey") == col("n_nationkey"), "left_semi")
    failed = t.orders.filter(col("o_orderstatus") == "F").select("o_orderkey")
    l1 = (
        li.filter(col("_late"))
        .join(failed, col("l_orderkey") == col("o_orderkey"), "left_semi")
        .join(per_order, col("l_orderkey") == col("_ok"), "left_semi")
        .join(supp.select("s_suppkey", "s_name"), col("l_suppkey") == col("s_suppkey"))
    )
    return (
        l1.groupBy("s_name").agg(F.count(F.lit(1)).alias("numwait"))
        .orderBy(col("numwait").desc(), "s_name")
        .limit(100)
    )


def q22(t: Tables, codes=("13", "31", "23", "29", "30", "18", "17"), idle_every: int | None = None) -> DataFrame:
    """``idle_every=n`` (fixture only): orders of every n-th customer count for the customer before,
    so that some customers have no orders."""
    codes = [str(c) for c in codes]
    c = t.customer.select("c_custkey", "c_acctbal", F.substring("c_phone", 1, 2).alias("cntrycode")).filter(
        col("cntrycode").isin(codes))
    avg_bal = c.filter(col("c_acctbal") > 0.0).agg(money_sum(units("c_acctbal"), 2) / F.count("c_acctbal")).scalar()
    o = t.orders
    if idle_every is not None:
        o = o.withColumn("o_custkey", F.when(col("o_custkey") % idle_every == 0, col("o_custkey") - 1).otherwise(col("o_custkey")))
    rich = c.filter(col("c_acctbal") > avg_bal)
    idle = rich.join(o.select("o_custkey"), col("c_custkey") == col("o_custkey"), "left_anti")
    return (
        idle.groupBy("cntrycode")
        .agg(F.count(F.lit(1)).alias("numcust"), money_sum(units("c_acctbal"), 2).alias("totacctbal"))
        .transform(lambda d: sort_small(d, "cntrycode"))
    )


QUERIES = {f"q{i:02d}": globals()[f"q{i:02d}"] for i in range(1, 23)}

# Parameter bindings for the fixture tables (FIXTURES.md §4).
FIXTURE_PARAMS = {
    "q01": {},
    "q02": {"size": (1, 15), "type_suffix": "ARD", "region": "EUROPE"},
    "q03": {"segment": "BUILDING", "date": "1998-03-15"},
    "q04": {"date": "1996-07-01", "months": 3},
    "q05": {"region": "ASIA", "date": "1996-01-01", "end": "1998-01-01"},
    "q06": {"date": "1996-01-01"},
    "q07": {"nation1": "NATION_7", "nation2": "NATION_12", "start": "1996-01-01", "end": "1997-12-31"},
    "q08": {"nation": "NATION_7", "region": "AMERICA", "part_type": "ECONOMY", "start": "1996-01-01", "end": "1997-12-31"},
    "q09": {"name_pattern": "%blue%"},
    "q10": {"date": "1996-10-01", "months": 3, "flag": "R"},
    "q11": {"nation": "NATION_12", "fraction": 0.002},
    "q12": {"modes": ("MAIL", "SHIP"), "date": "1997-01-01"},
    "q13": {},
    "q14": {"date": "1996-09-01"},
    "q15": {"date": "1996-01-01", "months": 3},
    "q16": {"brand": "Brand#5", "type_prefix": "MEDIUM"},
    "q17": {"brand": "Brand#23", "container": "MED BOX", "factor": 0.5},
    "q18": {"quantity": 250},
    "q19": {"branches": [
        {"brand": "Brand#12", "containers": ["SM CASE", "SM BOX"], "qty": (1, 30), "size": (1, 30)},
        {"brand": "Brand#23", "containers": ["MED BAG", "MED BOX"], "qty": (10, 40), "size": (1, 30)},
        {"brand": "Brand#14", "containers": ["LG CASE", "LG BOX"], "qty": (20, 50), "size": (1, 30)},
    ]},
    "q20": {"name_prefix": "red", "date": "1996-01-01", "nation": "NATION_12"},
    "q21": {"nation": "NATION_12"},
    "q22": {"idle_every": 3},
}
