"""SQL text of the 22 TPC-H queries with the fixture bindings.

The bodies are written once against the derived names ``lineitem_x``,
``orders_x``, ``customer_x``, ``supplier_x``, ``part_x`` and ``partsupp``.
:func:`duckdb_sql` prefixes DuckDB CTEs that derive them from the base views
(the correctness oracle); :func:`spark_sql_text` leaves the body for Spark,
where :meth:`Tables.register_views` supplies the same names.
Money is summed as DECIMAL and cast to double, as in :mod:`sparklab.plans.tpch`.
"""

from __future__ import annotations

import re

REV = "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"

# DuckDB forms of the derived columns (FIXTURES.md §3).
DUCKDB_CTES = {
    "lineitem_x": """lineitem_x as (select *,
        l_shipdate + to_days(cast((l_orderkey*7 + l_partkey) % 46 - 15 as integer)) as l_commitdate,
        l_shipdate + to_days(cast(1 + (l_orderkey + l_suppkey*3 + l_linenumber) % 30 as integer)) as l_receiptdate,
        case (l_orderkey + l_linenumber) % 7 when 0 then 'AIR' when 1 then 'AIR REG' when 2 then 'MAIL'
             when 3 then 'SHIP' when 4 then 'TRUCK' when 5 then 'RAIL' else 'FOB' end as l_shipmode,
        case (l_partkey + l_linenumber) % 4 when 0 then 'DELIVER IN PERSON' when 1 then 'COLLECT COD'
             when 2 then 'NONE' else 'TAKE BACK RETURN' end as l_shipinstruct
        from lineitem)""",
    "partsupp": """partsupp as (select ps_partkey, ps_suppkey,
        cast(1 + (ps_partkey*31 + ps_suppkey*17) % 200 as integer) as ps_availqty,
        cast(100 + (ps_partkey*13 + ps_suppkey*7) % 90000 as double) / 100 as ps_supplycost
        from (select distinct l_partkey as ps_partkey, l_suppkey as ps_suppkey from lineitem))""",
    "orders_x": """orders_x as (select *, cast(0 as integer) as o_shippriority,
        case when o_orderkey % 11 = 0 then 'special late requests' else 'plain' end as o_comment from orders)""",
    "customer_x": """customer_x as (select *,
        cast(10 + c_nationkey as varchar) || '-' || cast(c_custkey as varchar) as c_phone,
        'addr ' || cast(c_custkey as varchar) as c_address,
        'note ' || cast(c_custkey as varchar) as c_comment from customer)""",
    "supplier_x": """supplier_x as (select *,
        'addr ' || cast(s_suppkey as varchar) as s_address,
        cast(10 + s_nationkey as varchar) || '-' || cast(s_suppkey as varchar) as s_phone,
        case when s_suppkey % 10 = 3 then 'Customer slow Complaints' else 'plain' end as s_comment from supplier)""",
    "part_x": """part_x as (select *,
        'Manufacturer#' || cast(1 + p_partkey % 5 as varchar) as p_mfgr,
        case p_partkey % 8 when 0 then 'SM CASE' when 1 then 'SM BOX' when 2 then 'MED BAG' when 3 then 'MED BOX'
             when 4 then 'LG CASE' when 5 then 'LG BOX' when 6 then 'JUMBO PKG' else 'WRAP JAR' end as p_container from part)""",
}

BODIES = {
    "q01": f"""
select l_returnflag, l_linestatus,
    sum(l_quantity) as sum_qty,
    cast(sum(cast(l_extendedprice as decimal(12,2))) as double) as sum_base_price,
    cast(sum({REV}) as double) as sum_disc_price,
    cast(sum({REV} * (1 + cast(l_tax as decimal(4,2)))) as double) as sum_charge,
    sum(l_quantity) / count(l_quantity) as avg_qty,
    cast(sum(cast(l_extendedprice as decimal(12,2))) as double) / count(l_extendedprice) as avg_price,
    cast(sum(cast(l_discount as decimal(4,2))) as double) / count(l_discount) as avg_disc,
    count(*) as count_order
from lineitem
where l_shipdate <= timestamp '1998-09-02'
group by l_returnflag, l_linestatus
order by l_returnflag, l_linestatus""",
    "q02": """
select s_acctbal, s_name, n_name, p_partkey, p_mfgr, s_address, s_phone, s_comment
from part_x, supplier_x, partsupp, nation, region
where p_partkey = ps_partkey and s_suppkey = ps_suppkey and p_size between 1 and 15 and p_type like '%ARD'
  and s_nationkey = n_nationkey and n_regionkey = r_regionkey and r_name = 'EUROPE'
  and ps_supplycost = (
    select min(ps_supplycost) from partsupp, supplier_x, nation, region
    where p_partkey = ps_partkey and s_suppkey = ps_suppkey and s_nationkey = n_nationkey
      and n_regionkey = r_regionkey and r_name = 'EUROPE')
order by s_acctbal desc, n_name, s_name, p_partkey
limit 100""",
    "q03": f"""
select l_orderkey, cast(sum({REV}) as double) as revenue, o_orderdate, o_shippriority
from customer, orders_x, lineitem
where c_mktsegment = 'BUILDING' and c_custkey = o_custkey and l_orderkey = o_orderkey
  and o_orderdate < timestamp '1998-03-15' and l_shipdate > timestamp '1998-03-15'
group by l_orderkey, o_orderdate, o_shippriority
order by revenue desc, o_orderdate, l_orderkey
limit 10""",
    "q04": """
select o_orderpriority, count(*) as order_count
from orders
where o_orderdate >= timestamp '1996-07-01' and o_orderdate < timestamp '1996-10-01'
  and exists (select * from lineitem_x where l_orderkey = o_orderkey and l_commitdate < l_receiptdate)
group by o_orderpriority
order by o_orderpriority""",
    "q05": f"""
select n_name, cast(sum({REV}) as double) as revenue
from customer, orders, lineitem, supplier, nation, region
where c_custkey = o_custkey and l_orderkey = o_orderkey and l_suppkey = s_suppkey
  and c_nationkey = s_nationkey and s_nationkey = n_nationkey and n_regionkey = r_regionkey
  and r_name = 'ASIA' and o_orderdate >= timestamp '1996-01-01' and o_orderdate < timestamp '1998-01-01'
group by n_name
order by revenue desc, n_name""",
    "q06": """
select cast(sum(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2))) as double) as revenue
from lineitem
where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01'
  and l_discount between 0.05 and 0.07 and l_quantity < 24""",
    "q07": f"""
select supp_nation, cust_nation, l_year, cast(sum(volume) as double) as revenue
from (
  select n1.n_name as supp_nation, n2.n_name as cust_nation, cast(year(l_shipdate) as integer) as l_year,
         {REV} as volume
  from supplier, lineitem, orders, customer, nation n1, nation n2
  where s_suppkey = l_suppkey and o_orderkey = l_orderkey and c_custkey = o_custkey
    and s_nationkey = n1.n_nationkey and c_nationkey = n2.n_nationkey
    and ((n1.n_name = 'NATION_7' and n2.n_name = 'NATION_12') or (n1.n_name = 'NATION_12' and n2.n_name = 'NATION_7'))
    and l_shipdate between timestamp '1996-01-01' and timestamp '1997-12-31'
) shipping
group by supp_nation, cust_nation, l_year
order by supp_nation, cust_nation, l_year""",
    "q08": f"""
select o_year,
  round(cast(sum(case when nation = 'NATION_7' then volume else 0 end) as double) / cast(sum(volume) as double), 2) as mkt_share
from (
  select cast(year(o_orderdate) as integer) as o_year, {REV} as volume, n2.n_name as nation
  from part, supplier, lineitem, orders, customer, nation n1, nation n2, region
  where p_partkey = l_partkey and s_suppkey = l_suppkey and l_orderkey = o_orderkey and o_custkey = c_custkey
    and c_nationkey = n1.n_nationkey and n1.n_regionkey = r_regionkey and r_name = 'AMERICA'
    and s_nationkey = n2.n_nationkey
    and o_orderdate between timestamp '1996-01-01' and timestamp '1997-12-31' and p_type = 'ECONOMY'
) all_nations
group by o_year
order by o_year""",
    "q09": f"""
select nation, o_year, cast(round(sum(amount), 2) as double) as sum_profit
from (
  select n_name as nation, cast(year(o_orderdate) as integer) as o_year,
         {REV} - cast(ps_supplycost as decimal(12,2)) * cast(l_quantity as decimal(12,2)) as amount
  from part, supplier, lineitem, partsupp, orders, nation
  where s_suppkey = l_suppkey and ps_suppkey = l_suppkey and ps_partkey = l_partkey and p_partkey = l_partkey
    and o_orderkey = l_orderkey and s_nationkey = n_nationkey and p_name like '%blue%'
) profit
group by nation, o_year
order by nation, o_year desc""",
    "q10": f"""
select c_custkey, c_name, cast(round(sum({REV}), 2) as double) as revenue, c_acctbal, n_name,
       trim(c_address) as c_address, c_phone, trim(c_comment) as c_comment
from customer_x, orders, lineitem, nation
where c_custkey = o_custkey and l_orderkey = o_orderkey
  and o_orderdate >= timestamp '1996-10-01' and o_orderdate < timestamp '1997-01-01'
  and l_returnflag = 'R' and c_nationkey = n_nationkey
group by c_custkey, c_name, c_acctbal, c_phone, n_name, c_address, c_comment
order by revenue desc, c_custkey
limit 20""",
    "q11": """
select ps_partkey, cast(round(sum(cast(ps_supplycost as decimal(12,2)) * ps_availqty), 2) as double) as value
from partsupp, supplier, nation
where ps_suppkey = s_suppkey and s_nationkey = n_nationkey and n_name = 'NATION_12'
group by ps_partkey
having sum(cast(ps_supplycost as decimal(12,2)) * ps_availqty) > (
  select sum(cast(ps_supplycost as decimal(12,2)) * ps_availqty) * 0.002
  from partsupp, supplier, nation
  where ps_suppkey = s_suppkey and s_nationkey = n_nationkey and n_name = 'NATION_12')
order by value desc, ps_partkey""",
    "q12": """
select l_shipmode,
  cast(sum(case when o_orderpriority = '1-URGENT' or o_orderpriority = '2-HIGH' then 1 else 0 end) as bigint) as high_line_count,
  cast(sum(case when o_orderpriority <> '1-URGENT' and o_orderpriority <> '2-HIGH' then 1 else 0 end) as bigint) as low_line_count
from orders, lineitem_x
where o_orderkey = l_orderkey and l_shipmode in ('MAIL', 'SHIP')
  and l_commitdate < l_receiptdate and l_shipdate < l_commitdate
  and l_receiptdate >= timestamp '1997-01-01' and l_receiptdate < timestamp '1998-01-01'
group by l_shipmode
order by l_shipmode""",
    "q13": """
select c_count, count(*) as custdist
from (
  select c_custkey, count(o_orderkey) as c_count
  from customer left outer join orders_x on c_custkey = o_custkey and o_comment not like '%special%requests%'
  group by c_custkey
) c_orders
group by c_count
order by custdist desc, c_count desc""",
    "q14": f"""
select round(100.0 * cast(sum(case when p_type like 'PROMO%' then {REV} else 0 end) as double)
             / cast(sum({REV}) as double), 2) as promo_revenue
from lineitem, part
where l_partkey = p_partkey and l_shipdate >= timestamp '1996-09-01' and l_shipdate < timestamp '1996-10-01'""",
    "q15": f"""
select s_suppkey, s_name, s_address, s_phone, cast(total_revenue as double) as total_revenue
from supplier_x, (
  select l_suppkey as supplier_no, sum({REV}) as total_revenue from lineitem
  where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1996-04-01' group by l_suppkey
) revenue0
where s_suppkey = supplier_no and total_revenue = (
  select max(total_revenue) from (
    select l_suppkey as supplier_no, sum({REV}) as total_revenue from lineitem
    where l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1996-04-01' group by l_suppkey) r)
order by s_suppkey""",
    "q16": """
select p_brand, p_type, p_size, count(distinct ps_suppkey) as supplier_cnt
from partsupp, part
where p_partkey = ps_partkey and p_brand <> 'Brand#5' and p_type not like 'MEDIUM%'
  and p_size in (49, 14, 23, 45, 19, 3, 36, 9)
  and ps_suppkey not in (select s_suppkey from supplier_x where s_comment like '%Customer%Complaints%')
group by p_brand, p_type, p_size
order by supplier_cnt desc, p_brand, p_type, p_size""",
    "q17": """
select round(cast(sum(cast(l_extendedprice as decimal(12,2))) as double) / 7.0, 2) as avg_yearly
from lineitem, part_x
where p_partkey = l_partkey and p_brand = 'Brand#23' and p_container = 'MED BOX'
  and l_quantity < (select 0.5 * avg(l_quantity) from lineitem l2 where l2.l_partkey = p_partkey)""",
    "q18": """
select c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice, sum(l_quantity) as col6
from customer, orders, lineitem
where o_orderkey in (select l_orderkey from lineitem group by l_orderkey having sum(l_quantity) > 250)
  and c_custkey = o_custkey and o_orderkey = l_orderkey
group by c_name, c_custkey, o_orderkey, o_orderdate, o_totalprice
order by o_totalprice desc, o_orderdate, o_orderkey
limit 100""",
    "q19": f"""
select cast(round(sum({REV}), 2) as double) as revenue
from lineitem_x, part_x
where (p_partkey = l_partkey and p_brand = 'Brand#12' and p_container in ('SM CASE', 'SM BOX')
       and l_quantity >= 1 and l_quantity <= 30 and p_size between 1 and 30
       and l_shipmode in ('AIR', 'AIR REG') and l_shipinstruct = 'DELIVER IN PERSON')
   or (p_partkey = l_partkey and p_brand = 'Brand#23' and p_container in ('MED BAG', 'MED BOX')
       and l_quantity >= 10 and l_quantity <= 40 and p_size between 1 and 30
       and l_shipmode in ('AIR', 'AIR REG') and l_shipinstruct = 'DELIVER IN PERSON')
   or (p_partkey = l_partkey and p_brand = 'Brand#14' and p_container in ('LG CASE', 'LG BOX')
       and l_quantity >= 20 and l_quantity <= 50 and p_size between 1 and 30
       and l_shipmode in ('AIR', 'AIR REG') and l_shipinstruct = 'DELIVER IN PERSON')""",
    "q20": """
select s_name, trim(s_address) as s_address
from supplier_x, nation
where s_suppkey in (
    select ps_suppkey from partsupp
    where ps_partkey in (select p_partkey from part where p_name like 'red%')
      and ps_availqty > (
        select 0.5 * sum(l_quantity) from lineitem
        where l_partkey = ps_partkey and l_suppkey = ps_suppkey
          and l_shipdate >= timestamp '1996-01-01' and l_shipdate < timestamp '1997-01-01'))
  and s_nationkey = n_nationkey and n_name = 'NATION_12'
order by s_name""",
    "q21": """
select s_name, count(*) as numwait
from supplier, lineitem_x l1, orders, nation
where s_suppkey = l1.l_suppkey and o_orderkey = l1.l_orderkey and o_orderstatus = 'F'
  and l1.l_receiptdate > l1.l_commitdate
  and exists (select * from lineitem_x l2 where l2.l_orderkey = l1.l_orderkey and l2.l_suppkey <> l1.l_suppkey)
  and not exists (select * from lineitem_x l3 where l3.l_orderkey = l1.l_orderkey
                  and l3.l_suppkey <> l1.l_suppkey and l3.l_receiptdate > l3.l_commitdate)
  and s_nationkey = n_nationkey and n_name = 'NATION_12'
group by s_name
order by numwait desc, s_name
limit 100""",
    "q22": """
select cntrycode, count(*) as numcust, cast(sum(cast(c_acctbal as decimal(12,2))) as double) as totacctbal
from (
  select substring(c_phone, 1, 2) as cntrycode, c_acctbal
  from customer_x
  where substring(c_phone, 1, 2) in ('13', '31', '23', '29', '30', '18', '17')
    and c_acctbal > (
      select cast(sum(cast(c_acctbal as decimal(12,2))) as double) / count(c_acctbal) from customer_x
      where c_acctbal > 0.00 and substring(c_phone, 1, 2) in ('13', '31', '23', '29', '30', '18', '17'))
    and not exists (select * from orders where case when o_custkey % 3 = 0 then o_custkey - 1 else o_custkey end = c_custkey)
) custsale
group by cntrycode
order by cntrycode""",
}


def needed_ctes(body: str) -> list[str]:
    return [name for name in DUCKDB_CTES if re.search(rf"\b{name}\b", body)]


def with_duckdb_ctes(body: str, extra: dict | None = None) -> str:
    """Prefix the DuckDB derivations a body refers to (plus ``extra`` CTEs)."""
    ctes = {**DUCKDB_CTES, **(extra or {})}
    wanted = {n for n in ctes if re.search(rf"\b{n}\b", body)}
    while True:  # CTEs used by other CTEs
        more = {m for n in wanted for m in ctes if m not in wanted
                and re.search(rf"\b{m}\b", ctes[n].split(" as (", 1)[1])}
        if not more:
            break
        wanted |= more
    names = [n for n in ctes if n in wanted]
    body = body.strip()
    if not names:
        return body
    head = "with " + ",\n".join(ctes[n] for n in names)
    if re.match(r"(?is)^with\s", body):
        return head + ",\n" + body[4:].lstrip()
    return head + "\n" + body


def duckdb_sql(q: str) -> str:
    return with_duckdb_ctes(BODIES[q])


def spark_sql_text(q: str) -> str:
    """Same body for ``spark.sql`` after ``Tables.register_views`` + ``register_derived_views``."""
    return BODIES[q].strip()


def register_derived_views(t) -> None:
    """Views named like the DuckDB CTEs, for running the bodies on Spark."""
    t.register_views()
    for name, base in [("lineitem_x", "lineitem"), ("orders_x", "orders"), ("customer_x", "customer"),
                       ("supplier_x", "supplier"), ("part_x", "part")]:
        t[base].createOrReplaceTempView(name)
    for base in ["lineitem", "orders", "customer", "supplier", "part"]:
        t.raw(base).createOrReplaceTempView(base)
