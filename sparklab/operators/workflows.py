"""End-to-end workflows (X1, X3, X4, X5) built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.functions.dates import date_from_yymm
from sparklab.functions.text import safe_int
from sparklab.operators.relational import dedup, mean_by, series_extremes

col = F.col


def pattern_share_over_time(members: DataFrame, member: str = "member", flag: str = "contains") -> DataFrame:
    """Share of archive members containing a pattern, per month taken from the
    member's ``yymm/`` prefix (X1): ``(date, n, share)``."""
    yymm = F.substring_index(col(member), "/", 1)
    members = members.filter(col(member).isNotNull())  # archives that could not be read have no member
    d = members.select(date_from_yymm(yymm).cast("timestamp_ntz").alias("date"), col(flag).cast("int").alias("_f"))
    return d.groupBy("date").agg(F.count(F.lit(1)).alias("n"), (F.sum("_f").cast("double") / F.count("_f")).alias("share"))


def pattern_share_extremes(shares: DataFrame) -> DataFrame:
    """idxmin / idxmax / first non-zero month of the share series."""
    return series_extremes(shares, "date", "share")


def documents_as_members(documents: DataFrame, needle: str = "license") -> DataFrame:
    """Members ``yymm/<doc_id>.pdf`` built from ``documents``: the year runs
    1991..2022 by doc_id, the month by doc_id div 32; ``contains`` tests the
    lower-cased text for ``needle``."""
    yy = F.lpad(F.pmod(F.lit(91) + col("doc_id") % 32, F.lit(100)).cast("string"), 2, "0")
    mm = F.lpad((F.lit(1) + F.expr("(doc_id div 32) % 12")).cast("string"), 2, "0")
    return documents.select(
        F.concat(yy, mm, F.lit("/"), col("doc_id").cast("string"), F.lit(".pdf")).alias("member"),
        (F.instr(F.lower(col("text")), needle.lower()) > 0).alias("contains"), col("text"))


MEMBERS_SQL = """members as (select lpad(cast((91 + doc_id % 32) % 100 as varchar), 2, '0')
      || lpad(cast(1 + (doc_id // 32) % 12 as varchar), 2, '0') || '/' || cast(doc_id as varchar) || '.pdf' as member,
    strpos(lower(text), 'license') > 0 as contains from documents)"""
SHARE_SQL = """shares as (select cast(make_date(case when yy > 80 then 1900 + yy else 2000 + yy end, mm, 1) as timestamp) as date,
      count(*) as n, cast(sum(cast(contains as integer)) as double) / count(*) as share
    from (select cast(substr(member, 1, 2) as integer) as yy, cast(substr(member, 3, 2) as integer) as mm, contains
          from members) group by 1)"""


def clean_events(df: DataFrame, url_col: str, order, pattern: str) -> DataFrame:
    """De-duplicate by URL (first by ``order``, globally), keep URLs that
    match ``pattern``."""
    return dedup(df, url_col, order).filter(col(url_col).rlike(pattern))


def clean_trips(df: DataFrame, start: str = "start_station_id", end: str = "end_station_id",
                member: str = "member_casual") -> DataFrame:
    """Station ids through ``int(float(x))`` or -1, rows with a bad station
    dropped, boolean ``is_member`` in place of ``member_casual``."""
    d = df.withColumns({start: safe_int(col(start)), end: safe_int(col(end))})
    d = d.filter((col(start) != -1) & (col(end) != -1))
    return d.withColumn("is_member", col(member) == "member").drop(member)


def tip_by_passengers(df: DataFrame, passengers: str = "passenger_count", tip: str = "tip_amount") -> DataFrame:
    """Mean tip by passenger count."""
    return mean_by(df, passengers, tip, scale=2, name="mean_tip")


def register(reg) -> None:
    from sparklab.plans.tpch_sql import with_duckdb_ctes
    from sparklab.tables import Tables

    ctes = {"members": MEMBERS_SQL, "shares": SHARE_SQL}

    def shares(s, d):
        return pattern_share_over_time(documents_as_members(Tables.of(s, d).documents))

    reg.add("pattern_share", shares, with_duckdb_ctes("select date, n, share from shares", ctes))
    reg.add("pattern_share_extremes", lambda s, d: pattern_share_extremes(shares(s, d)), with_duckdb_ctes("""
select (select date from shares order by share, date limit 1) as argmin_key,
       (select date from shares order by share desc, date limit 1) as argmax_key,
       (select min(date) from shares where share <> 0) as first_nonzero_key""", ctes))
    reg.add("clean_events",
            lambda s, d: clean_events(Tables.of(s, d).pages, "url", "page_id", "blog|spam").select("page_id", "url"),
            """select page_id, url from (select *, row_number() over (partition by url order by page_id) as rn from pages)
               where rn = 1 and regexp_matches(url, 'blog|spam')""")
