"""Registered round trips for the sources and sinks: a table derived from
the fixtures is written by a sink into a fresh folder under the shared
checkpoint folder, read back by the matching source, and aggregated. The
oracle computes the same aggregate from the original table.

Archives (zip, tar) are produced on the executors as rows (path, content) and
written by Spark, so they reach any file system and a retried task leaves
nothing behind.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab import sinks, sources
from sparklab.operators.relational import first_per_group
from sparklab.operators.workflows import (
    MEMBERS_SQL, SHARE_SQL, clean_trips, documents_as_members, pattern_share_over_time, tip_by_passengers,
)
from sparklab.session import cut_lineage
from sparklab.tables import Tables

col = F.col


def pack_archives(df: DataFrame, kind: str, name_col: str, body_col: str, target_bytes: int = 64 << 20) -> DataFrame:
    """Zip or tar archives of ``(name, body)`` members as rows (path, content).

    A task starts a new archive when the members passed ``target_bytes``, so
    the number of archives follows the data and none nears the row limit."""
    def pack(batches):
        import io
        import tarfile
        import zipfile

        import pyarrow as pa
        from pyspark import TaskContext

        pid, number, size, buffer, archive = TaskContext.get().partitionId(), 0, 0, None, None

        def done():
            archive.close()
            data = pa.py_buffer(buffer.getbuffer())  # the archive itself, not a copy
            content = pa.Array.from_buffers(pa.binary(), 1, [None, pa.array([0, data.size], pa.int32()).buffers()[1], data])
            return pa.RecordBatch.from_arrays([pa.array([f"part-{pid:05d}-{number:04d}.{kind}"], pa.string()), content], ["path", "content"])

        for batch in batches:  # members are streamed into the archive, some at a time
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                for name, body in zip(part[name_col].to_pylist(), part[body_col].to_pylist(), strict=True):
                    data = body.encode("utf-8") if isinstance(body, str) else body
                    if archive is None:
                        buffer = io.BytesIO()
                        archive = zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) if kind == "zip" else tarfile.open(fileobj=buffer, mode="w")
                    if kind == "zip":
                        archive.writestr(name, data)
                    else:
                        info = tarfile.TarInfo(name)
                        info.size = len(data)
                        archive.addfile(info, io.BytesIO(data))
                        archive.members = []  # headers are written: no list of them
                    size += len(data)
                    if size >= target_bytes:
                        yield done()
                        number, size, buffer, archive = number + 1, 0, None, None
        if archive is not None:
            yield done()

    return df.select(name_col, body_col).mapInArrow(pack, "path string, content binary")


def _scratch(spark, tag):
    return sinks.scratch_path(spark, tag)


# ------------------------------------------------------------------ queries
def parquet_roundtrip(spark: SparkSession, sf_dir: str, codec: str = "zstd") -> DataFrame:
    path = _scratch(spark, "parquet")
    sinks.write_table(Tables.of(spark, sf_dir).raw("lineitem"), path, codec=codec)
    li = sources.read_table(spark, path, columns=["l_returnflag", "l_quantity", "l_orderkey"])
    return li.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("sum_qty"), F.count(F.lit(1)).alias("n"),
                                          F.sum("l_orderkey").alias("sum_orderkey"))


def sized_roundtrip(spark, sf_dir):
    path = _scratch(spark, "sized")
    sinks.write_sized(Tables.of(spark, sf_dir).raw("lineitem"), path, target_bytes=256 * 1024)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("sum_qty"))


def hive_first(spark, sf_dir):
    path = _scratch(spark, "hive")
    o = Tables.of(spark, sf_dir).raw("orders").withColumns(
        {"year": F.year("o_orderdate"), "quarter": F.quarter("o_orderdate")})
    sinks.write_table(o, path, partition_by=["year", "quarter"])
    h = sources.read_hive(spark, path)
    return first_per_group(h, ["year", "quarter"], ["o_orderdate", "o_orderkey"],
                           ["o_orderkey", "o_orderdate", "o_totalprice"])


def csv_mean_tip(spark, sf_dir):
    path = _scratch(spark, "csv")
    ev = Tables.of(spark, sf_dir).events.select((col("user_id") % 6).cast("int").alias("passenger_count"),
                                              col("value").alias("tip_amount"), "event_type")
    ev.write.option("header", True).csv(path)
    df = sources.read_csv(spark, path, "passenger_count INT, tip_amount DOUBLE, event_type STRING")
    return tip_by_passengers(df)


DIRTY_SCHEMA = {"event_id": "bigint", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


def dirty_tsv(spark, sf_dir):
    """Events written as headerless TSV where every 13th value carries a '#'
    and every 29th line has an extra field; read back with S6."""
    path = _scratch(spark, "tsv")
    e = Tables.of(spark, sf_dir).events
    val = F.when(col("event_id") % 13 == 0, F.concat(col("value").cast("string"), F.lit("#"))).otherwise(
        col("value").cast("string"))
    fields = [col("event_id").cast("string"), col("user_id").cast("string"), col("event_type"), val, col("props")]
    line = F.when(col("event_id") % 29 == 0, F.concat_ws("\t", *fields, F.lit("extra"))).otherwise(F.concat_ws("\t", *fields))
    e.select(line.alias("value")).write.text(path)
    df = sources.read_dirty_tsv(spark, path, DIRTY_SCHEMA)
    return df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                        F.sum(col("value").cast("decimal(18,2)")).cast("double").alias("sum_value"))


def zip_trips(spark, sf_dir):
    """Events as zipped CSV trips (S7) cleaned by X4."""
    folder = _scratch(spark, "zip")
    e = Tables.of(spark, sf_dir).events
    sid = F.when(col("event_id") % 23 == 0, F.lit("bad")).otherwise(
        F.concat((col("user_id") % 40).cast("string"), F.lit(".0")))
    eid = F.concat((col("event_id") % 57).cast("string"), F.lit(".0"))
    member = F.when(col("value") > 100, F.lit("member")).otherwise(F.lit("casual"))
    csv_line = F.concat_ws(",", col("event_id").cast("string"), sid, eid, member)
    # one member per 2000-row block: header + lines, packed on the executors
    blocks = (e.select(F.expr("event_id div 2000").alias("_b"), col("event_id"), csv_line.alias("_l"))
              .groupBy("_b").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "_l"))),
                                                         lambda x: x["_l"]), "\n").alias("_body"))
              .select(F.concat(F.lit("trips-"), col("_b").cast("string"), F.lit(".csv")).alias("name"),
                      F.concat(F.lit("ride_id,start_station_id,end_station_id,member_casual\n"), col("_body")).alias("body")))
    sinks.write_table(pack_archives(blocks, "zip", "name", "body"), folder)
    trips = sources.read_zip_csv(spark, spark.read.parquet(folder),
                                 "ride_id BIGINT, start_station_id STRING, end_station_id STRING, member_casual STRING")
    clean = clean_trips(trips)
    return clean.groupBy("is_member").agg(F.count(F.lit(1)).alias("n"), F.sum("start_station_id").alias("sum_start"),
                                          F.sum("end_station_id").alias("sum_end"))


def archive_share(spark, sf_dir):
    """Documents packed into tar archives, scanned for 'license' (S8, X1)."""
    folder = _scratch(spark, "tar")
    m = documents_as_members(Tables.of(spark, sf_dir).documents)
    sinks.write_table(pack_archives(m, "tar", "member", "text"), folder)
    found = sources.scan_archives(spark, spark.read.parquet(folder), ".pdf", b"license")
    return pattern_share_over_time(found)


def file_bytes_total(spark, sf_dir):
    path = _scratch(spark, "bytes")
    Tables.of(spark, sf_dir).pages.select("html").write.text(path)
    return sources.file_bytes(spark, path + "/*.txt").agg(F.sum("length").alias("total_bytes"))


def grid_roundtrip(spark, sf_dir):
    from sparklab.operators.climate import ship_grid

    path = _scratch(spark, "grid")
    g = ship_grid(Tables.of(spark, sf_dir).raw("lineitem")).withColumn("year", F.year("time"))
    sinks.write_grid(g, path, {"latitude": 1, "longitude": 2}, sort_by="time", partition_dim="year")
    r = sources.read_grid(spark, path, variables=["value"], time=("1996-01-01", "1997-12-31"),
                          dims=["latitude", "longitude"])
    return r.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def grid_files(spark, sf_dir):
    from sparklab.operators.climate import ship_grid

    g = ship_grid(Tables.of(spark, sf_dir).raw("lineitem"))
    p1, p2 = _scratch(spark, "gf1"), _scratch(spark, "gf2")
    sinks.write_table(g.filter(F.year("time") < 1998), p1)
    sinks.write_table(g.filter(F.year("time") >= 1998).withColumn("extra", col("value") * 2), p2)
    r = sources.read_grid_files(spark, [p1, p2])
    return r.agg(F.count(F.lit(1)).alias("n"), F.count("extra").alias("n_extra"), F.sum("value").alias("total"))


def warehouse_roundtrip(spark, sf_dir):
    table = f"runs_{uuid.uuid4().hex[:12]}"
    e = Tables.of(spark, sf_dir).events.select("event_id", "event_type", "value")
    sinks.write_warehouse(e, table, target_bytes=64 << 20)
    q = f"select event_type, count(*) as n, avg(cast(value > 100 as int)) as share from {table} group by event_type"
    try:  # the table goes again: its few result rows are kept
        return cut_lineage(sources.read_query(spark, q))
    finally:
        spark.sql(f"drop table if exists {table}")


def lookup_single_file(spark, sf_dir):
    path = _scratch(spark, "lookup")
    sinks.write_table(Tables.of(spark, sf_dir).nation, path, single_file=True)
    return spark.read.parquet(path)


def lookup_csv(spark, sf_dir):
    """Rides joined to a zone lookup read from CSV (S10): three of its columns, and one mapped from them."""
    from sparklab.operators.features import REGION_MAPPING, zone_lookup

    t, path = Tables.of(spark, sf_dir), _scratch(spark, "zones")
    zones = t.nation.join(F.broadcast(t.region), col("n_regionkey") == col("r_regionkey")).select(
        col("n_nationkey").alias("LocationID"), col("r_name").alias("Borough"), col("n_name").alias("Zone"), F.lit("-").alias("service_zone"))
    zones.write.option("header", True).csv(path)
    z = sources.read_csv(spark, path, "LocationID INT, Borough STRING, Zone STRING, service_zone STRING")
    z = zone_lookup(z, REGION_MAPPING)
    e = t.events.select((col("user_id") % 30).cast("int").alias("LocationID"), "value")
    return e.join(z, "LocationID", "left").groupBy("Borough", "Superborough").agg(
        F.count(F.lit(1)).alias("n"), F.sum(col("value").cast("decimal(18,2)")).cast("double").alias("sum_value"))


def file_sample(spark, sf_dir):
    """All orders in key folders; a quarter of the folders, chosen by their names, is read again."""
    path = _scratch(spark, "folders")
    o = Tables.of(spark, sf_dir).raw("orders")
    o.withColumn("bucket", col("o_custkey") % 64).repartition(8, "bucket").write.partitionBy("bucket").parquet(path)
    r = sources.sample_files(spark, path, 0.25, seed=7, folders=True)
    return r.groupBy(col("bucket").cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


def register(reg) -> None:
    from sparklab.plans.tpch_sql import with_duckdb_ctes

    reg.add("parquet_roundtrip", parquet_roundtrip, """
select l_returnflag, sum(l_quantity) as sum_qty, count(*) as n, cast(sum(l_orderkey) as bigint) as sum_orderkey
from lineitem group by l_returnflag""")
    reg.add("sized_write", sized_roundtrip, "select count(*) as n, sum(l_quantity) as sum_qty from lineitem")
    reg.add("hive_first", hive_first, """
select year, quarter, o_orderkey, o_orderdate, o_totalprice from (
  select cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter, *,
         row_number() over (partition by year(o_orderdate), quarter(o_orderdate) order by o_orderdate, o_orderkey) as rn
  from orders) where rn = 1""")
    reg.add("csv_mean_tip", csv_mean_tip, """
select cast(user_id % 6 as integer) as passenger_count,
       cast(sum(cast(value as decimal(18,2))) as double) / count(value) as mean_tip from events group by 1""")
    reg.add("dirty_tsv", dirty_tsv, """
select event_type, count(*) as n, cast(sum(cast(value as decimal(18,2))) as double) as sum_value
from events where event_id % 29 <> 0 group by event_type""")
    reg.add("zip_trips", zip_trips, """
select value > 100 as is_member, count(*) as n, cast(sum(user_id % 40) as bigint) as sum_start,
       cast(sum(event_id % 57) as bigint) as sum_end
from events where event_id % 23 <> 0 group by 1""")
    reg.add("archive_share", archive_share,
            with_duckdb_ctes("select date, n, share from shares", {"members": MEMBERS_SQL, "shares": SHARE_SQL}))
    reg.add("file_bytes", file_bytes_total, "select cast(sum(strlen(html) + 1) as bigint) as total_bytes from pages")
    reg.add("grid_roundtrip", grid_roundtrip, with_duckdb_ctes("""
select latitude, longitude, count(*) as n, sum(value) as total from sg
where time between timestamp '1996-01-01' and timestamp '1997-12-31' group by 1, 2""", {"sg": _ship_sql()}))
    reg.add("grid_files", grid_files, with_duckdb_ctes("""
select count(*) as n, count(case when year(time) >= 1998 then 1 end) as n_extra, sum(value) as total from sg""",
                                                       {"sg": _ship_sql()}))
    reg.add("warehouse_roundtrip", warehouse_roundtrip, """
select event_type, count(*) as n, avg(cast(value > 100 as integer)) as share from events group by event_type""")
    reg.add("lookup_csv", lookup_csv, """
with z as (select n_nationkey as k, r_name as Borough, case r_name when 'AFRICA' then 'Superborough 1' when 'AMERICA' then 'Superborough 1'
    when 'ASIA' then 'Superborough 2' when 'EUROPE' then 'Superborough 2' when 'MIDDLE EAST' then 'Superborough 3' else r_name end as Superborough
  from nation join region on n_regionkey = r_regionkey)
select Borough, Superborough, count(*) as n, cast(sum(cast(value as decimal(18,2))) as double) as sum_value
from events left join z on user_id % 30 = k group by 1, 2""")
    reg.add("file_sample", file_sample, """
select o_custkey % 64 as bucket, count(*) as n, cast(sum(o_orderkey) as bigint) as keys from orders
where cast('0x' || substr(md5('bucket=' || cast(o_custkey % 64 as varchar) || '-7'), 1, 8) as bigint) % 10000 < 2500 group by 1""")
    reg.add("lookup_single_file", lookup_single_file, "select * from nation")


def _ship_sql():
    from sparklab.operators.climate import SHIP_GRID_SQL
    return SHIP_GRID_SQL
