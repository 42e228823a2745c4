"""Sources and sinks on files the tests write themselves."""

import io
import os
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from sparklab import sinks, sources
from sparklab.operators.workflows import clean_trips, pattern_share_over_time, pattern_share_extremes


def test_zip_csv_with_bad_archive(spark, tmpdir_path):
    with zipfile.ZipFile(os.path.join(tmpdir_path, "a.csv.zip"), "w") as zf:
        zf.writestr("a.csv", "ride_id,start_station_id,end_station_id,member_casual\n1,12.0,3,member\n2,abc,4,casual\n")
        zf.writestr("b.csv", "ride_id,start_station_id,end_station_id,member_casual\n3,7,8.0,casual\n")
    df = sources.read_zip_csv(spark, tmpdir_path + "/*.zip",
                              "ride_id BIGINT, start_station_id STRING, end_station_id STRING, member_casual STRING")
    out = sorted(tuple(r) for r in clean_trips(df).collect())
    assert out == [(1, 12, 3, True), (3, 7, 8, False)]
    with open(os.path.join(tmpdir_path, "broken.csv.zip"), "wb") as fh:
        fh.write(b"not a zip")
    with pytest.raises(Exception, match="broken.csv.zip"):  # named, not dropped unseen
        sources.read_zip_csv(spark, tmpdir_path + "/*.zip", "ride_id BIGINT").count()


def test_scan_archives_reports_broken(spark, tmpdir_path):
    def tar(path, members):
        with tarfile.open(path, "w") as tf:
            for name, body in members:
                info = tarfile.TarInfo(name)
                info.size = len(body)
                tf.addfile(info, io.BytesIO(body))
    tar(os.path.join(tmpdir_path, "1.tar"), [("9107/a.pdf", b"uses MatPlotLib"), ("9107/b.txt", b"matplotlib"),
                                             ("9108/c.pdf", b"nothing")])
    tar(os.path.join(tmpdir_path, "2.tar"), [("0506/d.pdf", b"matplotlib!"), ("0506/e.pdf", b"no")])
    with open(os.path.join(tmpdir_path, "3.tar"), "wb") as fh:
        fh.write(b"garbage")
    found = sources.scan_archives(spark, tmpdir_path + "/*.tar", ".pdf", b"matplotlib")
    assert found.filter("error IS NULL").count() == 4
    broken = found.filter("error IS NOT NULL").collect()
    assert [r.archive.rsplit("/", 1)[1] for r in broken] == ["3.tar"] and broken[0].member is None
    shares = {r.date.strftime("%Y-%m"): r.share for r in pattern_share_over_time(found).collect()}
    assert shares == {"1991-07": 1.0, "1991-08": 0.0, "2005-06": 0.5}
    ex = pattern_share_extremes(pattern_share_over_time(found)).first()
    assert ex.argmin_key.strftime("%Y-%m") == "1991-08" and ex.first_nonzero_key.strftime("%Y-%m") == "1991-07"
    assert sources.file_bytes(spark, tmpdir_path + "/*.tar").count() == 3


def test_archives_are_packed_and_read_without_copies(spark, monkeypatch):
    """Several archives of a task come back whole; reading one takes little memory beside it."""
    import tracemalloc

    import pyarrow as pa
    from pyspark import TaskContext

    from sparklab.operators.io_roundtrip import pack_archives
    from sparklab.sources import files

    df = spark.range(900).selectExpr("concat('9107/', id, '.pdf') AS name", "concat(repeat('x', 2000), if(id % 3 = 0, ' License', '')) AS body")
    for target in (100_000, 64 << 20):
        archives = pack_archives(df.repartition(2), "tar", "name", "body", target)
        assert archives.count() == (18 if target < 1 << 20 else 2)
        found = sources.scan_archives(spark, archives, ".pdf", b"license").collect()
        assert {r.member for r in found} == {f"9107/{i}.pdf" for i in range(900)} and sum(r.contains for r in found) == 300

    class Rows:  # the functions that run in tasks
        select = lambda self, *_: self
        mapInArrow = lambda self, fn, _: fn

    class Task:
        partitionId = lambda self: 0

    monkeypatch.setattr(TaskContext, "get", Task)
    monkeypatch.setattr(files, "_archives", lambda *_: Rows())
    batch = pa.RecordBatch.from_pydict({"name": [f"9107/{i}.pdf" for i in range(4000)], "body": ["x" * 2000] * 4000})
    packed = list(pack_archives(Rows(), "tar", "name", "body")(iter([batch])))
    size = packed[0]["content"].nbytes
    tracemalloc.start()
    assert sum(b.num_rows for b in files.scan_archives(None, None)(iter(packed))) == 4000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert size > 8_000_000 and peak < size / 4  # a copy, and a list of members, came to more than the archive


def test_dirty_tsv(spark, tmpdir_path):
    lines = ["1\tu1\t2.5\thttp://a", "2\tu2\t3.5#\thttp://b", "3\tu3\t1.0\thttp://c\textra", "x\tu4\t#\thttp://d"]
    with open(os.path.join(tmpdir_path, "e.tsv"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    df = sources.read_dirty_tsv(spark, tmpdir_path + "/e.tsv",
                                {"id": "bigint", "name": "string", "v": "double", "url": "string"})
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(
        [(1, "u1", 2.5, "http://a"), (2, "u2", 3.5, "http://b"), (None, "u4", None, "http://d")], key=str)


def test_csv_typed_and_projection(spark, tmpdir_path):
    with open(os.path.join(tmpdir_path, "t.csv"), "w") as fh:
        fh.write("passenger_count,tip_amount,x\n1,2.5,a\n1,0.5,b\n2,,c\n")
    df = sources.read_csv(spark, tmpdir_path + "/t.csv", "passenger_count SHORT, tip_amount DOUBLE, x STRING",
                          columns=["passenger_count", "tip_amount"])
    assert df.columns == ["passenger_count", "tip_amount"]
    assert df.filter(F.col("tip_amount").isNull()).count() == 1


def test_hive_partition_pruning(spark, tmpdir_path):
    df = spark.range(100).select((F.col("id") % 3 + 2020).alias("year"), (F.col("id") % 4 + 1).alias("quarter"), "id")
    sinks.write_table(df, tmpdir_path + "/h", partition_by=["year", "quarter"])
    h = sources.read_hive(spark, tmpdir_path + "/h").filter(F.col("year") == 2021)
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2021" in plan
    assert h.count() == len([i for i in range(100) if i % 3 == 1])


def test_write_sized_and_codecs(spark, tmpdir_path):
    df = spark.range(200000).select("id", (F.col("id") * 3).alias("x"))
    sinks.write_sized(df, tmpdir_path + "/s", target_bytes=200_000)
    files = [f for f in os.listdir(tmpdir_path + "/s") if f.endswith(".parquet")]
    assert len(files) >= 5
    assert spark.read.parquet(tmpdir_path + "/s").count() == 200000
    for codec in ["snappy", "zstd", "gzip", "none"]:
        sinks.write_table(df.limit(10), f"{tmpdir_path}/c_{codec}", codec=codec)
        assert spark.read.parquet(f"{tmpdir_path}/c_{codec}").count() == 10


def test_single_file_and_sample_files(spark, tmpdir_path):
    df = spark.range(1000)
    sinks.write_table(df, tmpdir_path + "/one", single_file=True)
    assert len([f for f in os.listdir(tmpdir_path + "/one") if f.endswith(".parquet")]) == 1
    sinks.write_table(df.repartition(10), tmpdir_path + "/many")
    s1 = sources.sample_files(spark, tmpdir_path + "/many", 0.3, seed=1)
    s2 = sources.sample_files(spark, tmpdir_path + "/many", 0.3, seed=1)
    assert len(s1.inputFiles()) == 3 and sorted(s1.inputFiles()) == sorted(s2.inputFiles())


def test_discard_runs_plan(spark):
    sinks.discard(spark.range(1000).select((F.col("id") * 2).alias("x")))


def test_write_grid_blocks(spark, tmpdir_path):
    from sparklab.sources.synthetic import random_grid

    g = random_grid(spark, (6, 8), seed=1)
    sinks.write_grid(g, tmpdir_path + "/g", {"d0": 3, "d1": 4}, partition_dim="block_d0")
    back = spark.read.parquet(tmpdir_path + "/g")
    assert back.count() == 48
    assert abs(back.agg(F.sum("value")).first()[0] - g.agg(F.sum("value")).first()[0]) < 1e-9


def test_synthetic_generators(spark):
    from sparklab.sources.synthetic import random_grid, timeseries, timeseries_of_size

    ts = timeseries(spark, "2000-01-01", "2000-01-01T01:00:00", 1.0, seed=2)
    assert ts.count() == 3600 and ts.columns == ["timestamp", "name", "id", "x", "y"]
    assert ts.collect() == timeseries(spark, "2000-01-01", "2000-01-01T01:00:00", 1.0, seed=2).collect()
    assert timeseries_of_size(spark, 40 * 1000).count() == 40 * 1000 // 48
    g = random_grid(spark, (4, 5, 6), compressible=True)
    assert g.count() == 120 and g.filter(F.col("value") == 0).count() >= 60


def test_read_query_and_warehouse(spark):
    sinks.write_warehouse(spark.range(10), "wh_test_tbl")
    assert sources.read_query(spark, "select sum(id) as s from wh_test_tbl").first().s == 45


def test_timeseries_freq_strings(spark):
    from sparklab.sources.synthetic import parse_freq, timeseries

    assert parse_freq("600ms") == 0.6 and parse_freq("12h") == 43200 and parse_freq("1d") == 86400
    ts = timeseries(spark, "2000-01-01", "2000-01-03", "1min", partition_freq="12h")
    assert ts.count() == 2 * 24 * 60 and ts.rdd.getNumPartitions() == 4


def test_tables_prefer_real_columns_and_partsupp(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from sparklab.tables import Tables
    from tests.conftest import SF0001

    li = spark.read.parquet(f"{SF0001}/lineitem.parquet").withColumn("l_shipmode", F.lit("RAIL"))
    li.write.parquet(tmpdir_path + "/lineitem.parquet")
    spark.createDataFrame([(1, 2, 5, 1.5)], "ps_partkey long, ps_suppkey long, ps_availqty int, ps_supplycost double") \
        .write.parquet(tmpdir_path + "/partsupp.parquet")
    t = Tables(spark, tmpdir_path)
    assert {r.l_shipmode for r in t.lineitem.select("l_shipmode").distinct().collect()} == {"RAIL"}
    assert "l_commitdate" in t.lineitem.columns
    assert t.partsupp.count() == 1
