"""Wide tables: 100 float columns written and read back (K1), and the
rename / replace / fill / cast / label-slice chain over 120 mixed columns (C1)."""

from pyspark.sql import functions as F

from sparklab import sinks
from sparklab.operators.relational import clean_wide
from sparklab.sources.synthetic import timeseries


def test_write_wide_parquet(spark, tmpdir_path):
    df = timeseries(spark, "2000-01-01", "2000-01-01T00:30:00", 1.0, dtypes={str(i): "float" for i in range(100)})
    sinks.write_table(df, tmpdir_path + "/wide", codec="zstd")
    back = spark.read.parquet(tmpdir_path + "/wide")
    assert len(back.columns) == 101 and back.count() == 1800
    assert abs(back.agg(F.sum("57")).first()[0] - df.agg(F.sum("57")).first()[0]) < 1e-9


def test_cow_chain_on_mixed_columns(spark):
    dtypes = {**{str(i): "float" for i in range(40)}, **{str(i): "int" for i in range(41, 80)},
              **{str(i): "str" for i in range(81, 120)}}
    df = timeseries(spark, "2000-01-01", "2000-01-01T00:10:00", 1.0, dtypes=dtypes, seed=7)
    df = df.withColumn("12", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("12")) if "id" in df.columns
                       else F.when(F.rand(1) < 0.3, F.lit(None)).otherwise(F.col("12")))
    out = clean_wide(df, rename={"1": "1000"}, replace={"Alice": "xxx"}, fill={str(i): 100.0 for i in range(10, 40)},
                     cast={"50": "double"}, keep=("2", "99"))
    cols = out.columns
    assert cols[0] == "2" and cols[-1] == "99" and "1000" not in cols and "timestamp" not in cols
    assert out.filter(F.col("12").isNull()).count() == 0
    assert dict(out.dtypes)["50"] == "double"
    assert out.filter(F.col("85") == "Alice").count() == 0
