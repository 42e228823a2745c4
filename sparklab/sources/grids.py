"""Grid sources: grid tables stored as Parquet partitioned by a coarse time
key, so a time slice prunes folders (S11, S12)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.functions.dates import ts_lit


def read_grid(spark: SparkSession, path: str, variables=None, time=None, dims=None, time_col: str = "time") -> DataFrame:
    """Grid scan with variable selection and an inclusive time range (S11). A
    ``year`` folder level is pruned by the years of the range."""
    df = spark.read.option("basePath", path).parquet(path)
    if time is not None:
        lo, hi = time
        df = df.filter(F.col(time_col).between(ts_lit(lo), ts_lit(hi)))
        if "year" in df.columns and time_col != "year":
            df = df.filter(F.col("year").between(int(str(lo)[:4]), int(str(hi)[:4])))
    if variables is not None:
        keep = [c for c in df.columns if c not in set(_all_vars(df, dims, time_col))] if dims is None else \
            [time_col, *dims]
        df = df.select(*dict.fromkeys(keep + list(variables)))
    return df


def _all_vars(df, dims, time_col):
    numeric = {"double", "float"}
    return [f.name for f in df.schema.fields if f.dataType.typeName() in numeric and f.name != time_col]


def read_grid_files(spark: SparkSession, paths, time_col: str = "time") -> DataFrame:
    """Several grid files concatenated along time (S12); variables missing
    in a file become NULL."""
    dfs = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
