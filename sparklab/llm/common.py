"""Helpers shared by the operators: row ids, tables in the shared folder, components."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: lineage is
    cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._kept_path = path
    return kept


def release(df: DataFrame) -> None:
    """Delete a table that ``keep`` wrote, once all that was derived from it is kept too."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._kept_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, underscored until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _scan_only(df: DataFrame) -> bool:
    """``df`` is a scan with nothing but projections and filters over it."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.children().isEmpty() and node.nodeName().startswith("LogicalRelation")


def with_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number for every row in the long column ``name``, the same however often it is evaluated.

    Rows of a Parquet scan are numbered by file name and the file's own row
    positions, so the numbers do not follow the splits, whose size changes with
    the cluster. Anything else is written to the shared folder once, numbered.
    """
    spark, meta = df.sparkSession, None
    if _scan_only(df):
        try:
            meta = df.metadataColumn("_metadata")
            files = df.select(meta["file_path"].alias("path"), meta["row_index"].alias("row")).groupBy("path").agg(
                (F.max("row") + 1).alias("n"), F.count("*").alias("rows")).collect()
            if any(f["rows"] > f["n"] for f in files):  # a file that is read twice: its rows are rows of their own
                meta = None
        except AnalysisException:  # no Parquet files
            meta = None
    if meta is None:
        return keep(df.withColumn(name, F.monotonically_increasing_id()))
    base, start = [], 0
    for f in sorted(files, key=lambda f: f["path"]):
        base.append((f["path"], start))
        start += f["n"]
    path, first, row = (free_name(df, c) for c in ("_path", "_first", "_row_index"))
    base = F.broadcast(spark.createDataFrame(base, f"{path} string, {first} long"))
    own = f"{path}_of"
    d = df.select("*", meta["file_path"].alias(own), meta["row_index"].alias(row)).join(base, F.col(own) == F.col(path))
    return d.withColumn(name, F.col(first) + F.col(row)).drop(own, path, first, row)


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest id reachable over ``links(a, b)`` for each end of a link: (id, component).

    Alternating large-star and small-star steps, both grouped aggregates and
    joins; the links are rewritten to a table in the shared folder each round.
    Ids without a link are not in the result.
    """
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        # done when every node has one parent and no parent has one
        parents = edges.groupBy("a").agg(F.count("*").alias("n"))
        if parents.where("n > 1").isEmpty() and edges.join(parents.select(F.col("a").alias("b")), "b", "left_semi").isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        edges = keep(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
