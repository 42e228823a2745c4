"""Query sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_query(spark: SparkSession, query: str, url: str | None = None, properties: dict | None = None,
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None) -> DataFrame:
    """Result of a query against a warehouse (S14). With ``url`` the query is
    pushed to the database through JDBC (``query`` as a derived table, split
    into ``num_partitions`` ranges of ``partition_column``); without one it
    runs on Spark's own catalog tables."""
    if url is None:
        return spark.sql(query)
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    return r.load()
