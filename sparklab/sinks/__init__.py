"""Sinks: Parquet (codecs, size-targeted files, single file for bounded
lookups), warehouse tables, grids laid out in blocks, and a discard sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.session import checkpoint_dir

col = F.col
CODECS = ("snappy", "lz4", "zstd", "gzip", "brotli", "none", "uncompressed")


def scratch_path(spark, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, path: str, codec: str = "snappy", mode: str = "overwrite", partition_by=None,
                single_file: bool = False, max_records_per_file: int | None = None) -> str:
    """Write Parquet (K1, K8). ``single_file`` coalesces to one task and is
    meant for bounded lookup tables only."""
    if codec not in CODECS:
        raise ValueError(f"codec {codec!r} not in {CODECS}")
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).option("compression", codec)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def _dir_bytes(spark, path: str) -> int:
    """Total size of the files under ``path`` (Hadoop FS metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def write_sized(df: DataFrame, path: str, target_bytes: int, codec: str = "snappy", sample_rows: int = 10000) -> str:
    """Write Parquet files of about ``target_bytes`` (K2): a sample of
    ``sample_rows`` is written once to a scratch folder to measure the bytes
    per row; ``maxRecordsPerFile`` is set from it."""
    spark = df.sparkSession
    probe = scratch_path(spark, "probe")
    sample = df.limit(sample_rows)
    write_table(sample, probe, codec=codec, single_file=True)
    rows = spark.read.parquet(probe).count()
    per_row = max(1.0, _dir_bytes(spark, probe) / max(rows, 1))
    return write_table(df, path, codec=codec, max_records_per_file=max(1, int(target_bytes / per_row)))


def write_warehouse(df: DataFrame, table: str, mode: str = "overwrite", url: str | None = None,
                    properties: dict | None = None, target_bytes: int | None = None) -> None:
    """Write to a warehouse table (K10): JDBC when ``url`` is given, else a
    catalog table. With ``target_bytes`` the rows are re-balanced first so
    write tasks are even."""
    if target_bytes:
        from sparklab.operators.relational import repartition_to_size

        df = repartition_to_size(df, target_bytes)
    if url is None:
        df.write.mode(mode).saveAsTable(table)
    else:
        w = df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table)
        for k, v in (properties or {}).items():
            w = w.option(k, v)
        w.save()


def discard(df: DataFrame) -> None:
    """Run the whole plan and drop the rows (K11): the ``noop`` sink."""
    df.write.format("noop").mode("overwrite").save()


def write_grid(df: DataFrame, path: str, block: dict, sort_by=None, partition_dim: str | None = None,
               codec: str = "zstd") -> str:
    """Write a grid in blocks (K12, G15): ``block_<dim> = dim div size``; rows
    are range-partitioned on the block ids so each output file holds whole
    blocks, sorted inside by ``sort_by`` (e.g. time for a pencil layout).
    ``partition_dim`` (a block column) becomes the folder level."""
    bcols = {f"block_{d}": F.floor(col(d) / F.lit(n)).cast("long") for d, n in block.items()}
    # the folder column leads the range key, so a task writes few folders
    folder = [partition_dim] if partition_dim else []
    out = df.withColumns(bcols).repartitionByRange(*folder, *bcols.keys())
    order = folder + list(bcols.keys()) + ([sort_by] if isinstance(sort_by, str) else list(sort_by or []))
    out = out.sortWithinPartitions(*order)
    return write_table(out, path, codec=codec, partition_by=partition_dim)
