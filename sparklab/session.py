"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants: UTC, ANSI (Spark 4 default), AQE with
# skew-join splitting and partition coalescing, no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sparklab", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one for local runs and tests.

    On a cluster the session is normally created by the launcher; then only
    the SQL settings above are applied and ``spark.checkpoint.dir`` is left
    as the cluster names it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        b = SparkSession.builder.appName(app_name)
        if master:
            b = b.master(master)
        elif not os.environ.get("SPARK_MASTER") and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
            b = b.master("local[*]")
        b = b.config("spark.driver.memory", os.environ.get("SPARKLAB_DRIVER_MEMORY", "16g"))
        for k, v in BASE_CONF.items():
            b = b.config(k, v)
        for k, v in (extra or {}).items():
            b = b.config(k, v)
        spark = b.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests) a fresh
    folder is made; on a cluster a machine-local folder would lose data, so a
    missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master is {master})")
        path = tempfile.mkdtemp(prefix="sparklab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder (reliable, survives
    executor loss) and return a DataFrame reading from it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sizing_conf(input_bytes: int, total_cores: int, shuffle_ratio: float = 1.0,
                target_partition_bytes: int = 256 << 20, max_split_bytes: int = 512 << 20) -> dict:
    """Partition sizing for a job reading ``input_bytes`` on ``total_cores``.

    * scan splits of at most ``max_split_bytes`` (``maxPartitionBytes``);
    * initial shuffle partitions so that ``shuffle_ratio * input_bytes`` gives
      about ``target_partition_bytes`` per partition, at least two waves of
      tasks; AQE coalesces small ones and splits skewed ones at run time;
    * the advisory size AQE coalesces and splits towards.

    E.g. 100 TB on 1000 executors x 8 cores -> ~400k initial shuffle
    partitions of ~256 MB, coalesced by AQE when a stage's data shrinks.
    """
    import math

    shuffle_bytes = max(1.0, input_bytes * shuffle_ratio)
    parts = max(2 * total_cores, math.ceil(shuffle_bytes / target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_sizing(spark: SparkSession, input_bytes: int, total_cores: int | None = None, **kw) -> dict:
    """Set :func:`sizing_conf` on a running session (all are runtime SQL settings)."""
    cores = total_cores or spark.sparkContext.defaultParallelism
    conf = sizing_conf(input_bytes, cores, **kw)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
