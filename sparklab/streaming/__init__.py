"""Streaming.

The reference has no streaming workloads (no stream sources, watermarks,
event-time windows or late data), so nothing here is a claimed operator.
The row-wise operators - filters, projections, ``map_values``,
``clean_wide``, ``cast_all``, the dirty-field expressions - are plain column
expressions and apply unchanged to a streaming DataFrame; :func:`read_stream`
only opens a Parquet folder as a stream for that use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet folder as a stream (schema declared, as streams require)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)
