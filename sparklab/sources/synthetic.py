"""Synthetic inputs generated on the executors from ``spark.range`` (S15,
S16): deterministic per row (hash of the row index and seed), so any task
can be recomputed after an executor loss and give the same rows."""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

col = F.col

# Names drawn by the time-series generator.
NAMES = ["Alice", "Bob", "Charlie", "Dan", "Edith", "Frank", "George", "Hannah", "Ingrid", "Jerry",
         "Kevin", "Laura", "Michael", "Norbert", "Oliver", "Patricia", "Quinn", "Ray", "Sarah", "Tim",
         "Ursula", "Victor", "Wendy", "Xavier", "Yvonne", "Zelda"]


def _u01(seed_expr, salt: int):
    """Uniform [0, 1) from a 64-bit hash."""
    h = F.xxhash64(seed_expr, F.lit(salt))
    return (F.pmod(h, F.lit(1 << 52)).cast("double") / float(1 << 52))


_UNITS = {"ms": 0.001, "s": 1.0, "min": 60.0, "h": 3600.0, "d": 86400.0}


def parse_freq(freq) -> float:
    """'600ms', '1s', '10min', '1h', '12h', '1d' (or a number of seconds) -> seconds."""
    if isinstance(freq, (int, float)):
        return float(freq)
    import re

    m = re.fullmatch(r"\s*(\d*\.?\d*)\s*(ms|s|min|h|d)\s*", freq)
    if not m:
        raise ValueError(f"bad frequency {freq!r}")
    return float(m.group(1) or 1) * _UNITS[m.group(2)]


def timeseries(spark: SparkSession, start: str = "2000-01-01", end: str = "2000-01-31", freq_seconds=1.0,
               dtypes: dict | None = None, seed: int = 0, partitions: int | None = None,
               partition_freq=None) -> DataFrame:
    """Regular time series: ``timestamp`` plus columns by type.
    Default columns: name (str), id (int, ~Poisson(1000)-like), x, y (float
    in [-1, 1)). ``freq_seconds`` may be a string ('600ms', '1s', ...);
    ``partition_freq`` ('1d', '12h', ...) sets one input partition per span."""
    freq_seconds = parse_freq(freq_seconds)
    t0 = _dt.datetime.fromisoformat(start)
    t1 = _dt.datetime.fromisoformat(end)
    n = int((t1 - t0).total_seconds() / freq_seconds)
    if partition_freq is not None and partitions is None:
        partitions = max(1, math.ceil((t1 - t0).total_seconds() / parse_freq(partition_freq)))
    dtypes = dtypes or {"name": "str", "id": "int", "x": "float", "y": "float"}
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    cols = [(F.lit(t0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
             (col("id") * freq_seconds).cast("decimal(18,6)"))).alias("timestamp")]
    names = F.array(*[F.lit(x) for x in NAMES])
    for k, (name, t) in enumerate(dtypes.items()):
        u = _u01(col("id"), seed * 1000 + k)
        if t in ("str", "string", "object"):
            cols.append(F.element_at(names, (F.floor(u * len(NAMES)) + 1).cast("int")).alias(str(name)))
        elif t in ("int", "long"):
            cols.append((F.lit(1000) + F.floor((u - 0.5) * 60)).cast("int").alias(str(name)))
        else:
            cols.append((u * 2 - 1).alias(str(name)))
    return base.select(*cols)


def timeseries_of_size(spark: SparkSession, target_bytes: int, dtypes: dict | None = None, start: str = "2000-01-01",
                       freq_seconds: float = 1.0, seed: int = 0) -> DataFrame:
    """A time series whose in-memory size is about ``target_bytes``: rows =
    bytes / estimated row width (8 bytes per number, 16 per string, 8 for
    the timestamp)."""
    dtypes = dtypes or {"name": "str", "id": "int", "x": "float", "y": "float"}
    width = 8 + sum(16 if t in ("str", "string", "object") else 8 for t in dtypes.values())
    n = max(1, target_bytes // width)
    t0 = _dt.datetime.fromisoformat(start)
    end = (t0 + _dt.timedelta(seconds=n * freq_seconds)).isoformat()
    return timeseries(spark, start, end, freq_seconds, dtypes, seed)


def random_grid(spark: SparkSession, shape, seed: int = 0, compressible: bool = False) -> DataFrame:
    """Random n-d array as a grid table ``(d0, d1, ..., value)`` (S16);
    ``compressible`` zeroes every second value."""
    n = math.prod(shape)
    r = spark.range(n)
    dims, rem = [], col("id")
    stride = n
    for k, s in enumerate(shape):
        stride //= s
        dims.append((F.floor(rem / stride) % s).cast("long").alias(f"d{k}"))
    v = _u01(col("id"), seed)
    if compressible:
        v = F.when(col("id") % 2 == 1, F.lit(0.0)).otherwise(v)
    return r.select(*dims, v.alias("value"))
