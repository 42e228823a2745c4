"""File sources. Decoding that Spark has no reader for (zip members, tar
members) runs in ``mapInPandas`` on the executors, one file per task, and
yields bounded batches; the driver only ever sees file names."""

from __future__ import annotations

import hashlib
import random
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from sparklab.functions.text import strip_to_double

col = F.col


def read_table(spark: SparkSession, root: str, name: str | None = None, columns=None) -> DataFrame:
    """Parquet table (S1); with ``columns`` only those are read (S2): the
    projection reaches the scan's ReadSchema."""
    path = root if name is None else f"{root.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_hive(spark: SparkSession, path: str) -> DataFrame:
    """Hive-partitioned Parquet (``key=value`` folders) with typed partition
    columns (S3); filters on them prune folders before any file is opened."""
    return spark.read.option("basePath", path).parquet(path)


def read_csv(spark: SparkSession, path, schema, header: bool = True, columns=None, sep: str = ",") -> DataFrame:
    """Typed CSV (S5, S10): declared schema, no inference pass. Split size is
    ``spark.sql.files.maxPartitionBytes``."""
    df = spark.read.schema(schema).option("header", header).option("sep", sep).option("mode", "PERMISSIVE").csv(path)
    return df.select(*columns) if columns else df


def read_dirty_tsv(spark: SparkSession, paths, schema: dict, strip: str = "#", sep: str = "\t") -> DataFrame:
    """Headerless TSV with named columns, bad lines skipped, ``strip``
    characters removed from float fields (S6).

    Lines are split on ``sep``; a line whose field count differs from the
    schema is a bad line and is dropped (the CSV reader would pad or
    truncate it instead). Floats are cleaned, then every column is
    try_cast to its type (NULL instead of an error under ANSI).
    """
    names = list(schema)
    parts = F.split(col("value"), sep, -1)
    raw = spark.read.text(paths).select(parts.alias("_f")).filter(F.size("_f") == len(names))
    out = []
    for k, (n, t) in enumerate(schema.items()):
        field = F.nullif(col("_f")[k], F.lit(""))
        if t in ("double", "float"):
            out.append(strip_to_double(field, strip).cast(t).alias(n))
        elif t == "string":
            out.append(field.alias(n))
        else:
            out.append(field.try_cast(t).alias(n))
    return raw.select(*out)


def _schema_ddl(schema) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _archives(spark: SparkSession, source) -> DataFrame:
    """``source`` is a glob of files, or a DataFrame of (path, content)."""
    files = source if isinstance(source, DataFrame) else spark.read.format("binaryFile").load(source)
    return files.select("path", "content")


def read_zip_csv(spark: SparkSession, glob, schema, converters: dict | None = None,
                 batch_rows: int = 65536) -> DataFrame:
    """CSV members of zip archives (S7). Spark has no zip codec: the archives
    are listed with the ``binaryFile`` source and each is opened by one task
    in ``mapInPandas``, which streams every member in ``batch_rows`` chunks.
    All fields come out as strings and are cast afterwards with ``try_cast``
    (``converters`` maps a column to a Column expression over the string).
    An unreadable archive fails the job and names the file. ``glob`` may also
    be a DataFrame of (path, content)."""
    target = _schema_ddl(schema)
    names = [f.name for f in target.fields]
    str_schema = StructType([StructField(n, StringType(), True) for n in names])

    def unzip(batches):
        import io
        import zipfile

        import pandas as pd

        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    zf = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile as e:
                    raise ValueError(f"unreadable zip archive {path}: {e}") from e
                for member in zf.namelist():
                    if member.endswith("/"):
                        continue
                    with zf.open(member) as fh:
                        for chunk in pd.read_csv(fh, dtype=str, chunksize=batch_rows, keep_default_na=False,
                                                 na_values=[""]):
                            chunk = chunk.reindex(columns=names)
                            yield chunk.astype(object).where(chunk.notna(), None)

    raw = _archives(spark, glob).mapInPandas(unzip, str_schema)
    conv = converters or {}
    return raw.select(*[
        (conv[f.name](col(f.name)) if f.name in conv else col(f.name).try_cast(f.dataType)).alias(f.name)
        for f in target.fields])


def scan_archives(spark: SparkSession, glob, member_suffix: str = ".pdf", needle: bytes = b"matplotlib",
                  lower: bool = True) -> DataFrame:
    """Tar archives -> ``(archive, member, contains, error)`` for members ending in
    ``member_suffix`` (S8, U6). An archive that cannot be read, or breaks
    half way, yields one more row with the error and no member, after the
    members read so far. ``glob`` may also be a DataFrame of (path, content)."""
    out = StructType([StructField("archive", StringType()), StructField("member", StringType()),
                      StructField("contains", BooleanType()), StructField("error", StringType())])

    def scan(batches):
        import tarfile

        import pyarrow as pa

        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("contains", pa.bool_()), ("error", pa.string())])
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                path, found = path.as_py(), []
                try:
                    # read where Arrow has it: an archive is not copied
                    with tarfile.open(fileobj=pa.BufferReader(content.as_buffer())) as tf:
                        for m in tf:  # one member in memory at a time
                            tf.members = []
                            if m.isfile() and m.name.endswith(member_suffix):
                                data = tf.extractfile(m).read()
                                found.append((path, m.name, needle in (data.lower() if lower else data), None))
                except (tarfile.TarError, OSError, EOFError) as e:
                    found.append((path, None, None, f"{type(e).__name__}: {e}"))
                if found:  # one small batch per archive
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    return _archives(spark, glob).mapInArrow(scan, out)


def file_bytes(spark: SparkSession, glob: str) -> DataFrame:
    """Whole-file reads (S9): ``(path, length, modificationTime)``; ``length``
    is computed from the bytes read, so the files are really read."""
    return (spark.read.format("binaryFile").load(glob)
            .select("path", F.length("content").cast("long").alias("length"), "modificationTime"))


def sample_files(spark: SparkSession, path: str, fraction: float, seed: int = 0, fmt: str = "parquet", folders: bool = False) -> DataFrame:
    """Seeded sample of a dataset's files (S17): the file list comes from the
    source's metadata (``inputFiles``), the choice is made on the driver
    (names only), and only the chosen files are opened.

    By default a seeded choice of ``fraction`` of the file names. With
    ``folders`` whole key folders (``key=value/...`` below ``path``) are
    chosen by a hash of their name and the seed, so the same keys are chosen
    whatever the files are called and however many there are; if no folder's
    hash falls below ``fraction``, the one with the lowest is taken."""
    files = sorted(unquote(f) for f in spark.read.format(fmt).load(path).inputFiles())
    if not folders:
        k = max(1, int(round(len(files) * fraction)))
        return spark.read.format(fmt).load(sorted(random.Random(seed).sample(files, k)))
    draw = {}
    for f in files:
        keys = [x for x in f.split("/")[:-1] if "=" in x]
        draw.setdefault(int(hashlib.md5(f"{'/'.join(keys)}-{seed}".encode()).hexdigest()[:8], 16) % 10000, []).append(f)
    chosen = [f for h, own in draw.items() if h < fraction * 10000 for f in own] or draw[min(draw)]
    return spark.read.format(fmt).option("basePath", path).load(sorted(chosen))
