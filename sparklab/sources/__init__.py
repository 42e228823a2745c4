"""Sources: Parquet tables and hive-partitioned sets, typed and dirty CSV/TSV,
zip-compressed CSV, archives of documents, raw file bytes, grids, run history,
queries, synthetic series and arrays, seeded file samples."""

from sparklab.sources.files import (
    file_bytes, read_csv, read_dirty_tsv, read_hive, read_table, read_zip_csv, sample_files, scan_archives,
)
from sparklab.sources.grids import read_grid, read_grid_files
from sparklab.sources.other import read_query
from sparklab.sources.synthetic import random_grid, timeseries, timeseries_of_size

__all__ = [
    "read_table", "read_hive", "read_csv", "read_dirty_tsv", "read_zip_csv", "scan_archives", "file_bytes",
    "sample_files", "read_grid", "read_grid_files", "read_query", "timeseries", "timeseries_of_size", "random_grid",
]
