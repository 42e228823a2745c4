"""Plan properties that matter at scale, read from the executed plans."""

import re

import pytest

import __spark_entry__ as E
from sparklab.plans import tpch
from sparklab.plans.registry import registry
from sparklab.tables import Tables

SF = "/root/testdata/sf0.01"
# registered queries that write files while being built (round trips) or train models
SKIP = {"ab_confidence", "search_scores", "gbt_predictions", "ols", "sized_write", "hive_first", "csv_mean_tip",
        "dirty_tsv", "zip_trips", "archive_share", "file_bytes", "grid_roundtrip", "grid_files",
        "warehouse_roundtrip", "lookup_single_file", "parquet_roundtrip", "merge_runs", "categorize",
        "h2o_q6", "remove_outliers", "trip_features", "float32_features"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_q1_scan_pushdown_and_pruning(spark):
    p = _formatted(tpch.q01(Tables(spark, SF)))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThanOrEqual(l_shipdate" in p
    scan = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "l_orderkey" not in scan and "l_suppkey" not in scan


def test_q6_filters_reach_scan(spark):
    p = _formatted(tpch.q06(Tables(spark, SF), **tpch.FIXTURE_PARAMS["q06"]))
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_quantity" in p


def test_topn_uses_window_group_limit(spark):
    p = _plan(E.queries()["h2o_q8"](spark, SF))
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("name", sorted(n for n in registry().queries if n not in SKIP))
def test_no_cartesian_or_unpartitioned_window(spark, name):
    p = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in p
    # a Window must always be partitioned (no global row_number/sum over one task)
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", p):
        assert m.group(1).strip(), f"unpartitioned window in {name}"
