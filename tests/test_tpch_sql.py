"""Spark SQL text of Q1-Q22 (the oracle bodies run on Spark over the same
derived views) equals the DataFrame plans: a second opinion inside Spark."""

import pytest

from sparklab.plans import tpch, tpch_sql
from sparklab.plans.compare import compare
from sparklab.tables import Tables


@pytest.mark.parametrize("q", sorted(tpch.QUERIES))
def test_sql_text_equals_dataframe(spark, q):
    from tests.conftest import SF001

    t = Tables(spark, SF001)
    tpch_sql.register_derived_views(t)
    api = tpch.QUERIES[q](t, **tpch.FIXTURE_PARAMS[q]).toPandas()
    text = spark.sql(tpch_sql.spark_sql_text(q)).toPandas()
    assert compare(api, text) is None


def test_reference_defaults_run(spark):
    """Defaults are the TPC-H constants; on the fixtures some give empty results."""
    from tests.conftest import SF0001

    t = Tables(spark, SF0001)
    for q, fn in tpch.QUERIES.items():
        fn(t).collect()
