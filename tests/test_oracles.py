"""Every registered query with an oracle matches DuckDB at sf0.01; queries
without one run and return rows. Slow model/bootstrap queries are marked."""

import pytest

import __spark_entry__ as E
from sparklab.plans.compare import compare
from sparklab.plans.registry import registry

SLOW = {"ab_confidence", "search_scores", "gbt_predictions"}
NAMES = sorted(registry().queries)


@pytest.mark.parametrize("name", [n for n in NAMES if n not in SLOW])
def test_query_matches_oracle(spark, duck, name):
    from tests.conftest import SF001

    pdf = registry().queries[name](spark, SF001).toPandas()
    sql = registry().sql.get(name)
    if sql is None:
        assert len(pdf) > 0
        return
    diff = compare(pdf, duck.execute(sql).df())
    assert diff is None, diff


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["l_returnflag", "l_linestatus"]


def test_every_query_has_callable_and_most_have_oracles():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(registry().queries) == set(registry().sql) <= set(E.queries())
