"""Registers q01..q22 with their fixture bindings and oracle SQL."""

from __future__ import annotations

from sparklab.plans import tpch, tpch_sql
from sparklab.tables import Tables


def _runner(name):
    fn = tpch.QUERIES[name]
    params = tpch.FIXTURE_PARAMS[name]

    def run(spark, sf_dir):
        return fn(Tables.of(spark, sf_dir), **params)

    run.__name__ = name
    return run


def register(reg) -> None:
    for name in tpch.QUERIES:
        reg.add(name, _runner(name), tpch_sql.duckdb_sql(name))
