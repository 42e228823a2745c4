"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame, plus the
DuckDB oracle SQL where SQL can state the result.

Each area module exposes ``register(reg)``; this module only collects them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, QueryFn] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, fn: QueryFn, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"duplicate query name {name}")
        self.queries[name] = fn
        if sql is not None:
            self.sql[name] = sql.strip()


_REG: Registry | None = None


def registry() -> Registry:
    global _REG
    if _REG is None:
        reg = Registry()
        from sparklab.plans import tpch_registered
        tpch_registered.register(reg)
        for mod in _optional_modules():
            mod.register(reg)
        _REG = reg
    return _REG


def _optional_modules():
    import importlib
    names = [
        "sparklab.operators.h2o",
        "sparklab.operators.relational",
        "sparklab.operators.runs",
        "sparklab.operators.grid",
        "sparklab.operators.userfn",
        "sparklab.operators.climate",
        "sparklab.operators.features",
        "sparklab.operators.workflows",
        "sparklab.operators.check",
        "sparklab.operators.io_roundtrip",
    ]
    mods = []
    for n in names:
        try:
            m = importlib.import_module(n)
        except ModuleNotFoundError as e:
            if e.name == n:
                continue
            raise
        if hasattr(m, "register"):
            mods.append(m)
    return mods
