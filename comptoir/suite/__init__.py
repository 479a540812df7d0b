"""Registered queries (name -> callable(spark, sf_dir)) and their DuckDB oracle SQL."""

from __future__ import annotations

import importlib

MODULES = ("warehouse", "scalars", "dashboard", "tables", "extraction", "text", "metrics", "io", "streams")


def collect():
    queries, oracle = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"{__name__}.{m}")
        for k in mod.Q:
            if k in queries:
                raise ValueError(f"duplicate query key {k}")
        queries.update(mod.Q)
        oracle.update(mod.O)
    unknown = set(oracle) - set(queries)
    if unknown:
        raise ValueError(f"oracle without query: {sorted(unknown)}")
    return queries, oracle
