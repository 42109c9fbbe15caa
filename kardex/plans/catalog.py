"""Registered report queries over the driver's test tables.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, oracle SQL or
None)``.  The oracle SQL is written independently of the DataFrame code, in
DuckDB's dialect, against the same derived tables (see ``bindings``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = (fn, oracle)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills the registry.
    from kardex.plans import (  # noqa: F401
        q_matching, q_validation, q_standardise, q_files, q_bibs, q_sources, q_staged)


def queries() -> dict[str, QueryFn]:
    _load_all()
    return {k: v[0] for k, v in _REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in _REGISTRY.items() if v[1]}
