"""Catalogue of named queries: key -> (Spark builder, DuckDB oracle SQL).

Plan modules register their queries with :func:`query`; the driver entry
point reads :func:`all_queries` / :func:`all_oracles`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kestrel.plans.fixtures import Views, views, with_views


@dataclass
class Entry:
    key: str
    build: Callable[[Views], DataFrame]
    oracle: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(views(spark, sf_dir))


_REGISTRY: dict[str, Entry] = {}


def query(key: str, oracle: str | None = None):
    """Register ``fn(v: Views) -> DataFrame`` under ``key``."""

    def deco(fn):
        if key in _REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        _REGISTRY[key] = Entry(key, fn, oracle)
        return fn

    return deco


def _load_all():
    # import side effects fill the registry
    from kestrel.plans import (  # noqa: F401
        fraud, transit, monitoring, warehouse, documents, modeling,
        quality, governance, io, streams,
    )


def entries() -> dict[str, Entry]:
    _load_all()
    return dict(_REGISTRY)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.run for k, e in entries().items()}


def all_oracles() -> dict[str, str]:
    return {k: with_views(e.oracle) for k, e in entries().items() if e.oracle}
