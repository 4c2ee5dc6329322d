"""Registered analyses: one Spark query per operator, each with a DuckDB oracle.

A query is a function ``fn(t: Tables) -> DataFrame``; ``sql`` is the same
question in DuckDB SQL over the driver's tables (derived views are added as
CTEs by ``with_views``).  ``None`` marks operators SQL cannot express.
"""

from __future__ import annotations

import importlib
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.tables import Tables
from tessera.sources.view_sql import with_views


@dataclass(frozen=True)
class Query:
    key: str
    fn: Callable[[Tables], DataFrame]
    sql: str | None
    section: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.fn(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}

MODULES = (
    "sources_q", "relational", "aggregates", "windows_q", "reshape_q", "scalars_q",
    "factors_q", "composed", "stats_q", "profile_q", "ml_q",
)


def query(key: str, sql: str | None = None, section: str = ""):
    """Register ``fn`` under ``key`` with its oracle SQL."""
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, with_views(sql) if sql else None, section)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    for m in MODULES:
        try:
            importlib.import_module(f"tessera.workloads.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"tessera.workloads.{m}":
                raise
    return REGISTRY
