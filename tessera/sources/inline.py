"""Literal tables and value grids, generated without joins."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def expand_values(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Add column ``name`` taking every value of a short literal list per row of ``df``.

    ``expand.grid`` is then a chain of these on a frame of distinct values:
    an explode (Generate) per axis, not a cross join.
    """
    return df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def expand_column(df: DataFrame, name: str, domain: Column) -> DataFrame:
    """Add column ``name`` taking every element of an array-valued expression per row.

    ``domain`` is typically a scalar subquery (``other.agg(F.collect_set(c)).scalar()``):
    a small, bounded domain computed once and inlined, not a cross join.
    """
    return df.withColumn(name, F.explode(domain))
