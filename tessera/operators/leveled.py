"""Factors that carry their levels: a string column whose metadata holds the level order.

The values stay plain strings, so filters reach the scan; the levels travel in
the column's metadata through select, filter, join, sort and a Parquet round
trip, and sorting, counting and coding follow them without a level table at each
call.  A column computed from a factor is plain again.  The levels lie in the
plan, so their number is bounded by a parameter; larger factors keep level
tables (``operators.factors``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MAX_LEVELS = 10_000


class TooManyLevelsError(ValueError):
    pass


def levels_of(df: DataFrame, col: str) -> list[str]:
    """The levels a column carries, in order."""
    levels = df.schema[col].metadata.get("levels")
    if levels is None:
        raise ValueError(f"{col} is not a factor")
    return list(levels)


def as_factor(df: DataFrame, col: str, levels: Sequence[str] | None = None, max_levels: int = MAX_LEVELS) -> DataFrame:
    """``factor(x, levels)``: values outside the levels become NA; by default the distinct values in sort order (one aggregate)."""
    text = F.col(col).cast("string")
    given = levels is not None
    if not given:
        seen = df.select(text.alias("level")).where(F.col("level").isNotNull()).distinct().limit(max_levels + 1).collect()
        levels = sorted(r["level"] for r in seen)
    levels = list(levels)
    if len(levels) > max_levels:
        raise TooManyLevelsError(f"{col} has more than {max_levels} levels")
    if len(set(levels)) < len(levels):
        raise ValueError(f"a level of {col} is given twice")
    value = F.when(text.isin(levels), text) if given else text
    return df.withColumn(col, value).withMetadata(col, {**df.schema[col].metadata, "levels": levels})


def code(df: DataFrame, col: str) -> Column:
    """Position of each value among its levels, from 1; NA for NA."""
    pos = F.array_position(F.array(*[F.lit(v) for v in levels_of(df, col)]).cast("array<string>"), F.col(col))
    return F.when(pos > 0, pos).cast("bigint")


def sort_by_levels(df: DataFrame, *cols: str) -> DataFrame:
    """``arrange`` by level order, NA last."""
    return df.orderBy(*[code(df, c).asc_nulls_last() for c in cols])


def relevel(df: DataFrame, col: str, first: Sequence[str]) -> DataFrame:
    """``fct_relevel``: the named levels first; the values stay as they are."""
    have = levels_of(df, col)
    unknown = [v for v in first if v not in have]
    if unknown:
        raise ValueError(f"{unknown[0]!r} is not a level of {col}")
    return _with_levels(df, col, [*first, *[v for v in have if v not in set(first)]])


def reverse_levels(df: DataFrame, col: str) -> DataFrame:
    """``fct_rev``: the level order reversed."""
    return _with_levels(df, col, levels_of(df, col)[::-1])


def drop_unused(df: DataFrame, col: str) -> DataFrame:
    """``fct_drop``: only levels that occur, in their order (one aggregate)."""
    seen = {r[0] for r in df.select(col).distinct().collect()}
    return _with_levels(df, col, [v for v in levels_of(df, col) if v in seen])


def count_levels(df: DataFrame, col: str, ord_col: str = "ord") -> DataFrame:
    """``count(f, .drop = FALSE)``: ``col, ord, n`` for every level, empty ones too, and for NA where it occurs."""
    levels = levels_of(df, col)
    counts = df.groupBy(F.col(col).alias("_level")).agg(F.count(F.lit(1)).alias("_n"))
    table = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(levels, 1)], "_known string, _ord bigint")
    out = table.join(counts, F.col("_known") == F.col("_level"), "full").select(
        F.coalesce("_known", "_level").alias(col), F.col("_ord").alias(ord_col), F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))
    return _with_levels(out, col, levels)


def _with_levels(df: DataFrame, col: str, levels: Sequence[str]) -> DataFrame:
    return df.withMetadata(col, {**df.schema[col].metadata, "levels": list(levels)})
