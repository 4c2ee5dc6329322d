"""Ranks, offsets and running values within groups, with R's NA rules.

Ranks, offsets and running sums come from one distributed ordered scan
(``tessera.plans.ordered``), so a group that holds a third of the rows is still
spread over many tasks.  Window functions are used only on aggregated, bounded
tables (shares within a group).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tessera.operators.agg import keep_on_rows
from tessera.plans.ordered import group_positions, match_groups, running_sum, scan, value_scan  # noqa: F401
from tessera.plans.select import settled


def _attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left-join a per-key statistic table back onto the rows (null-safe keys)."""
    s = stats.select(*[F.col(k).alias(f"_w_{k}") for k in keys], *[c for c in stats.columns if c not in keys])
    return df.join(s, match_groups(df, s, [(k, f"_w_{k}") for k in keys]), "left").drop(*[f"_w_{k}" for k in keys])


def _known(df: DataFrame, x: str) -> Column:
    """Whether the value takes part in ranks: neither NA nor NaN."""
    ok = F.col(x).isNotNull()
    return ok & ~F.isnan(x) if isinstance(df.schema[x].dataType, (T.DoubleType, T.FloatType)) else ok


def _ranked(df: DataFrame, by: list[str], x: str, name: str, desc: bool, kind: str, value=None) -> DataFrame:
    """Ranks of the known values by one ordered scan; ``value`` turns a rank and the group's size into the result.  NA gets NA.

    ``df`` is read once: rows without a known value go through the scan behind the others of their group, and sizes are counted on its stored rows.
    """
    r = scan(df.withColumn("_na", ~_known(df, x)), by, [F.col("_na").asc(), F.col(x).desc() if desc else F.col(x).asc()], rank=("_rank", ["_na", x]))
    rank = F.col("_rank")
    if value is not None:
        n = r.where(~F.col("_na")).groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
        r = keep_on_rows(r, by, settled(n)) if by else r.crossJoin(F.broadcast(n))  # without keys: one row
        rank = value(rank, F.col("_n"))
    return r.select(*[c for c in df.columns if c != name], F.when(~F.col("_na"), rank).cast(kind).alias(name))


def min_rank(df: DataFrame, by: Sequence[str], x: str, name: str = "min_rank", desc: bool = False) -> DataFrame:
    """``min_rank(x)``: ties share the lowest rank; NA gets NA and is not counted."""
    return _ranked(df, list(by), x, name, desc, "bigint")


def dense_rank(df: DataFrame, by: Sequence[str], x: str, name: str = "dense_rank", desc: bool = False) -> DataFrame:
    """``dense_rank(x)``: ranks of the distinct values; NA gets NA."""
    by = list(by)
    d = df.filter(F.col(x).isNotNull()).select(*by, x).distinct()
    r = group_positions(d, by, [F.col(x).desc() if desc else F.col(x).asc()], name=name)
    return _attach(df, r, by + [x])


def row_number(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "row_number",
               na_col: str | None = None) -> DataFrame:
    """``row_number(x)`` (ties by the rest of ``order``); with ``na_col`` an NA there gets NA."""
    if na_col is None:
        return group_positions(df, by, order, name=name)
    nn = group_positions(df.filter(F.col(na_col).isNotNull()), by, order, name=name)
    na = df.filter(F.col(na_col).isNull()).withColumn(name, F.lit(None).cast("bigint"))
    return nn.unionByName(na)


def percent_rank(df: DataFrame, by: Sequence[str], x: str, name: str = "percent_rank") -> DataFrame:
    """``percent_rank(x)`` = (min_rank - 1) / (number of non-NA - 1)."""
    return _ranked(df, list(by), x, name, False, "double", lambda r, n: F.try_divide(r - 1, (n - 1).cast("double")))


def cume_dist(df: DataFrame, by: Sequence[str], x: str, name: str = "cume_dist") -> DataFrame:
    """``cume_dist(x)``: share of non-NA values <= x, from the rank in falling order."""
    return _ranked(df, list(by), x, name, True, "double", lambda r, n: (n - r + 1) / n)


def lag(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], x: str, n: int = 1,
        name: str | None = None, pos_name: str = "_pos", keep_pos: bool = False) -> DataFrame:
    """``lag(x, n)`` along a total ``order`` within groups (``n < 0`` gives ``lead``)."""
    name = name or (f"lag_{x}" if n > 0 else f"lead_{x}")
    return scan(df, by, order, pos=pos_name if keep_pos else None, lags=[(x, n, name)])


def share_within(n: str, by: Sequence[str], name: str = "prop") -> Column:
    """``n / sum(n)`` within groups of an *aggregated* table (bounded partitions)."""
    return (F.col(n) / F.sum(n).over(Window.partitionBy(*by))).alias(name)
