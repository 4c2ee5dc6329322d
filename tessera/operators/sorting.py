"""Sorts, top-k and exact, reproducible sampling.

Samples order rows by an md5 hash of (seed, key): exact size, no replacement,
the same on every run and partitioning.  ``limit`` after ``orderBy`` plans as
a top-k (``TakeOrderedAndProject``: each task keeps only ``n`` rows), and a
per-group ``row_number() <= n`` plans a partial ``WindowGroupLimit`` before the
shuffle, so even a huge stratum sends only ``n`` rows per map task.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def arrange(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``arrange(a, desc(b))``: NA last in both directions."""
    cols = [F.col(k).asc_nulls_last() if isinstance(k, str) else k for k in keys]
    return df.orderBy(*cols)


def desc(col: str) -> Column:
    return F.col(col).desc_nulls_last()


def hash_key(seed: int, keys: Sequence[str]) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k) for k in keys]))


def hash_key_sql(seed: int, keys: Sequence[str]) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(keys)}))"


def sample_n(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """``slice_sample(n)``: exactly ``n`` rows (all if fewer), reproducible."""
    return df.orderBy(hash_key(seed, keys)).limit(n)


def sample_n_by(df: DataFrame, n: int, seed: int, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """``slice_sample(n, by = g)``: exactly ``n`` per stratum, all rows of smaller strata."""
    w = Window.partitionBy(*by).orderBy(hash_key(seed, keys))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_k_per_group(df: DataFrame, k: int, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Grouped ``filter(row_number(x) <= k)``: ``WindowGroupLimit`` prunes before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k)
