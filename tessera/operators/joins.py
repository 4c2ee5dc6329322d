"""Joins with the reference's key semantics.

Join strategy is left to Catalyst and AQE (broadcast / shuffle-hash /
sort-merge, skew splitting): a side is broadcast once its real size, known at
run time, is small.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, functions as F


def natural_keys(left: DataFrame, right: DataFrame) -> list[str]:
    return [c for c in left.columns if c in right.columns]


def _null_safe_cond(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def anti_join(left: DataFrame, right: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """``anti_join``: rows of ``left`` with no match; natural keys by default; NA matches NA."""
    keys = list(by) if by else natural_keys(left, right)
    r = right.select(*keys)
    return left.join(r, _null_safe_cond(left, r, keys), "left_anti")


def membership_flag(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str,
                    name: str = "present") -> DataFrame:
    """``mutate(present = key %in% lookup$key)`` as a column (never NA).

    A left join to the *distinct* lookup keys keeps the row count.
    """
    keys = lookup.select(F.col(lookup_key).alias("_mk")).distinct().withColumn("_mhit", F.lit(True))
    j = df.join(keys, df[key] == F.col("_mk"), "left")
    return j.withColumn(name, F.coalesce(F.col("_mhit"), F.lit(False))).drop("_mk", "_mhit")


def inner_join(left: DataFrame, right: DataFrame, by: Sequence[str],
               suffix: tuple[str, str] = ("_x", "_y"), how: str = "inner") -> DataFrame:
    """``inner_join(by = ...)``: shared non-key names get suffixes instead of clashing."""
    shared = [c for c in left.columns if c in right.columns and c not in by]
    lr = left.select(*[F.col(c).alias(c + suffix[0]) if c in shared else F.col(c) for c in left.columns])
    rr = right.select(*[F.col(c).alias(c + suffix[1]) if c in shared else F.col(c) for c in right.columns])
    return lr.join(rr, list(by), how)


def bind_rows(*dfs: DataFrame) -> DataFrame:
    """``bind_rows``: union by column name; missing columns become NA."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
