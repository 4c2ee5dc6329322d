"""Reproducible train / test / validation splits.

Without strata a row goes to the first part when the md5 hash of (seed, key),
read as a uniform number, is below ``prop``: a projection, the same on every run,
partitioning and task retry.  With strata (or ``exact=True``) rows are ranked by
that hash inside each stratum and the first
``floor(n_stratum * prop)`` form the first part, so every stratum keeps its
share to the row.  The hash at which the first part ends is one order statistic
(``tessera.plans.select``), so no row is sorted or moved.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from tessera.functions.random import hash_uniform
from tessera.operators.agg import keep_on_rows
from tessera.operators.sorting import hash_key
from tessera.plans.ordered import group_positions
from tessera.plans.select import few_rows, thin_scan


def _with_prefix(h: DataFrame) -> DataFrame:
    """The first 60 bits of the hash as a number, in the order of the hashes."""
    return h.withColumn("_p", F.conv(F.substring("_h", 1, 15), 16, 10).cast("bigint"))


def _cuts(h: DataFrame, strata: list[str], prop: float):
    """The last hash (its first 60 bits) of the first part of each stratum: one selected order statistic.

    Nothing if there are too many strata, or if a cut falls among rows that share those bits: then the rows are ranked.
    """
    def wanted(n):
        return F.array(F.floor(n * F.lit(prop)).cast("bigint"))

    thin = thin_scan(_with_prefix(h), strata, "_p", wanted)
    last = F.floor(F.col("_total") * F.lit(prop))
    rows = few_rows(thin.where((F.col("_cum") - F.col("_n") < last) & (last <= F.col("_cum"))).select(*strata, F.col("_p").alias("_cut"), "_n"))
    if rows is None or any(r["_n"] > 1 for r in rows):
        return None
    if not strata:
        return rows[0]["_cut"] if rows else -1
    return F.broadcast(h.sparkSession.createDataFrame([r[:-1] for r in rows], h.select(*strata).schema.add("_cut", T.LongType())))


def split_column(df: DataFrame, keys: Sequence[str], prop: float, seed: int, strata: Sequence[str] = (),
                 names: tuple[str, str] = ("train", "test"), name: str = "split", exact: bool = False) -> DataFrame:
    strata = list(strata)
    if not exact and not strata:
        first = hash_uniform(seed, *keys) < prop
        return df.withColumn(name, F.when(first, F.lit(names[0])).otherwise(F.lit(names[1])))
    h = df.withColumn("_h", hash_key(seed, keys))
    cut = _cuts(h, strata, prop)
    if cut is not None:
        first = F.col("_p") <= F.col("_cut")
        marked = keep_on_rows(_with_prefix(h), strata, cut) if strata else _with_prefix(h).withColumn("_cut", F.lit(cut).cast("bigint"))
        return marked.withColumn(name, F.when(first, F.lit(names[0])).otherwise(F.lit(names[1]))).drop("_h", "_p", "_cut")
    pos = group_positions(h, strata, ["_h", *keys], name="_pos")
    n = h.groupBy(*strata).agg(F.count(F.lit(1)).alias("_ns"))
    pos = keep_on_rows(pos, strata, n) if strata else pos.withColumn("_ns", F.lit(h.count()))
    first = F.col("_pos") <= F.floor(F.col("_ns") * prop)
    return pos.withColumn(name, F.when(first, F.lit(names[0])).otherwise(F.lit(names[1]))).drop("_h", "_pos", "_ns")


def split_sql(table: str, columns: str, keys: Sequence[str], prop: float, seed: int, strata: str,
              names: tuple[str, str] = ("train", "test"), name: str = "split") -> str:
    """The DuckDB twin of a stratified split."""
    order = f"md5(concat_ws('|', '{seed}', {', '.join(keys)})), {', '.join(keys)}"
    return f"""SELECT {columns}, CASE WHEN row_number() OVER (PARTITION BY {strata} ORDER BY {order})
  <= floor(count(*) OVER (PARTITION BY {strata}) * {prop}) THEN '{names[0]}' ELSE '{names[1]}' END AS {name} FROM {table}"""


def initial_split(df: DataFrame, keys: Sequence[str], prop: float = 0.75, seed: int = 222,
                  strata: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """``initial_split(prop, strata)``: adds ``split`` in {train, test}."""
    return split_column(df, keys, prop, seed, strata, exact=exact)


def validation_split(train: DataFrame, keys: Sequence[str], prop: float = 0.8, seed: int = 234,
                     strata: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """``validation_split``: splits the training rows into train / validation."""
    return split_column(train, keys, prop, seed, strata, names=("train", "validation"), name="val_split", exact=exact)
