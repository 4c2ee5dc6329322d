"""Pivots, completion of key combinations, and filling of missing values.

Completion never uses a cross join: the first key keeps its observed values
as a distributed frame, and each further key's domain is dealt into chunks of
bounded size that the frame meets by an equi-join on the chunk number and
expands in the row.  Fill-down is one distributed ordered scan.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.plans.ordered import match_groups, scan

#: values of a key domain that one row expands to at once
CHUNK = 1000


def pivot_wider(df: DataFrame, ids: Sequence[str], names_from: str, values_from: str,
                values: Sequence, prefix: str = "") -> DataFrame:
    """``pivot_wider``: one column per listed name; absent cells are NA.

    The name list is explicit, so no extra job runs to find it and the schema is fixed.
    """
    g = df.groupBy(*ids).pivot(names_from, list(values)).agg(F.first(values_from, ignorenulls=True))
    return g.select(*ids, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])


def pivot_longer(df: DataFrame, ids: Sequence[str], cols: Sequence[str], names_to: str, values_to: str) -> DataFrame:
    """``pivot_longer``: NA cells are kept, so implicit gaps become explicit rows."""
    return df.unpivot(list(ids), list(cols), names_to, values_to)


def domain(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of ``col`` (NA included where it occurs), as a frame of any size."""
    return df.select(F.col(col).alias("value")).distinct()


def _expand(frame: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Every row of ``frame`` with every value: chunks of the domain are joined by number, then exploded."""
    chunks = max(1, -(-values.count() // CHUNK))
    dealt = (values.groupBy(F.pmod(F.xxhash64("value"), F.lit(chunks)).cast("int").alias("_part"))
             .agg(F.collect_list(F.struct("value")).alias("_values")))
    rows = frame.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    return rows.join(dealt, "_part").withColumn("_values", F.explode("_values")).withColumn(key, F.col("_values.value")).drop("_part", "_values")


def complete(df: DataFrame, first: str, others: Mapping[str, Column | DataFrame | Sequence]) -> DataFrame:
    """``complete(first, other...)``: every combination of observed / given key values.

    ``others`` maps a key to its domain: a one-column frame (:func:`domain`), an
    array Column or a literal list (``complete(year = 2019:2021)``).  Missing
    combinations get NA in the value columns; rows outside the given domains stay.
    """
    keys = [first] + list(others)
    frame = df.select(F.col(first).alias(f"_c_{first}")).distinct()
    for k, dom in others.items():
        if isinstance(dom, DataFrame):
            frame = _expand(frame, f"_c_{k}", dom)
        else:
            arr = dom if isinstance(dom, Column) else F.array(*[F.lit(v) for v in dom])
            frame = frame.withColumn(f"_c_{k}", F.explode(arr))
    frame = frame.withColumn("_in", F.lit(True))
    data = df.select(*[F.col(c).alias(f"_d_{c}") for c in df.columns])
    out = frame.join(data, match_groups(frame, data, [(f"_c_{k}", f"_d_{k}") for k in keys]), "full")
    return out.select(*[F.when(F.col("_in"), F.col(f"_c_{k}")).otherwise(F.col(f"_d_{k}")).alias(k) for k in keys],
                      *[F.col(f"_d_{c}").alias(c) for c in df.columns if c not in keys])


def fill_down(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``fill(cols)``: last observation carried forward along ``order`` within groups, all columns in one scan."""
    filled = scan(df, by, order, fills=[(c, f"_fill_{c}") for c in cols])
    return filled.select(*[F.col(f"_fill_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])
