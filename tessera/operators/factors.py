"""Factors: a string column plus a level table ``(level, ord)``.

A factor is not a Spark type (a UDT would block pushdown and codegen).  The
values stay a plain string column; the level order lives in a small table,
computed by one aggregation over the data (its size is the number of levels)
or given as a literal list.  Fixed lists are applied with ``array_position``
inside codegen; data-derived level tables of any size are numbered by the
distributed scan and joined back.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.functions.dates import MONTH_ABB  # noqa: F401
from tessera.plans.ordered import exact_quantiles, group_positions, scan, value_scan


def level_table(levels: DataFrame | Sequence[str], spark=None) -> DataFrame:
    if isinstance(levels, DataFrame):
        return levels
    return spark.createDataFrame([(lv, i) for i, lv in enumerate(levels, 1)], "level string, ord int")


def fct_new(df: DataFrame, col: str, levels: Sequence[str], ord_col: str | None = None) -> DataFrame:
    """``factor(x, levels)``: values outside the levels become NA; adds the level position."""
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(col))
    ord_col = ord_col or f"{col}_ord"
    return (df.withColumn(ord_col, F.when(pos > 0, pos).cast("bigint"))
              .withColumn(col, F.when(pos > 0, F.col(col))))


class UnknownLevelError(ValueError):
    pass


def fct_strict(df: DataFrame, col: str, levels: Sequence[str]) -> DataFrame:
    """``fct(x, levels)``: an unknown value is an error, not a silent NA.

    The check is one bounded job (``limit(1)``) before the plan is returned.
    """
    bad = df.filter(F.col(col).isNotNull() & ~F.col(col).isin(list(levels))).select(col).limit(1).collect()
    if bad:
        raise UnknownLevelError(f"value {bad[0][0]!r} of {col} is not in the levels")
    return fct_new(df, col, levels)


def levels_sorted(df: DataFrame, col: str) -> DataFrame:
    """Default ``factor`` levels: distinct values in sort order."""
    d = df.select(F.col(col).alias("level")).filter(F.col("level").isNotNull()).distinct()
    return group_positions(d, [], ["level"], "ord")


def levels_first_seen(df: DataFrame, col: str, order_by: Sequence[str]) -> DataFrame:
    """Default ``fct`` levels: order of first appearance along ``order_by``."""
    first = df.groupBy(F.col(col).alias("level")).agg(F.min(F.struct(*order_by)).alias("_first"))
    return group_positions(first.filter(F.col("level").isNotNull()), [], ["_first"], "ord").drop("_first")


def levels_by(df: DataFrame, col: str, stat: Column, descending: bool = False) -> DataFrame:
    """Levels ordered by a per-level statistic (``fct_reorder`` with ``.fun``), ties by level."""
    s = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("level")).agg(stat.alias("_s"))
    o = F.col("_s").desc_nulls_last() if descending else F.col("_s").asc_nulls_last()
    return group_positions(s, [], [o, "level"], "ord").drop("_s")


def fct_reorder_median(df: DataFrame, col: str, x: str) -> DataFrame:
    """``fct_reorder(f, x)``: levels by the exact median of ``x``, ascending."""
    med = exact_quantiles(df.filter(F.col(col).isNotNull()), x, [0.5], by=[col]).select(
        F.col(col).alias("level"), F.col("q0").alias("_s"))
    return group_positions(med, [], [F.col("_s").asc_nulls_last(), "level"], "ord").drop("_s")


def fct_reorder2(df: DataFrame, col: str, x: str, y: str) -> DataFrame:
    """``fct_reorder2(f, x, y)``: levels by ``y`` at the largest ``x``, descending."""
    return levels_by(df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()), col,
                     F.max_by(F.col(y), F.struct(F.col(x), F.col(y))), descending=True)


def fct_infreq(df: DataFrame, col: str) -> DataFrame:
    """``fct_infreq``: levels by descending count (ties by level)."""
    return levels_by(df, col, F.count(F.lit(1)), descending=True)


def fct_rev(levels: DataFrame) -> DataFrame:
    """``fct_rev``: reverse the level order."""
    n = levels.agg(F.max("ord")).scalar()
    return levels.withColumn("ord", (n - F.col("ord") + 1).cast("bigint"))


def fct_relevel(levels: DataFrame, first: Sequence[str]) -> DataFrame:
    """``fct_relevel(f, ...)``: the named levels first, the rest keep their order."""
    pos = F.array_position(F.array(*[F.lit(v) for v in first]), F.col("level"))
    key = F.when(pos > 0, pos - len(first) - 1).otherwise(F.col("ord"))
    return group_positions(levels.withColumn("_key", key).drop("ord"), [], ["_key"], "ord").drop("_key")


def apply_levels(df: DataFrame, col: str, levels: DataFrame, ord_col: str | None = None) -> DataFrame:
    """Attach the level position of ``col`` from a level table ."""
    ord_col = ord_col or f"{col}_ord"
    lv = levels.select(F.col("level").alias(col), F.col("ord").alias(ord_col))
    return df.join(lv, col, "left")


def fct_recode(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """``fct_recode(f, new = "old", ...)``: rename levels; unlisted kept; a repeated new name merges."""
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for old, new in ((o, n) for n, o in _pairs(mapping)) for x in (old, new)])
    return F.coalesce(m[c], c)


def _pairs(mapping):
    for new, old in mapping.items():
        if isinstance(old, (list, tuple)):
            for o in old:
                yield new, o
        else:
            yield new, old


def fct_collapse(col: str | Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """``fct_collapse(f, new = c(...))``: many levels to one; unlisted kept."""
    return fct_recode(col, groups)


def lump_lowfreq_table(counts: DataFrame, other: str = "Other") -> DataFrame:
    """Map ``level -> new level`` for ``fct_lump_lowfreq`` from a (level, n) table.

    Sorted by count descending, the cut falls after the first level whose count
    exceeds the sum of all smaller ones; every later level is lumped, so the
    lump stays the smallest level.  The table holds one row per level.
    """
    c = scan(counts, [], [F.desc("n"), "level"], pos="_i", sums=[("n", "_cum")])
    total = counts.agg(F.sum("n")).scalar()
    cut = c.agg(F.min(F.when(F.col("n") > total - F.col("_cum"), F.col("_i")))).first()[0]
    lumped = F.col("_i") > F.lit(cut) if cut is not None else F.lit(False)
    return c.select("level", F.when(lumped, F.lit(other)).otherwise(F.col("level")).alias("new_level"))


def lump_n_table(counts: DataFrame, n: int, other: str = "Other") -> DataFrame:
    """Map ``level -> new level`` for ``fct_lump_n``: keep the ``n`` largest (min-rank ties).

    Nothing is lumped if only one level would be.  An existing level named
    like the lump merges with it.
    """
    sizes = value_scan(counts, [], "n").select(F.col("n").alias("_size"), (F.col("_total") - F.col("_cum") + 1).alias("_r"))
    r = counts.join(sizes, F.col("n") == F.col("_size"))
    n_out = r.agg(F.count_if(F.col("_r") > n)).scalar()
    return r.select("level", F.when((F.col("_r") > n) & (n_out > 1), F.lit(other))
                    .otherwise(F.col("level")).alias("new_level"))


def fct_interaction(*cols: str) -> Column:
    """``interaction(a, b)``: crossed factor ``a.b``; NA if any part is."""
    parts = [p for c in cols for p in (F.lit("."), F.col(c).cast("string"))][1:]
    return F.concat(*parts)
