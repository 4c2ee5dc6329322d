"""Grouped summaries with the reference's NA rules, and helpers that keep them on rows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessera.plans.ordered import match_groups


def n_distinct(x: str) -> Column:
    """``n_distinct(x)``: exact; NA counts as one more value."""
    return F.count_distinct(F.col(x)) + F.max(F.col(x).isNull().cast("int")).cast("bigint")


def count_na(x: str) -> Column:
    return F.count_if(F.col(x).isNull())


def share_na(x: str) -> Column:
    return F.avg(F.col(x).isNull().cast("double"))


def count_with_levels(df: DataFrame, col: str, levels: DataFrame, *aggs: Column) -> DataFrame:
    """``count(f, .drop = FALSE)``: every level appears; unused levels get n = 0, NA values their own row.

    ``levels`` is a one-column frame of the level domain (one row per level).
    The counts are aggregated first, so the join is between two small tables.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"), *aggs)
    lv = levels.select(F.col(levels.columns[0]).alias(col)).where(F.col(col).isNotNull()).distinct()
    out = lv.join(counts, col, "left").unionByName(counts.where(F.col(col).isNull()))
    return out.withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint"))


def keep_on_rows(df: DataFrame, by: Sequence[str], summary: DataFrame) -> DataFrame:
    """Grouped ``mutate(stat = f(x))``: aggregate once, join the result back on the keys.

    Scales better than a window that buffers a whole group in one task; the
    join is null-safe so an NA key keeps its group's statistic.  It is left to
    the planner, which broadcasts the summary once its real size is known to be
    small and splits hot keys otherwise.
    """
    s = summary.select(*[F.col(b).alias(f"_k_{b}") for b in by],
                       *[c for c in summary.columns if c not in by])
    return df.join(s, match_groups(df, s, [(b, f"_k_{b}") for b in by]), "left").drop(*[f"_k_{b}" for b in by])
