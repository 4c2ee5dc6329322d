"""Positions and running sums along an order, from DataFrame functions alone.

Rows are range-partitioned on (group, order) and sorted, so that a group of any
size spreads over partitions.  Counts and sums are taken inside each slice (a
partition's part of a group) and earlier slices' totals, a table of one row a
slice, are added by a join on the slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, shuffle_partitions


def _slices(df: DataFrame, by: str, order: list[Column]) -> DataFrame:
    keys = [F.col(by).asc_nulls_last(), *order]
    rows = (df.repartitionByRange(shuffle_partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
            .withColumn("_pid", F.spark_partition_id()).withColumn("_rid", F.monotonically_increasing_id()))
    return materialize(rows)  # fixes the slices for all later passes


def _before(slices: DataFrame, by: str, value: str) -> DataFrame:
    earlier = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    return (slices.withColumnsRenamed({by: "_g", "_pid": "_p"})
            .withColumn("_off", F.coalesce(F.sum(value).over(earlier), F.lit(0))).drop(value))


def positions(df: DataFrame, by: str, order: list[Column], name: str) -> DataFrame:
    """Number the rows of each group from 1 along the order."""
    rows = _slices(df, by, order)
    first = _before(rows.groupBy("_pid", by).agg(F.count("*").alias("_n"), F.min("_rid").alias("_r0")), by, "_n")
    return (rows.join(first, (rows["_pid"] == first["_p"]) & rows[by].eqNullSafe(first["_g"]))
            .withColumn(name, F.col("_off") + F.col("_rid") - F.col("_r0") + 1)
            .drop("_pid", "_rid", "_p", "_g", "_off", "_r0"))


def running_total(df: DataFrame, by: str, order: list[Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows of the group up to and including each row."""
    rows = _slices(df, by, order)
    inside = Window.partitionBy("_pid", by).orderBy("_rid").rowsBetween(Window.unboundedPreceding, 0)
    total = _before(rows.groupBy("_pid", by).agg(F.sum(value).alias("_s")), by, "_s")
    local = rows.withColumn(name, F.sum(value).over(inside))
    return (local.join(total, (local["_pid"] == total["_p"]) & local[by].eqNullSafe(total["_g"]))
            .withColumn(name, F.col(name) + F.col("_off")).drop("_pid", "_rid", "_p", "_g", "_off"))
