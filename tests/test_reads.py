"""How often the steps of a query read the rows they are given: once, where what they need is stored or counted on the way."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tessera.ml import metrics
from tessera.operators import windows
from tessera.workloads import composed, windows_q

N = 400


def counted(spark):
    """Flights by number, and the number of rows read from them so far (a shuffle lies behind the count, as behind a join)."""
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(N).select(
        F.col("id").alias("l_orderkey"), *[F.lit(1).cast("bigint").alias(c) for c in ("l_partkey", "l_suppkey", "l_linenumber")],
        F.lit(1.0).alias("l_extendedprice"), F.lit("2020-01-01").alias("l_shipdate"),
        (F.col("id") % 3 + 1).alias("month"), F.concat(F.lit("d"), F.col("id") % 5).alias("dest"), F.concat(F.lit("C"), F.col("id") % 4).alias("carrier"),
        (F.col("id") * 7 % 101).cast("double").alias("distance"), (F.col("id") % 11).cast("double").alias("dep_delay"),
        F.when(F.col("id") % 6 != 0, F.col("id") % 13).cast("double").alias("arr_delay"))

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return rows.mapInArrow(count, rows.schema).repartition(4), seen


@pytest.mark.parametrize("fn", [windows.percent_rank, windows.cume_dist, windows.min_rank])
def test_ranks_read_the_rows_once(spark, fn):
    d, seen = counted(spark)
    assert fn(d, ["dest"], "arr_delay", "r").filter("(r is null) = (arr_delay is null)").count() == N
    assert seen.value == N


def test_two_ranks_read_the_rows_once(spark):
    d, seen = counted(spark)
    windows_q.min_rank_q(SimpleNamespace(deliveries=d)).collect()
    assert seen.value == N


def test_group_statistics_read_the_rows_once(spark):
    d, seen = counted(spark)
    rows = windows_q.group_stat_mutate(SimpleNamespace(deliveries=d)).collect()
    assert len(rows) == N and seen.value == N


def test_month_heat_reads_the_rows_once(spark):
    d, seen = counted(spark)
    rows = composed.month_dest_heat(SimpleNamespace(deliveries=d)).collect()
    assert len(rows) == 15 and seen.value == N


def test_roc_curve_reads_the_rows_once(spark):
    d, seen = counted(spark)
    s = d.withColumn("truth", F.when(F.col("dep_delay") > 5, "late").otherwise("on_time"))
    assert metrics.roc_curve(s, "truth", "distance", "late").count() == 103
    assert seen.value == N
