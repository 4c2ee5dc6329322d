"""Ranks, offsets and running values (FIXTURES.md B), and the distributed scan against plain windows."""

import random

from pyspark.sql import Window, functions as F

from tessera.operators import windows
from tessera.plans.ordered import group_positions, running_sum


def ranks_df(spark):
    return spark.createDataFrame([(i, x) for i, x in enumerate([1.0, 2.0, 2.0, 3.0, 4.0, None])], "i int, x double")


def by_i(df, c):
    return [r[c] for r in df.orderBy("i").collect()]


def test_min_rank_and_desc(spark):
    d = ranks_df(spark)
    assert by_i(windows.min_rank(d, [], "x", "r"), "r") == [1, 2, 2, 4, 5, None]
    assert by_i(windows.min_rank(d, [], "x", "r", desc=True), "r") == [5, 3, 3, 2, 1, None]


def test_dense_row_percent_cume(spark):
    d = ranks_df(spark)
    assert by_i(windows.dense_rank(d, [], "x", "r"), "r") == [1, 2, 2, 3, 4, None]
    assert by_i(windows.row_number(d, [], ["x", "i"], "r", na_col="x"), "r") == [1, 2, 3, 4, 5, None]
    assert by_i(windows.percent_rank(d, [], "x", "r"), "r") == [0.0, 0.25, 0.25, 0.75, 1.0, None]
    assert by_i(windows.cume_dist(d, [], "x", "r"), "r") == [0.2, 0.6, 0.6, 0.8, 1.0, None]


def test_cumsum_and_na_poison(spark):
    d = spark.createDataFrame([(i, float(i)) for i in range(1, 11)], "i int, x double")
    assert by_i(running_sum(d, [], ["i"], "x", "c"), "c") == [1, 3, 6, 10, 15, 21, 28, 36, 45, 55]
    d2 = spark.createDataFrame([(1, 1.0), (2, None), (3, 2.0)], "i int, x double")
    assert by_i(running_sum(d2, [], ["i"], "x", "c"), "c") == [1.0, None, None]


def test_lag_diff(spark):
    d = spark.createDataFrame([(i, x) for i, x in enumerate([2.0, 5.0, 11.0, 11.0, 19.0, 35.0])], "i int, x double")
    out = windows.lag(d, [], ["i"], "x", 1, name="prev")
    rows = out.orderBy("i").collect()
    assert [None if r["prev"] is None else r["x"] - r["prev"] for r in rows] == [None, 3, 6, 0, 8, 16]
    assert [None if r["prev"] is None else r["x"] == r["prev"] for r in rows] == [None, False, False, True, False, False]


def test_gap_groups(spark):
    times = [0, 1, 2, 3, 5, 10, 12, 15, 17, 19, 20, 27, 28, 30]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t int")
    d = windows.lag(d, [], ["i"], "t", 1, name="p")
    d = d.withColumn("f", F.when(F.col("t") - F.col("p") >= 5, 1).otherwise(0))
    assert by_i(running_sum(d, [], ["i"], "f", "g"), "g") == [0, 0, 0, 0, 0, 1, 1, 1, 1, 1, 1, 2, 2, 2]


def test_buckets(spark):
    d = spark.createDataFrame([(i,) for i in range(1, 11)], "i int")
    d = windows.row_number(d, [], ["i"], "rn")
    assert by_i(d, "rn") == list(range(1, 11))
    assert [r[0] for r in d.orderBy("i").select(F.pmod(F.col("rn") - 1, F.lit(3))).collect()] == [0, 1, 2, 0, 1, 2, 0, 1, 2, 0]


def test_distributed_scan_matches_plain_window(spark):
    # a hot group holding most rows, several partitions: the prefix scan equals the window result
    rng = random.Random(7)
    rows = [(i, "hot" if rng.random() < 0.6 else f"g{rng.randint(0, 5)}", float(rng.randint(-50, 50))) for i in range(3000)]
    d = spark.createDataFrame(rows, "i int, g string, x double").repartition(7)
    pos = group_positions(d, ["g"], ["x", "i"], name="p", num_partitions=11)
    cum = running_sum(d, ["g"], ["x", "i"], "x", "c", num_partitions=11)
    w = Window.partitionBy("g").orderBy("x", "i")
    ref = d.withColumn("rp", F.row_number().over(w)).withColumn(
        "rc", F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    got = pos.join(cum.select("i", "c"), "i").join(ref.select("i", "rp", "rc"), "i")
    assert got.filter((F.col("p") != F.col("rp")) | (F.col("c") != F.col("rc"))).count() == 0
    assert got.count() == 3000
