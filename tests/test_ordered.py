"""The one-shuffle ordered scan against windows, and what it must not lose: ties, NA keys, all-NA groups."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tessera.operators import reshape, stats, windows
from tessera.operators.agg import count_with_levels
from tessera.plans.ordered import exact_quantiles, scan, value_scan


def rows(spark, n=300):
    rng = random.Random(1)
    data = [(i, rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, 1, 2, 0, 0]), rng.random() if rng.random() > .1 else None)
            for i in range(n)]
    return spark.createDataFrame(data, "i int, g string, v int, x double").repartition(4)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_scan_equals_windows(spark, parts):
    d = rows(spark).withColumn("x0", F.coalesce("x", F.lit(0.0)))
    w = Window.partitionBy("g").orderBy("i")
    want = (d.withColumn("p", F.row_number().over(w)).withColumn("s", F.when(F.count_if(F.col("v").isNull()).over(w) == 0, F.sum("v").over(w)))
            .withColumn("sx", F.round(F.sum("x0").over(w), 6)).withColumn("l2", F.lag("x", 2).over(w)).withColumn("f1", F.lead("v", 1).over(w))
            .withColumn("f3", F.lead("g", 3).over(w)).withColumn("fl", F.last("v", True).over(w)))
    got = scan(d, ["g"], ["i"], pos="p", sums=[("v", "s"), ("x0", "sx")], lags=[("x", 2, "l2"), ("v", -1, "f1"), ("g", -3, "f3")],
               fills=[("v", "fl")], num_partitions=parts).withColumn("sx", F.round("sx", 6))
    cols = ["i", "p", "s", "sx", "l2", "f1", "f3", "fl"]
    assert sorted(want.select(*cols).collect()) == sorted(got.select(*cols).collect())


def test_batches_smaller_than_the_offsets(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = scan(spark.range(20).toDF("i"), [], ["i"], lags=[("i", 5, "b"), ("i", -5, "a")], num_partitions=3).orderBy("i").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r["b"] for r in got] == [None] * 5 + list(range(15)) and [r["a"] for r in got] == list(range(5, 20)) + [None] * 5


def test_a_run_of_equal_values_spreads_over_partitions(spark):
    d = spark.range(20000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(0)).alias("x"))
    got = scan(d, [], ["x"], pos="p", num_partitions=8).withColumn("pid", F.spark_partition_id())
    sizes = sorted(r["count"] for r in got.groupBy("pid").count().collect())
    assert len(sizes) >= 7 and sizes[-1] < 2 * 20000 / 8
    assert sorted(r["p"] for r in got.select("p").collect()) == list(range(1, 20001))


def test_all_na_groups_and_na_keys_stay(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 5.0), (None, None)], "g string, x double")
    q = {r["g"]: (r["q0"], r["n"]) for r in exact_quantiles(d, "x", [0.5], by=["g"], with_n=True).collect()}
    assert q == {"a": (2.0, 2), "b": (None, 0), None: (5.0, 1)}
    box = {r["g"]: (r["middle"], r["n"], r["n_out"]) for r in stats.boxplot_stats(d, "x", ["g"]).collect()}
    assert box == {"a": (2.0, 2, 0), "b": (None, 0, 0), None: (5.0, 1, 0)}
    assert value_scan(d, ["g"], "x").where("g = 'b'").first()["_total"] == 0
    r = {(x["g"], x["x"]): x["r"] for x in windows.min_rank(d, ["g"], "x", "r").collect()}
    assert r[(None, 5.0)] == 1 and r[("b", None)] is None and r[("a", 3.0)] == 2


def test_complete_keeps_na_keys_and_rows_outside_the_domain(spark):
    d = spark.createDataFrame([(1, "x", 5), (2, None, 6), (9, "y", 7)], "k int, c string, v int")
    full = reshape.complete(d, "k", {"c": reshape.domain(d, "c")})
    assert full.count() == 9 and full.where("v is not null").count() == 3
    part = reshape.complete(d, "c", {"k": [1, 2, 3]})
    assert part.count() == 10 and part.where("k = 9").first()["v"] == 7


def test_complete_expands_a_domain_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(reshape, "CHUNK", 7)
    d = spark.range(50).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"), F.lit(1).alias("v"))
    assert reshape.complete(d, "a", {"b": reshape.domain(d, "b")}).count() == 150


def test_na_has_its_own_count(spark):
    d = spark.createDataFrame([("a",), (None,), (None,)], "f string")
    lv = spark.createDataFrame([("a",), ("b",)], "f string")
    assert {r["f"]: r["n"] for r in count_with_levels(d, "f", lv).collect()} == {"a": 1, "b": 0, None: 2}


def test_letters_have_no_limit(spark):
    n = 10 ** 11
    depths = spark.range(1).select(stats.letter_depths(F.lit(n)).alias("d")).first()["d"]
    assert len(depths) == 33 and depths[0] == (n + 1) / 2
    d, want = (n + 1) / 2.0, []
    for _ in range(33):
        want.append(d)
        d = (d // 1 + 1) / 2.0
    assert depths == want


def test_density_has_every_grid_point(spark):
    d = spark.createDataFrame([("a", 0.0), ("a", 0.1), ("b", 10.0)], "g string, x double")
    k = stats.kde(d, "x", 0.05, by=["g"])
    assert k.groupBy("g").count().collect() and all(r["count"] == 512 for r in k.groupBy("g").count().collect())
    area = k.groupBy("g").agg(F.sum("density") * (10 / 511)).collect()
    assert all(0.4 < r[1] < 1.1 for r in area)


def keyed(spark, n=400):
    """Rows with two nullable keys and a key that may be NaN: hashes that skip NA would take ("b", NA) and (NA, "b") for one."""
    rng = random.Random(6)
    nan = float("nan")
    data = [(i, rng.choice(["a", "b", None]), rng.choice(["a", "b", None]), rng.choice([0.0, nan, None]), rng.choice([None, 1, 2, 5]),
             rng.choice([None, 0.5, 1.5, 7.0, 11.5])) for i in range(n)]
    return spark.createDataFrame(data, "i int, g string, h string, f double, v int, x double").repartition(4)


@pytest.mark.parametrize("parts", [1, 7, 60])
@pytest.mark.parametrize("by", [["g", "h"], ["g", "h", "f"]])
def test_groups_are_told_apart_by_their_values(spark, parts, by):
    d = keyed(spark)
    w = Window.partitionBy(*by).orderBy("i")
    want = (d.withColumn("p", F.row_number().over(w)).withColumn("s", F.when(F.count_if(F.col("v").isNull()).over(w) == 0, F.sum("v").over(w)))
            .withColumn("l", F.lag("x", 1).over(w)).withColumn("a", F.lead("v", 2).over(w)).withColumn("fl", F.last("v", True).over(w)))
    got = scan(d, by, ["i"], pos="p", sums=[("v", "s")], lags=[("x", 1, "l"), ("v", -2, "a")], fills=[("v", "fl")], num_partitions=parts)
    cols = ["i", "p", "s", "l", "a", "fl"]
    assert sorted(want.select(*cols).collect()) == sorted(got.select(*cols).collect())


def test_the_four_row_probe(spark):
    d = spark.createDataFrame([(1, "b", None, 1.0), (2, "b", None, 2.0), (3, None, "b", 11.0), (4, None, "b", 12.0)], "i int, x string, y string, v double")
    got = {r["i"]: (r["p"], r["s"], r["l"]) for r in scan(d, ["x", "y"], ["i"], pos="p", sums=[("v", "s")], lags=[("v", 1, "l")]).collect()}
    assert got == {1: (1, 1.0, None), 2: (2, 3.0, 1.0), 3: (1, 11.0, None), 4: (2, 23.0, 11.0)}
    assert {(r["x"], r["y"]): r["q0"] for r in exact_quantiles(d, "v", [0.5], by=["x", "y"]).collect()} == {("b", None): 1.5, (None, "b"): 11.5}


def test_ranks_and_quantiles_with_two_nullable_keys(spark):
    d = keyed(spark)
    w = Window.partitionBy("g", "h").orderBy("x")
    known = F.col("x").isNotNull()
    want = d.where(known).withColumn("r", F.rank().over(w)).select("i", "r").collect()
    got = windows.min_rank(d, ["g", "h"], "x", "r").where(known).select("i", F.col("r").cast("int").alias("r")).collect()
    assert sorted(want) == sorted(got)
    want = {(r["g"], r["h"]): r["q"] for r in d.groupBy("g", "h").agg(F.percentile("x", 0.3).alias("q")).collect()}
    assert want == pytest.approx({(r["g"], r["h"]): r["q0"] for r in exact_quantiles(d, "x", [0.3], by=["g", "h"]).collect()})


@pytest.mark.parametrize("parts", [1, 5, 40])
@pytest.mark.parametrize("desc", [False, True])
def test_ranks_in_one_scan(spark, parts, desc):
    """Runs of equal values that fill whole partitions, two nullable keys, both directions."""
    d = keyed(spark, 300).withColumn("x", F.when(F.col("i") % 3 > 0, F.lit(1.5)).otherwise(F.col("x"))).where("x is not null")
    w = Window.partitionBy("g", "h").orderBy(F.desc("x") if desc else F.asc("x"))
    want = d.withColumn("r", F.rank().over(w)).select("i", "r").collect()
    got = scan(d, ["g", "h"], [F.desc("x") if desc else F.asc("x")], rank=("r", ["x"]), num_partitions=parts).select("i", F.col("r").cast("int").alias("r")).collect()
    assert sorted(want) == sorted(got)
    one = scan(d, [], [F.asc("x")], rank=("r", ["x"]), num_partitions=parts).groupBy("x").agg(F.countDistinct("r").alias("n"), F.min("r").alias("r")).collect()
    below = {r["x"]: d.where(F.col("x") < r["x"]).count() + 1 for r in one}
    assert all(r["n"] == 1 and r["r"] == below[r["x"]] for r in one)


def test_shares_of_ranks_equal_windows(spark):
    d = keyed(spark).withColumn("x", F.when(F.col("i") % 11 == 0, float("nan")).otherwise(F.col("x")))
    known = d.where("x is not null and not isnan(x)")
    w = Window.partitionBy("g").orderBy("x")
    for fn, name in ((windows.percent_rank, F.percent_rank), (windows.cume_dist, F.cume_dist)):
        want = {r["i"]: r["v"] for r in known.withColumn("v", name().over(w)).collect()}
        got = {r["i"]: r["v"] for r in fn(d, ["g"], "x", "v").collect()}
        assert len(got) == 400 and {k for k, v in got.items() if v is None} == set(range(400)) - set(want)
        assert {k: v for k, v in got.items() if v is not None} == pytest.approx(want)
