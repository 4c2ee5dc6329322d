"""Exact quantiles by the distributed scan: equal to type-7 quantiles, hot groups included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.plans.ordered import exact_quantiles, quantiles_of, value_scan
from tessera.plans import select
from tessera.plans.select import quantile_positions, thin_scan


def test_matches_numpy_type7(spark):
    rng = random.Random(3)
    rows = []
    for i in range(5000):
        g = "hot" if rng.random() < 0.7 else rng.choice("abc")
        rows.append((g, rng.gauss(0, 1) if rng.random() > 0.05 else None))
    d = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    got = {r["g"]: r for r in exact_quantiles(d, "x", probs, by=["g"], with_n=True).collect()}
    for g in {r[0] for r in rows}:
        xs = np.array([x for gg, x in rows if gg == g and x is not None])
        want = np.quantile(xs, probs)  # numpy's default "linear" = type 7
        for k, p in enumerate(probs):
            assert got[g][f"q{k}"] == pytest.approx(want[k], rel=1e-12, abs=1e-12)
        assert got[g]["n"] == len(xs)


def test_ties_and_single_value(spark):
    d = spark.createDataFrame([("a", 1.0)] * 5 + [("a", 2.0)] * 5 + [("b", 7.0)], "g string, x double")
    got = {r["g"]: (r["q0"], r["q1"]) for r in exact_quantiles(d, "x", [0.5, 0.9], by=["g"]).collect()}
    assert got["a"] == (pytest.approx(1.5), pytest.approx(2.0))
    assert got["b"] == (7.0, 7.0)


def test_global_median_of_integers(spark):
    d = spark.range(1, 101).select(F.col("id").cast("double").alias("x"))
    assert exact_quantiles(d, "x", [0.5]).first()["q0"] == 50.5


def wide(spark, n=60_000):
    """A hot group, a middling one, small ones and one of NA; ties, NaN and NA among the values."""
    u = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_000))
    g = F.when(u < 600_000, "hot").when(u < 900_000, "mid").when(u < 990_000, F.concat(F.lit("s"), (u % 40).cast("string"))).when(u < 995_000, F.lit(None))
    v = F.pmod(F.xxhash64("id", F.lit(4)), F.lit(1_000_000)) / 1000.0
    v = F.when(v < 20, None).when(v < 30, float("nan")).when(v < 300, F.round(v / 40)).otherwise(v * v)
    return spark.range(n).repartition(6).select(g.alias("g"), F.when(g == "s7", None).otherwise(v).alias("x"))


PROBS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.999, 1.0]


@pytest.mark.parametrize("few", [10_000, 1])
@pytest.mark.parametrize("small, limit", [(4096, 100_000), (50, 40), (1, 1000)])
def test_brackets_equal_spark_percentile(spark, small, limit, few):
    """Also where brackets are narrowed in several passes and joined from a stored table."""
    d = wide(spark)
    thin = thin_scan(d, ["g"], "x", quantile_positions(PROBS), small=small, limit=limit, few=few)
    got = {r["g"]: [r[f"q{i}"] for i in range(len(PROBS))] for r in quantiles_of(thin, "x", PROBS, ["g"]).collect()}
    want = {r["g"]: r["q"] for r in d.groupBy("g").agg(F.percentile(F.nanvl("x", F.lit(None)), PROBS).alias("q")).collect()}
    assert got.keys() == want.keys() and got["s7"] == [None] * len(PROBS)
    for g, q in want.items():
        assert got[g] == (pytest.approx(q, rel=1e-12) if q else [None] * len(PROBS))


def test_wanted_positions_equal_the_whole_scan(spark):
    d = wide(spark, 30_000).where("g is null or g <> 's7'")
    at = quantile_positions([0.3, 0.9])
    hit = F.exists(at(F.col("_total")), lambda p: (p > F.col("_cum") - F.col("_n")) & (p <= F.col("_cum")))
    whole = value_scan(d, ["g"], "x").where(hit).select("g", "x", "_n", "_cum", "_total")
    thin = thin_scan(d, ["g"], "x", at, small=100, limit=500).where(hit).select("g", "x", "_n", "_cum", "_total")
    assert sorted(whole.collect(), key=str) == sorted(thin.collect(), key=str)


def test_no_row_is_shuffled_by_range(spark):
    d = wide(spark, 20_000)
    q = exact_quantiles(d, "x", [0.5], by=["g"])
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "InArrow" not in plan and "SortMergeJoin" not in plan
    kept = thin_scan(d, ["g"], "x", quantile_positions([0.5]), small=1000).where("g = 'hot'").count()
    assert 0 < kept < 0.05 * d.where("g = 'hot'").count()


def test_no_keys_integers_and_nothing(spark):
    d = spark.range(1, 50_001).select(F.col("id").alias("x"))
    r = exact_quantiles(d, "x", [0.5, 0.1], with_n=True).first()
    assert (r["q0"], r["q1"], r["n"]) == (25000.5, pytest.approx(5000.9), 50_000)
    big = spark.createDataFrame([(2 ** 60 + i,) for i in range(101)], "x bigint")  # not told apart as doubles
    assert thin_scan(big, [], "x", quantile_positions([0.5]), small=1).where("_cum - _n < 51 and 51 <= _cum").first()["x"] == 2 ** 60 + 50
    assert exact_quantiles(d.limit(0), "x", [0.5], by=[]).count() in (0, 1)
    assert exact_quantiles(d.limit(0).withColumn("g", F.lit(1)), "x", [0.5], by=["g"]).count() == 0


def test_common_values_beside_a_quantile_do_not_hold_up_the_selection(spark, monkeypatch):
    # the quartiles lie where one common value meets the next: no sketch splits such a bracket by rows
    passes, fixed = [], select._fixed

    def counting(df, most):
        passes.append(1)
        if len(passes) > 6:
            raise AssertionError("the brackets do not get smaller")
        return fixed(df, most)

    monkeypatch.setattr(select, "_fixed", counting)
    d = spark.range(40000).select(F.round(F.col("id") / 4000).alias("x"))
    d = d.unionByName(spark.range(30000).select((F.col("id") / 1000 + 20).alias("x")))
    probs = [0.25, 0.5, 10000.5 / 70000, 0.9]
    got = quantiles_of(thin_scan(d, [], "x", quantile_positions(probs), small=100, limit=150), "x", probs, []).first()
    want = np.quantile(np.concatenate([np.floor(np.arange(40000) / 4000 + 0.5), np.arange(30000) / 1000 + 20]), probs)
    assert np.allclose(list(got), want)
