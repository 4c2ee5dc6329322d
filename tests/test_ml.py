"""Splits, metrics and planted-truth model recovery (simulated tables as in FIXTURES.md B)."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.functions.random import hash_normal, hash_uniform
from tessera.ml import metrics, models, splits, tune


def test_split_is_deterministic_and_proportional(spark):
    d = spark.range(20000).withColumn("g", (F.col("id") % 5).cast("string"))
    a = splits.initial_split(d, ["id"], 0.75, seed=1, strata=["g"])
    b = splits.initial_split(d.repartition(13), ["id"], 0.75, seed=1, strata=["g"])
    assert a.filter("split = 'train'").count() == b.filter("split = 'train'").count()
    share = a.groupBy("g").agg(F.avg((F.col("split") == "train").cast("double")).alias("p")).collect()
    assert all(abs(r["p"] - 0.75) < 0.03 for r in share)
    e = splits.initial_split(d, ["id"], 0.75, seed=1, strata=["g"], exact=True)
    assert e.filter("split = 'train'").count() == 5 * int(4000 * 0.75)


def test_auc_equals_pairwise_probability(spark):
    rng = np.random.default_rng(0)
    n = 600
    score = np.round(rng.random(n), 2)  # ties on purpose
    truth = np.where(rng.random(n) < score, "yes", "no")
    d = spark.createDataFrame([(str(t), float(s)) for t, s in zip(truth, score)], "truth string, score double")
    auc = metrics.roc_auc(d, "truth", "score", "yes").first()[0]
    pos, neg = score[truth == "yes"], score[truth == "no"]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert auc == pytest.approx(want)
    curve = metrics.roc_curve(d, "truth", "score", "yes").orderBy("threshold").collect()
    xs = [1 - r["specificity"] for r in curve][::-1]
    ys = [r["sensitivity"] for r in curve][::-1]
    assert np.trapezoid(ys, xs) == pytest.approx(want)


def test_confusion_summary(spark):
    rows = [("a", "a")] * 40 + [("a", "b")] * 10 + [("b", "a")] * 20 + [("b", "b")] * 30
    d = spark.createDataFrame(rows, "truth string, est string")
    m = {r["metric"]: r["estimate"] for r in metrics.conf_mat_summary(d, "truth", "est", "a").collect()}
    assert m["sens"] == pytest.approx(0.8) and m["spec"] == pytest.approx(0.6)
    assert m["accuracy"] == pytest.approx(0.7) and m["ppv"] == pytest.approx(40 / 60)
    cm = metrics.conf_mat(d, "truth", "est", ["a", "b"]).collect()
    assert sum(r["n"] for r in cm) == 100 and len(cm) == 4


def test_planted_linear_model(spark):
    # y = -1.6 + 0.03 x + N(0, 0.1), x ~ U(18, 60)
    d = spark.range(5000).select(
        (18 + 42 * hash_uniform(1, "id")).alias("x"), "id").withColumn(
        "y", -1.6 + 0.03 * F.col("x") + 0.1 * hash_normal(2, "id"))
    x = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    m = models.linear_reg(labelCol="y").fit(x)
    td = {r["term"]: r for r in models.tidy_linear(spark, m, ["x"]).collect()}
    assert abs(td["x"]["estimate"] - 0.03) < 3 * td["x"]["std_error"]
    assert abs(td["(Intercept)"]["estimate"] + 1.6) < 3 * td["(Intercept)"]["std_error"]


def test_planted_logistic_glm(spark):
    d = spark.range(20000).select((18 + 42 * hash_uniform(1, "id")).alias("x"), "id")
    d = d.withColumn("label", (hash_uniform(9, "id") < 1 / (1 + F.exp(1.6 - 0.03 * F.col("x")))).cast("double"))
    x = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    m = models.logistic_glm().fit(x)
    td = {r["term"]: r for r in models.tidy_glm(spark, m, ["x"]).collect()}
    assert abs(td["x"]["estimate"] - 0.03) < 3 * td["x"]["std_error"]


def test_penalty_grid_and_design():
    g = tune.penalty_grid()
    assert len(g) == 20 and g[0] == pytest.approx(1e-4) and g[-1] == pytest.approx(1e-2)
    pts = tune.latin_hypercube({"a": (0, 10), "b": (2, 40)}, 10, seed=1, integer=["b"])
    assert len(pts) == 10
    assert sorted(int(p["a"]) for p in pts) == list(range(10))  # one point per stratum


def test_strata_are_cut_to_the_row(spark):
    d = spark.range(1003).withColumn("g", F.when(F.col("id") % 10 == 0, "rare").otherwise("common"))
    s = splits.initial_split(d, ["id"], 0.75, seed=3, strata=["g"])
    n = {(r["g"], r["split"]): r["count"] for r in s.groupBy("g", "split").count().collect()}
    assert n[("rare", "train")] == int(101 * 0.75) and n[("common", "train")] == int(902 * 0.75)
    again = splits.initial_split(d.repartition(7), ["id"], 0.75, seed=3, strata=["g"])
    assert s.where("split = 'train'").select("id").exceptAll(again.where("split = 'train'").select("id")).count() == 0


def test_planted_network(spark):
    from tessera.ml import network
    d = spark.range(8000).select(hash_normal(1, "id").alias("a"), hash_normal(2, "id").alias("b"), "id")
    z = -2 + 5 / (1 + F.exp(-(0.3 + 1.5 * F.col("a") - 0.8 * F.col("b"))))
    d = d.withColumn("label", (hash_uniform(5, "id") < 1 / (1 + F.exp(-z))).cast("double"))
    x = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(d)
    free, tied = network.fit_candidates(x, [0.001, 1000])
    if free[0] < 0:  # the mirrored unit is the same function
        free = np.array([-free[0], free[1] + free[0], *(-free[2:])])
    assert np.allclose(free, [5, -2, 0.3, 1.5, -0.8], atol=0.5)
    assert np.abs(tied).max() < 0.5  # a large penalty holds all weights near zero
    p = x.select(F.avg(network.probability(free)).alias("p"), F.avg("label").alias("y")).first()
    assert p["p"] == pytest.approx(p["y"], abs=0.01)


def test_level_names_do_not_clash():
    from tessera.ml.recipe import level_names
    assert level_names("x", ["b c", "b-c", "d"]) == {"b c": "x_b_c", "b-c": "x_b_c_2", "d": "x_d"}


def test_dummies_report_unseen_levels(spark):
    from tessera.ml.recipe import StepDummy
    m = StepDummy(["c"]).fit(spark.createDataFrame([("a",), ("b",)], "c string"))
    new = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    assert [tuple(r) for r in m.unseen(new).collect()] == [("c", 1)]
    assert [r["c_b"] for r in m.transform(new).collect()][:2] == [0.0, 0.0]


def test_generalised_vif_of_one_column_terms(spark):
    from tessera.ml import diagnostics
    d = spark.range(2000).select(hash_normal(1, "id").alias("a"), hash_normal(2, "id").alias("e")).withColumn("b", F.col("a") + F.col("e"))
    v = {r["term"]: r["vif"] for r in diagnostics.vif(d, ["a", "b"]).collect()}
    g = {r["term"]: r["gvif"] for r in diagnostics.gvif(d, {"a": ["a"], "b": ["b"]}).collect()}
    assert g["a"] == pytest.approx(v["a"]) and g["b"] == pytest.approx(v["b"])


def test_several_csv_sentinels(spark):
    from tessera.sources.csv import read_csv, stage_csv
    src = spark.createDataFrame([("1", "x", "1.5"), ("-1", "NA", "NA"), ("3", "", "-1")], "a string, b string, c string")
    got = read_csv(spark, stage_csv(src, "na"), na=["-1", "NA"])
    assert dict(got.dtypes) == {"a": "int", "b": "string", "c": "double"}
    assert sorted((r["a"] or 0, r["b"] or "", r["c"] or 0) for r in got.collect()) == [(0, "", 0), (1, "x", 1.5), (3, "", 0)]


def test_cut_width_lowest_edge(spark):
    from tessera.functions.scalars import cut_width_bin
    d = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,)], "x double")
    got = [r[0] for r in d.orderBy("x").select(cut_width_bin("x", 2.0, 0.0, F.lit(0.0))).collect()]
    assert got == [1.0, 1.0, 1.0, 3.0]


def test_late_flights_recover_the_planted_relation(spark):
    from tessera.sources.tables import Tables
    from tessera.workloads import ml_q
    pm, scored, names = ml_q._late_fit(Tables(spark, "/root/testdata/sf0.001"))
    td = {r["term"]: r for r in models.tidy_glm(spark, pm.stages[-1], names).collect()}
    _, per_time, _ = ml_q.LATE_ODDS
    assert abs(td["dep_time"]["estimate"] - per_time) < 3 * td["dep_time"]["std_error"]
    auc = metrics.roc_auc(scored, "arr_delay", "pred_late", "late").first()[0]
    assert auc > 0.65


@pytest.mark.parametrize("strata", [["g", "h"], []])
def test_split_by_selection_equals_ranks(spark, strata, monkeypatch):
    d = spark.range(6000).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 > 1, "x").alias("h"))
    d = d.unionByName(spark.createDataFrame([(9999, 77, "only")], d.schema))  # a stratum of one row: none of it is in the first part
    a = splits.split_column(d, ["id"], 0.75, 3, strata, exact=True)
    assert "rangepartitioning" not in a._jdf.queryExecution().executedPlan().toString()
    a = a.select("id", "split").collect()
    monkeypatch.setattr(splits, "_cuts", lambda *_: None)
    b = splits.split_column(d, ["id"], 0.75, 3, strata, exact=True).select("id", "split").collect()
    assert sorted(a) == sorted(b) and len({r["split"] for r in a}) == 2
