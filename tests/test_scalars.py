"""Scalar, logical and conditional functions on the reference's literal vectors (FIXTURES.md B)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import logic, scalars


def vals(spark, xs, typ="double"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {typ}")


def run(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_recycle(spark):
    df = vals(spark, [1.0, 2.0, 10.0, 20.0]).withColumn("pos", F.col("i") + 1)
    assert run(df, F.col("x") / 5) == [0.2, 0.4, 2.0, 4.0]
    assert run(df, F.col("x") * scalars.recycle("pos", [1, 2])) == [1, 4, 10, 40]
    assert run(df, F.col("x") * scalars.recycle("pos", [1, 2, 3])) == [1, 4, 30, 20]


def test_pmin_pmax_vs_column_min(spark):
    df = spark.createDataFrame([(0, 1.0, 3.0), (1, 5.0, 2.0), (2, 7.0, None)], "i int, x double, y double")
    assert run(df, F.least("x", "y")) == [1, 2, 7]
    assert run(df, F.greatest("x", "y")) == [3, 5, 7]
    assert df.agg(F.min(F.least("x", "y")), F.max(F.greatest("x", "y"))).first() == (1.0, 7.0)


def test_intdiv_mod(spark):
    df = vals(spark, list(range(1, 11)), "int")
    assert run(df, scalars.intdiv("x", 3)) == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3]
    assert run(df, scalars.r_mod("x", 3)) == [1, 2, 0, 1, 2, 0, 1, 2, 0, 1]
    neg = vals(spark, [-7, 7, -6], "int")
    # R: -7 %% 3 = 2, 7 %% -3 = -2, -6 %% 3 = 0; -7 %/% 3 = -3
    assert run(neg, scalars.r_mod("x", 3)) == [2, 1, 0]
    assert run(neg, scalars.r_mod("x", -3)) == [-1, -2, 0]
    assert run(neg, scalars.intdiv("x", 3)) == [-3, 2, -2]
    assert run(neg, scalars.intdiv("x", 0)) == [None, None, None]


def test_rounding(spark):
    df = vals(spark, [123.456])
    assert run(df, scalars.round_even("x")) == [123]
    assert run(df, scalars.round_even("x", 2)) == [123.46]
    assert run(df, scalars.round_even("x", 1)) == [123.5]
    assert run(df, scalars.round_even("x", -1)) == [120]
    assert run(df, scalars.round_even("x", -2)) == [100]
    assert run(df, scalars.round_multiple("x", 4)) == [124]
    assert run(df, scalars.round_multiple("x", 0.25)) == [123.5]
    assert run(vals(spark, [1.5, 2.5]), scalars.round_even("x")) == [2, 2]


def test_cut_breaks(spark):
    x = vals(spark, [1.0, 2.0, 5.0, 10.0, 15.0, 20.0])
    assert run(x, scalars.cut_breaks("x", [0, 5, 10, 15, 20], ["sm", "md", "lg", "xl"])) == \
        ["sm", "sm", "sm", "md", "lg", "xl"]
    y = vals(spark, [None, -10.0, 5.0, 10.0, 30.0])
    assert run(y, scalars.cut_breaks("y" if False else "x", [0, 5, 10])) == [None, None, "(0,5]", "(5,10]", None]


def test_cut_width_centres(spark):
    df = vals(spark, [0.1, 0.25, 0.26, 0.74, 0.75, 0.76])
    # bins centred on multiples of 0.5, right-closed: (-.25,.25], (.25,.75], (.75,1.25]
    assert run(df, scalars.cut_width_bin("x", 0.5)) == [0.0, 0.0, 0.5, 0.5, 0.5, 1.0]


def test_log_edge_cases(spark):
    df = vals(spark, [0.0, -1.0, math.e])
    out = run(df, scalars.r_log("x"))
    assert out[0] == float("-inf") and math.isnan(out[1]) and out[2] == pytest.approx(1.0)


def test_near(spark):
    df = vals(spark, [2.0])
    s2 = F.sqrt(F.lit(2.0)) * F.sqrt(F.lit(2.0))
    assert run(df, logic.near(s2, "x")) == [True]
    assert run(df, logic.near(s2, "x", 1e-16)) == [False]


def test_in_never_na(spark):
    df = vals(spark, [None, 1.0, 2.0])
    assert run(df, logic.r_in("x", [1.0])) == [False, True, False]
    assert run(df, logic.r_in("x", [None])) == [True, False, False]
    assert run(df, F.col("x") == F.lit(None)) == [None, None, None]


def test_kleene(spark):
    df = spark.createDataFrame([(0, True), (1, False), (2, None)], "i int, x boolean")
    na = F.lit(None).cast("boolean")
    assert run(df, F.col("x") & na) == [None, False, None]
    assert run(df, F.col("x") | na) == [True, None, None]


def test_nan_vs_na(spark):
    df = vals(spark, [None, float("nan"), 1.0])
    assert run(df, logic.is_na("x", df.schema["x"].dataType)) == [True, True, False]
    assert run(df, F.isnan("x")) == [False, True, False]
    z = vals(spark, [0.0])
    inf = logic.r_divide(F.lit(1.0), F.col("x"))
    res = z.select(logic.r_divide("x", "x"), F.col("x") * inf, inf - inf, F.sqrt(F.lit(-1.0))).first()
    assert all(math.isnan(v) for v in res)


def test_if_else_missing_and_case_when(spark):
    df = vals(spark, [-3.0, 0.0, 3.0, None])
    assert run(df, logic.if_else(F.col("x") > 0, "+", "-", "?")) == ["-", "-", "+", "?"]
    assert run(df, logic.if_else(F.col("x") > 0, "+", "-")) == ["-", "-", "+", None]
    # overlapping arms: the first match wins, "big" never appears
    cw = logic.case_when((F.col("x") > 0, F.lit("+ve")), (F.col("x") > 2, F.lit("big")), (F.col("x") < 0, F.lit("-ve")))
    assert run(df, cw) == ["-ve", None, "+ve", None]


def test_type_mismatch_raises(spark):
    df = vals(spark, [1.0])
    with pytest.raises(TypeError):
        logic.check_branch_types(df, F.lit("a"), F.lit(1))
    with pytest.raises(TypeError):
        logic.check_branch_types(df, F.lit("a"), F.current_timestamp())
    logic.check_branch_types(df, F.lit(1), F.col("x"))


def test_bool_aggregates(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", False), ("b", True), ("c", None)], "g string, v boolean")
    out = {r["g"]: (r["all"], r["any"], r["mn"]) for r in df.groupBy("g").agg(
        logic.all_na_rm("v").alias("all"), logic.any_na_rm("v").alias("any"),
        F.min(F.col("v").cast("int")).alias("mn")).collect()}
    assert out["a"] == (True, True, 1)
    assert out["b"] == (False, True, 0)
    assert out["c"][:2] == (True, False)  # empty after na.rm
