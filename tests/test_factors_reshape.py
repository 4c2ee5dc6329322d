"""Factors, reshaping, completion and filling (FIXTURES.md B literals)."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import factors, reshape
from tessera.operators.agg import count_with_levels


def test_factor_vs_fct(spark):
    d = spark.createDataFrame([("Dec",), ("Apr",), ("Jam",), ("Mar",)], "m string")
    out = factors.fct_new(d, "m", factors.MONTH_ABB)
    assert sorted((r["m"], r["m_ord"]) for r in out.collect() if r["m"]) == [("Apr", 4), ("Dec", 12), ("Mar", 3)]
    assert out.filter(F.col("m").isNull()).count() == 1
    with pytest.raises(factors.UnknownLevelError):
        factors.fct_strict(d, "m", factors.MONTH_ABB)
    ok = spark.createDataFrame([("Dec",), ("Apr",), ("Jan",), ("Mar",)], "m string")
    lv = factors.levels_sorted(factors.fct_strict(ok, "m", factors.MONTH_ABB).orderBy("m_ord"), "m")
    assert lv.count() == 4


def test_level_orders(spark):
    d = spark.createDataFrame([("a", 3.0), ("a", 5.0), ("b", 1.0), ("c", 2.0), ("c", 2.0), ("c", 9.0)], "f string, x double")
    med = {r["level"]: r["ord"] for r in factors.fct_reorder_median(d, "f", "x").collect()}
    assert med == {"b": 1, "c": 2, "a": 3}
    inf = {r["level"]: r["ord"] for r in factors.fct_infreq(d, "f").collect()}
    assert inf == {"c": 1, "a": 2, "b": 3}
    rev = {r["level"]: r["ord"] for r in factors.fct_rev(factors.fct_infreq(d, "f")).collect()}
    assert rev == {"c": 3, "a": 2, "b": 1}
    rel = {r["level"]: r["ord"] for r in factors.fct_relevel(factors.levels_sorted(d, "f"), ["c"]).collect()}
    assert rel == {"c": 1, "a": 2, "b": 3}


def test_recode_merges(spark):
    d = spark.createDataFrame([("x",), ("y",), ("z",)], "f string")
    out = sorted(r[0] for r in d.select(factors.fct_recode("f", {"new": ["x", "y"]})).collect())
    assert out == ["new", "new", "z"]


def test_lump_rules(spark):
    counts = spark.createDataFrame([("a", 100), ("b", 30), ("c", 20), ("d", 5), ("Other", 3)], "level string, n long")
    low = {r["level"]: r["new_level"] for r in factors.lump_lowfreq_table(counts).collect()}
    # 100 > 58 (sum of the rest): everything after "a" is lumped
    assert low == {"a": "a", "b": "Other", "c": "Other", "d": "Other", "Other": "Other"}
    top2 = {r["level"]: r["new_level"] for r in factors.lump_n_table(counts, 2).collect()}
    assert top2 == {"a": "a", "b": "b", "c": "Other", "d": "Other", "Other": "Other"}
    # only one level would be lumped: nothing is lumped
    keep = {r["level"]: r["new_level"] for r in factors.lump_n_table(counts, 4).collect()}
    assert keep["Other"] == "Other" and keep["d"] == "d"


def stocks(spark):
    rows = [(2020, 1, 1.88), (2020, 2, 0.59), (2020, 3, 0.35), (2020, 4, None), (2021, 2, 0.92), (2021, 3, 0.17),
            (2021, 4, 2.66)]
    return spark.createDataFrame(rows, "year long, qtr long, price double")


def test_pivot_roundtrip_and_complete(spark):
    s = stocks(spark)
    wide = reshape.pivot_wider(s, ["year"], "qtr", "price", [1, 2, 3, 4], prefix="q")
    assert wide.count() == 2
    assert wide.filter(F.col("year") == 2021).first()["q1"] is None
    long = reshape.pivot_longer(wide, ["year"], ["q1", "q2", "q3", "q4"], "qtr", "price")
    assert long.count() == 8
    comp = reshape.complete(s, "year", {"qtr": reshape.domain(s, "qtr")})
    assert comp.count() == 8
    rng = reshape.complete(s.withColumn("k", F.lit(1)), "k", {"year": [2019, 2020, 2021], "qtr": [1, 2, 3, 4]})
    assert rng.count() == 12


def test_fill_down(spark):
    rows = [(1, "Derrick Whitmore", 1, 7.0), (2, None, 2, 10.0), (3, None, 3, None), (4, "Katherine Burke", 1, 4.0)]
    d = spark.createDataFrame(rows, "i int, person string, treatment int, response double")
    f = reshape.fill_down(d, [], ["i"], ["person", "response"]).orderBy("i").collect()
    assert [r["person"][0] for r in f] == ["D", "D", "D", "K"]
    assert [r["response"] for r in f] == [7, 10, 10, 4]
    z = reshape.fill_down(d.withColumn("response", F.coalesce("response", F.lit(0.0))), [], ["i"], ["person"])
    assert [r["response"] for r in z.orderBy("i").collect()] == [7, 10, 0, 4]


def test_count_with_empty_level(spark):
    health = spark.createDataFrame([("Ikaia", 34, "no"), ("Oletta", 88, "no"), ("Leriah", 75, "no"),
                                    ("Dashay", 47, "no"), ("Tresaun", 56, "no")], "name string, age int, smoker string")
    levels = spark.createDataFrame([("yes",), ("no",)], "smoker string")
    out = {r["smoker"]: (r["n"], r["mean_age"]) for r in
           count_with_levels(health, "smoker", levels, F.avg("age").alias("mean_age")).collect()}
    assert out["no"] == (5, 60.0) and out["yes"] == (0, None)


def test_interaction_of_na_is_na(spark):
    from tessera.operators.factors import fct_interaction
    d = spark.createDataFrame([("1", None), (None, "b"), ("1", "b")], "x string, y string")
    assert [r[0] for r in d.select(fct_interaction("x", "y")).collect()] == [None, None, "1.b"]
