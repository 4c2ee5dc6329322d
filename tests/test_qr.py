"""Least squares by TSQR: digits that normal equations lose, dependent columns, inference, influence."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from tessera.ml import diagnostics, models, qr


def frame(spark, x, y):
    cols = [f"x{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ", ".join(f"{c} double" for c in cols) + ", y double")
    return VectorAssembler(inputCols=cols, outputCol="features").transform(df.repartition(6)), cols


def test_condition_number_of_a_billion_keeps_six_digits(spark):
    rng = np.random.default_rng(0)
    n = 600
    x = rng.normal(size=(n, 3))
    x[:, 2] = x[:, 0] + 1e-9 * x[:, 2]
    want = np.array([1.0, 2.0, -3.0, 0.5])
    y = want[0] + x @ want[1:]
    a = np.concatenate([np.ones((n, 1)), x], 1)
    assert np.linalg.cond(a) > 1e9
    df, cols = frame(spark, x, y)
    m = models.linear_reg(labelCol="y").fit(df)
    # the two nearly equal columns: their sum is well determined, each of them to cond * eps
    assert m.coefficients[0] + m.coefficients[2] == pytest.approx(-0.5 + 3.0, abs=1e-6) and m.coefficients[1] == pytest.approx(-3.0, abs=1e-6)
    assert m.coefficients[2] == pytest.approx(0.5, abs=1e-5) and m.intercept == pytest.approx(1.0, abs=1e-6)
    assert np.linalg.matrix_rank(a.T @ a) < 4  # the cross products have lost it
    h = [r["leverage"] for r in diagnostics.influence(df.drop("features"), cols, "y", m.all).collect()]
    q, _ = np.linalg.qr(a)
    assert sum(h) == pytest.approx(4, abs=1e-6) and sorted(h) == pytest.approx(sorted((q * q).sum(1)), abs=1e-6)


def test_inference_equals_closed_form(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2)) * [1, 100] + [0, 1e4]
    y = 3 + x @ [0.5, -0.02] + rng.normal(size=200)
    df, cols = frame(spark, x, y)
    m = models.linear_reg(labelCol="y").fit(df)
    a = np.concatenate([np.ones((200, 1)), x], 1)
    b, rss, *_ = np.linalg.lstsq(a, y, rcond=None)
    se = np.sqrt(np.diag(np.linalg.inv(a.T @ a)) * rss[0] / 197)
    assert [m.intercept, *m.coefficients] == pytest.approx(b.tolist())
    assert m.summary.coefficientStandardErrors == pytest.approx([se[1], se[2], se[0]])
    assert m.summary.r2 == pytest.approx(1 - rss[0] / ((y - y.mean()) ** 2).sum())
    s = models.fit_summary(spark, m, 200, 2).first()
    resid = y - a @ b
    assert (s.resid_min, s.resid_median, s.resid_max) == pytest.approx((resid.min(), np.median(resid), resid.max()), abs=1e-9)
    assert m.transform(df).agg({"prediction": "avg"}).first()[0] == pytest.approx(y.mean())


def test_dependent_columns_few_rows_and_none(spark):
    x = np.array([[1.0, 2.0], [2.0, 4.0], [3.0, 6.0], [4.0, 8.0]])
    m = models.linear_reg(labelCol="y").fit(frame(spark, x, np.array([1.0, 3.0, 5.0, 7.0]))[0])
    assert m.intercept == pytest.approx(-1) and m.coefficients[0] == pytest.approx(2) and np.isnan(m.coefficients[1])
    assert np.isnan(m.summary.pValues[1])
    r = qr.triangular(spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>"), 3)
    assert r.shape == (3, 3) and np.abs(r[0]).tolist() == [1, 2, 3]
    with pytest.raises(ValueError, match="needs rows"):
        models.linear_reg(labelCol="y").fit(frame(spark, x, np.arange(4.0))[0].limit(0))
