"""Model fits on Spark ML, and tidy result tables.

Estimators are data-parallel (IRLS / L-BFGS / tree aggregation over
partitions); only coefficient vectors and p x p summaries reach the driver.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.ml.qr import LeastSquares
from tessera.plans.ordered import exact_quantiles


def linear_reg(**kw) -> LeastSquares:
    """``linear_reg() |> set_engine("lm")``: OLS by a distributed QR decomposition (with std errors)."""
    return LeastSquares(**kw)


def logistic_glm(**kw) -> GeneralizedLinearRegression:
    """``logistic_reg() |> set_engine("glm")``: unpenalised IRLS fit with std errors."""
    return GeneralizedLinearRegression(family="binomial", link="logit", **kw)


def augment(model, df: DataFrame, event: str, other: str, threshold: float = 0.5) -> DataFrame:
    """``augment(fit, new_data)``: original columns + ``pred_class`` and ``pred_<event>``.

    Classifiers give a probability vector; a binomial GLM's prediction is
    already the event probability.
    """
    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn(f"pred_{event}", vector_to_array(F.col("probability"))[1])
    else:
        out = out.withColumn(f"pred_{event}", F.col("prediction"))
    out = out.withColumn("pred_class", F.when(F.col(f"pred_{event}") > threshold, F.lit(event)).otherwise(F.lit(other)))
    return out.drop("rawPrediction", "probability", "features")


def tidy_linear(spark: SparkSession, lm_model, names: Sequence[str], exponentiate: bool = False) -> DataFrame:
    """``tidy(fit)``: term, estimate, std.error, statistic, p.value (intercept first)."""
    s = lm_model.summary
    coefs = list(lm_model.coefficients) + [lm_model.intercept]
    se = list(s.coefficientStandardErrors)
    tv = list(s.tValues)
    pv = list(s.pValues)
    terms = list(names) + ["(Intercept)"]
    rows = [(terms[i], float(coefs[i]), float(se[i]), float(tv[i]), float(pv[i])) for i in range(len(terms))]
    rows = rows[-1:] + rows[:-1]
    df = spark.createDataFrame(rows, "term string, estimate double, std_error double, statistic double, p_value double")
    return df.withColumn("estimate", F.exp("estimate")) if exponentiate else df


def tidy_glm(spark: SparkSession, glm_model, names: Sequence[str], exponentiate: bool = False) -> DataFrame:
    """``tidy(glm)``: z statistics and two-sided normal p-values."""
    s = glm_model.summary
    coefs = list(glm_model.coefficients) + [glm_model.intercept]
    se = list(s.coefficientStandardErrors)
    terms = list(names) + ["(Intercept)"]
    rows = []
    for i, term in enumerate(terms):
        z = coefs[i] / se[i] if se[i] else float("nan")
        rows.append((term, float(coefs[i]), float(se[i]), float(z), math.erfc(abs(z) / math.sqrt(2))))
    rows = rows[-1:] + rows[:-1]
    df = spark.createDataFrame(rows, "term string, estimate double, std_error double, statistic double, p_value double")
    return df.withColumn("estimate", F.exp("estimate")) if exponentiate else df


def importance_rows(spark: SparkSession, names: Sequence[str], shares: Sequence[float], top: int | None = None) -> DataFrame:
    """``variable, importance`` in falling order, all or the ``top`` first."""
    rows = sorted(((n, float(v)) for n, v in zip(names, shares)), key=lambda r: -r[1])[:top]
    return spark.createDataFrame(rows, "variable string, importance double")


def fit_summary(spark: SparkSession, lm_model, n: int, p: int) -> DataFrame:
    """``summary(lm)``: R^2, adjusted R^2, F statistic, residual sigma and the residuals' five numbers."""
    s = lm_model.summary
    r2 = s.r2
    adj = 1 - (1 - r2) * (n - 1) / (n - p - 1)
    f = (r2 / p) / ((1 - r2) / (n - p - 1)) if r2 < 1 else float("inf")
    sigma = (s.meanSquaredError * n / (n - p - 1)) ** 0.5
    q = exact_quantiles(s.residuals, "residuals", [0, 0.25, 0.5, 0.75, 1]).first()
    return spark.createDataFrame(
        [(float(r2), float(adj), float(f), float(sigma), int(n), *[float(q[f"q{i}"]) for i in range(5)])],
        "r_squared double, adj_r_squared double, f_statistic double, sigma double, n bigint, "
        "resid_min double, resid_q1 double, resid_median double, resid_q3 double, resid_max double")


def coef_intervals(tidy: DataFrame, df_resid: float, level: float = 0.95) -> DataFrame:
    """``dwplot``: estimate +- t * std.error per term."""
    from tessera.ml.distributions import t_quantile
    q = t_quantile(1 - (1 - level) / 2, df_resid)
    return tidy.select("term", "estimate", (F.col("estimate") - q * F.col("std_error")).alias("conf_low"),
                       (F.col("estimate") + q * F.col("std_error")).alias("conf_high"))

