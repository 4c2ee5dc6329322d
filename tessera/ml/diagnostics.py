"""Regression diagnostics from column arithmetic and small summaries.

Leverage and Cook's distance need the triangular factor of the design
(``tessera.ml.qr``): its p x p inverse enters the per-row expressions as literals;
rows never leave the executors.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.ml.distributions import norm_quantile
from tessera.ml.qr import design, inverse_factor, leverage, triangular
from tessera.operators.stats import loess
from tessera.plans.ordered import exact_quantiles


def gram(df: DataFrame, xs: Sequence[str], intercept: bool = True) -> np.ndarray:
    """X'X: every partition returns its p x p sums as one row, which are added in Spark."""
    cols = ([F.lit(1.0)] if intercept else []) + [F.col(x).cast("double") for x in xs]
    p = len(cols)

    def local(batches):
        total = np.zeros((p, p))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in t.column("sums").to_pylist())
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    parts = df.select(F.array(*cols).alias("x")).mapInArrow(local, "sums binary")
    # partitions' sums are added in two rounds, so that no task sees more than the root of their number
    groups = max(1, int(parts.rdd.getNumPartitions() ** 0.5))
    for n in (groups, 1):
        parts = parts.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(n))).groupBy("g").applyInArrow(add, "sums binary")
    return np.frombuffer(parts.first()["sums"], np.float64).reshape(p, p)


def residual_bins(df: DataFrame, fitted: str, resid: str, bins: int = 20) -> DataFrame:
    """``check_model(check = "linearity")``: mean residual per equal-width bin of fitted values."""
    r = df.agg(F.min(fitted), F.max(fitted)).first()
    w = (r[1] - r[0]) / bins or 1.0
    b = F.least(F.floor((F.col(fitted) - r[0]) / w), F.lit(bins - 1))
    return df.groupBy(b.alias("bin")).agg(F.avg(fitted).alias("fitted"), F.avg(resid).alias("mean_resid"),
                                          F.count(F.lit(1)).alias("n"))


def residual_smooth(df: DataFrame, fitted: str, resid: str, scale: bool = False) -> DataFrame:
    """The smooth reference line of a residual plot: local regression of the residuals, or with ``scale`` of the square root of
    their standardised size, on the fitted values."""
    if not scale:
        return loess(df, fitted, resid)
    sd = df.agg(F.stddev_samp(resid)).first()[0]
    return loess(df.withColumn("_s", F.sqrt(F.abs(F.col(resid) / sd))), fitted, "_s")


def homogeneity_bins(df: DataFrame, fitted: str, resid: str, bins: int = 20) -> DataFrame:
    """``check = "homogeneity"``: sqrt(|standardised residual|) per fitted-value bin."""
    sd = df.agg(F.stddev_samp(resid)).first()[0]
    d = df.withColumn("_s", F.sqrt(F.abs(F.col(resid) / sd)))
    return residual_bins(d, fitted, "_s", bins).withColumnRenamed("mean_resid", "sqrt_abs_std_resid")


def qq_points(df: DataFrame, resid: str, m: int = 99) -> DataFrame:
    """``check = "qq"``: standardised residual quantiles vs normal quantiles at (i - .5) / m."""
    st = df.agg(F.avg(resid), F.stddev_samp(resid)).first()
    d = df.select(((F.col(resid) - st[0]) / st[1]).alias("_z"))
    probs = [(i - 0.5) / m for i in range(1, m + 1)]
    q = exact_quantiles(d, "_z", probs).first()
    rows = [(p, norm_quantile(p), float(q[f"q{i}"])) for i, p in enumerate(probs)]
    return df.sparkSession.createDataFrame(rows, "p double, theoretical double, sample double")


def vif(df: DataFrame, xs: Sequence[str]) -> DataFrame:
    """``check = "vif"``: diagonal of the inverse correlation matrix of the predictors."""
    aggs = [F.corr(a, b).alias(f"{i}_{j}") for i, a in enumerate(xs) for j, b in enumerate(xs) if j > i]
    row = df.agg(*aggs).first() if aggs else None
    p = len(xs)
    c = np.eye(p)
    for i in range(p):
        for j in range(i + 1, p):
            c[i, j] = c[j, i] = row[f"{i}_{j}"]
    inv = np.linalg.inv(c)
    return df.sparkSession.createDataFrame([(x, float(inv[i, i])) for i, x in enumerate(xs)], "term string, vif double")


def gvif(df: DataFrame, terms: dict[str, Sequence[str]]) -> DataFrame:
    """Generalised VIF of each term (a factor's dummies are one term): det(R_term) det(R_rest) / det(R).

    Returns ``term, gvif, df, gvif_adj`` with the adjusted value gvif^(1 / (2 df)).
    """
    cols = [c for cs in terms.values() for c in cs]
    g = gram(df, cols)
    n, mean = g[0, 0], g[0, 1:] / g[0, 0]
    cov = g[1:, 1:] / n - np.outer(mean, mean)
    r = cov / np.sqrt(np.outer(np.diag(cov), np.diag(cov)))
    whole = np.linalg.det(r)
    rows, at = [], 0
    for term, cs in terms.items():
        own = np.arange(at, at + len(cs))
        rest = np.setdiff1d(np.arange(len(cols)), own)
        v = np.linalg.det(r[np.ix_(own, own)]) * np.linalg.det(r[np.ix_(rest, rest)]) / whole
        rows.append((term, float(v), len(cs), float(v ** (1 / (2 * len(cs))))))
        at += len(cs)
    return df.sparkSession.createDataFrame(rows, "term string, gvif double, df bigint, gvif_adj double")


def influence(df: DataFrame, xs: Sequence[str], y: str, coefs: Sequence[float]) -> DataFrame:
    """Leverage h = x'(X'X)^-1 x and Cook's distance D = e^2 h / (p s^2 (1 - h)^2) per row."""
    w = inverse_factor(triangular(df.select(design(xs)), len(xs) + 1))
    p = len(xs) + 1
    fitted = F.lit(float(coefs[0]))
    for b, x in zip(coefs[1:], xs):
        fitted = fitted + F.col(x) * float(b)
    d = df.withColumn("_fit", fitted).withColumn("_e", F.col(y) - F.col("_fit"))
    n = d.count()
    s2 = d.agg(F.sum(F.col("_e") * F.col("_e"))).first()[0] / (n - p)
    return (d.withColumn("leverage", leverage(xs, w))
            .withColumn("cooks_d", F.col("_e") * F.col("_e") * F.col("leverage")
                        / (p * s2 * F.pow(1 - F.col("leverage"), 2)))
            .drop("_fit"))


def mean_conf_int(df: DataFrame, xs: Sequence[str], y: str, coefs: Sequence[float], new: DataFrame,
                  level: float = 0.95) -> DataFrame:
    """``predict(type = "conf_int")``: y-hat +- t s sqrt(x0'(X'X)^-1 x0) at new points."""
    from tessera.ml.distributions import t_quantile
    w = inverse_factor(triangular(df.select(design(xs)), len(xs) + 1))
    p = len(xs) + 1
    fitted = F.lit(float(coefs[0]))
    for b, x in zip(coefs[1:], xs):
        fitted = fitted + F.col(x) * float(b)
    n = df.count()
    s2 = df.agg(F.sum(F.pow(F.col(y) - fitted, 2))).first()[0] / (n - p)
    t = t_quantile(1 - (1 - level) / 2, n - p)
    half = t * F.sqrt(leverage(xs, w) * s2)
    return new.withColumn("pred", fitted).withColumn("pred_lower", F.col("pred") - half) \
        .withColumn("pred_upper", F.col("pred") + half)
