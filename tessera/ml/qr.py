"""Least squares by a QR decomposition of tall tables (TSQR).

Every partition reduces its rows to the triangular factor of their QR
decomposition, batch by batch; factors are stacked and decomposed again in a tree.
The last one is that of all rows.  Cross products are never formed, so a design of
condition number c loses digits by c and not by its square; p values of p columns
are all that moves.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tessera.ml.distributions import t_sf2

#: a column whose new part is smaller than this share of its length depends on those before it
DEPENDENT = 1e-11


def _reduced(stack: np.ndarray) -> np.ndarray:
    return np.linalg.qr(stack, mode="r")


def triangular(rows: DataFrame, width: int) -> np.ndarray:
    """The triangular factor of a table whose first column is an array of ``width`` numbers a row."""
    def local(batches):
        r = np.zeros((0, width))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            r = _reduced(np.concatenate([r, x]))
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def merge(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(v, np.float64).reshape(-1, width) for v in t.column("r").to_pylist()]
        return pa.table({"r": pa.array([_reduced(np.concatenate(parts)).tobytes()], pa.binary())})

    parts = rows.mapInArrow(local, "r binary")
    # factors are merged in two rounds, so that no task sees more than the root of their number
    for n in (max(1, int(parts.rdd.getNumPartitions() ** 0.5)), 1):
        parts = parts.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(n))).groupBy("g").applyInArrow(merge, "r binary")
    first = parts.first()
    r = np.zeros((width, width))
    if first is not None:
        got = np.frombuffer(first["r"], np.float64).reshape(-1, width)
        r[:len(got)] = got
    return r


def design(xs: Sequence[str]) -> Column:
    return F.array(F.lit(1.0), *[F.col(x).cast("double") for x in xs]).alias("x")


def inverse_factor(r: np.ndarray) -> np.ndarray:
    """The inverse of a triangular factor; rows and columns of dependent columns are zero."""
    keep = _independent(r)
    out = np.zeros_like(r)
    sub = _reduced(r[:, keep])
    out[np.ix_(keep, keep)] = np.linalg.solve(sub, np.eye(len(keep)))
    return out


def _independent(r: np.ndarray) -> np.ndarray:
    length = np.sqrt((r * r).sum(0))
    return np.flatnonzero(np.abs(np.diag(r)) > DEPENDENT * np.where(length > 0, length, 1.0))


def leverage(xs: Sequence[str], w: np.ndarray) -> Column:
    """x' (X'X)^-1 x of a row, as the squared length of its row times the inverse factor ``w``."""
    cols = [F.lit(1.0), *[F.col(x).cast("double") for x in xs]]
    total = F.lit(0.0)
    for j in range(len(cols)):
        z = F.lit(0.0)
        for i in range(j + 1):
            if w[i, j]:
                z = z + cols[i] * F.lit(float(w[i, j]))
        total = total + z * z
    return total


class Summary:
    """What inference needs, in the order of the coefficients with the intercept last."""

    def __init__(self, model: "LinearFit", df: DataFrame):
        self._model, self._df = model, df
        m = model
        se = np.sqrt((m.inverse ** 2).sum(1)) * (m.rss / m.df_residual) ** 0.5 if m.df_residual > 0 else np.full(len(m.all), np.nan)
        beta = m.all
        with np.errstate(divide="ignore", invalid="ignore"):
            t = beta / np.where(np.isnan(beta), np.nan, se)
        last = lambda v: [*map(float, v[1:]), float(v[0])]
        self.coefficientStandardErrors, self.tValues = last(np.where(np.isnan(beta), np.nan, se)), last(t)
        self.pValues = [t_sf2(v, m.df_residual) if np.isfinite(v) and m.df_residual > 0 else float("nan") for v in self.tValues]
        self.r2 = 1 - m.rss / m.tss if m.tss else float("nan")
        self.meanSquaredError = m.rss / m.n

    @property
    def residuals(self) -> DataFrame:
        m = self._model
        return m.transform(self._df).select((F.col(m.label) - F.col("prediction")).alias("residuals"))


class LinearFit:
    """Coefficients of a least squares fit; a column that depends on those before it has NaN."""

    def __init__(self, r: np.ndarray, n: int, label: str, features: str, df: DataFrame):
        p = len(r) - 1
        keep = _independent(r[:p, :p])
        sub = _reduced(r[:, [*keep, p]])
        k = len(keep)
        self.all = np.full(p, np.nan)
        self.all[keep] = np.linalg.solve(sub[:k, :k], sub[:k, k])
        self.rss = float(sub[k, k] ** 2) if sub.shape[0] > k else 0.0
        self.tss = float((_reduced(r)[1:, p] ** 2).sum())  # the intercept takes the mean out
        self.n, self.df_residual, self.label, self.features = n, n - k, label, features
        self.inverse = inverse_factor(r[:p, :p])
        self.intercept, self.coefficients = float(self.all[0]), [float(b) for b in self.all[1:]]
        self.summary = Summary(self, df)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``."""
        b = F.array(*[F.lit(0.0 if np.isnan(c) else c) for c in self.coefficients])
        dot = F.aggregate(F.zip_with(vector_to_array(F.col(self.features)), b, lambda x, c: x * c), F.lit(self.intercept), lambda s, v: s + v)
        return df.withColumn("prediction", dot)


class LeastSquares:
    """``linear_reg() |> set_engine("lm")`` on a vector of features."""

    def __init__(self, labelCol: str = "label", featuresCol: str = "features"):
        self.label, self.features = labelCol, featuresCol

    def fit(self, df: DataFrame) -> LinearFit:
        x = F.concat(F.array(F.lit(1.0)), vector_to_array(F.col(self.features)), F.array(F.col(self.label).cast("double")))
        size = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vector_to_array(F.col(self.features)))).alias("p")).first()
        if not size["n"]:
            raise ValueError("a linear fit needs rows")
        return LinearFit(triangular(df.select(x.alias("x")), size["p"] + 2), size["n"], self.label, self.features, df)
