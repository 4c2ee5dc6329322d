"""A network of one hidden unit with weight decay, fitted by full-batch gradients.

P(event) = s(c + v * s(b + w . x)) with s the logistic function and p + 3 weights;
the loss is the cross-entropy summed over rows plus ``penalty`` times the sum of
all squared weights, as in single-hidden-layer networks with decay.  One pass
over the stored rows gives loss, gradient and Fisher information of *all*
candidates of a tuning grid: every partition returns their sums, one row per
candidate, which are added before they reach the driver.  Steps are damped
Fisher scoring (Levenberg-Marquardt), so a dozen passes are enough.
"""

from __future__ import annotations

import warnings
from typing import NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tessera.ml.recipe import in_few_parts

MAX_PASSES = 200
TOLERANCE = 1e-7


def start_weights(p: int, seed: int) -> np.ndarray:
    """Uniform on (-0.5, 0.5), as is usual for standardised inputs: [v, c, b, w...]."""
    return np.random.default_rng(seed).uniform(-0.5, 0.5, p + 3)


def _sums(weights: np.ndarray):
    """Partition pass: per candidate loss, gradient and information, summed over the partition's rows, as bytes."""
    def run(batches):
        q = weights.shape[1]
        total = np.zeros((len(weights), 1 + q + q * q))
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            for k, (v, c, bias, *w) in enumerate(weights):
                h = 1 / (1 + np.exp(-np.clip(bias + x @ np.array(w), -500, 500)))
                z = np.clip(c + v * h, -500, 500)
                m = 1 / (1 + np.exp(-z))
                inner = v * h * (1 - h)
                slope = np.concatenate([h[:, None], np.ones((len(y), 1)), inner[:, None], inner[:, None] * x], axis=1)
                total[k, 0] += np.logaddexp(0, z).sum() - (y * z).sum()
                total[k, 1:1 + q] += (m - y) @ slope
                total[k, 1 + q:] += ((slope * (m * (1 - m))[:, None]).T @ slope).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                                         ["candidate", "sums"])

    return run


class Fit(NamedTuple):
    """Weights ``[v, c, b, w...]`` of one penalty, and whether the loss had stopped falling."""

    weights: np.ndarray
    converged: bool
    passes: int


def fit_candidates(df: DataFrame, penalties: Sequence[float], **kw) -> list[np.ndarray]:
    """Weights ``[v, c, b, w...]`` for every penalty (see :func:`fit_all`)."""
    return [f.weights for f in fit_all(df, penalties, **kw)]


def fit_all(df: DataFrame, penalties: Sequence[float], label: str = "label", features: str = "features",
            seed: int = 1, max_passes: int = MAX_PASSES) -> list[Fit]:
    """A fit for every penalty, all side by side.  One that did not settle within ``max_passes`` says so and warns."""
    rows = df.select(F.col(label).cast("double").alias("y"), vector_to_array(F.col(features)).alias("x")).persist(StorageLevel.MEMORY_AND_DISK)

    few = in_few_parts(rows)

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float64) for x in t.column("sums").to_pylist())
        return pa.table({"candidate": t.column("candidate").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    try:
        q = len(rows.first()["x"]) + 3
        decay = np.array(penalties, float)
        at = np.tile(start_weights(q - 3, seed), (len(penalties), 1))
        best, best_loss, known = at.copy(), np.full(len(at), np.inf), [None] * len(at)
        damping, settled, passes = np.full(len(at), 1.0), np.zeros(len(at), bool), np.zeros(len(at), int)
        for step in range(max_passes):
            per = few.mapInArrow(_sums(at.copy()), "candidate int, sums binary").groupBy("candidate").applyInArrow(
                add, "candidate int, sums binary").collect()
            for r in per:
                k, sums = r["candidate"], np.frombuffer(r["sums"], np.float64)
                if settled[k]:
                    continue
                passes[k] = step + 1
                loss = sums[0] + decay[k] * (at[k] ** 2).sum()
                if loss < best_loss[k]:
                    settled[k] = best_loss[k] - loss <= TOLERANCE * abs(loss)
                    best[k], best_loss[k], damping[k] = at[k], loss, max(damping[k] / 10, 1e-6)
                    known[k] = (sums[1:1 + q] + 2 * decay[k] * at[k], sums[1 + q:].reshape(q, q) + 2 * decay[k] * np.eye(q))
                else:
                    damping[k] *= 10
                    settled[k] = damping[k] > 1e12
                gradient, information = known[k]
                at[k] = best[k] - np.linalg.solve(information + damping[k] * np.eye(q), gradient)
            if settled.all():
                break
        if not settled.all():
            warnings.warn(f"{int((~settled).sum())} of {len(at)} penalties did not settle in {max_passes} passes", stacklevel=2)
        return [Fit(w, bool(s), int(n)) for w, s, n in zip(best, settled, passes)]
    finally:
        rows.unpersist()


def probability(weights: np.ndarray, features: str = "features") -> Column:
    """P(event) of a row, as a column expression."""
    v, c, b, *w = (float(x) for x in weights)
    x = vector_to_array(F.col(features))
    inner = F.aggregate(F.zip_with(x, F.array(*[F.lit(a) for a in w]), lambda a, k: a * k), F.lit(b), lambda s, t: s + t)
    return 1 / (1 + F.exp(-(F.lit(c) + F.lit(v) / (1 + F.exp(-inner)))))


def importance(spark, weights: np.ndarray, names: Sequence[str]) -> DataFrame:
    """``vip``: share of each input in the absolute weight products |w v|."""
    size = np.abs(weights[3:] * weights[0])
    size = size / (size.sum() or 1.0)
    return spark.createDataFrame(sorted(zip(names, size.tolist()), key=lambda r: -r[1]), "variable string, importance double")
