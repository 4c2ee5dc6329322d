"""Plot statistics: counts add up, densities integrate to one, boxplot parts are consistent."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import stats


def data(spark, n=2000):
    rng = np.random.default_rng(5)
    rows = [(str(rng.integers(0, 3)), float(x), float(y)) for x, y in zip(rng.normal(size=n), rng.normal(size=n))]
    return spark.createDataFrame(rows + [("0", None, 1.0)], "g string, x double, y double")


def test_histogram_counts(spark):
    d = data(spark)
    h = stats.histogram(d, "x", 0.5)
    assert h.agg(F.sum("n")).first()[0] == 2000  # NA dropped
    assert h.agg(F.sum(F.col("density") * 0.5)).first()[0] == pytest.approx(1.0)
    # centres are multiples of the width
    assert all(abs(r["x"] / 0.5 - round(r["x"] / 0.5)) < 1e-9 for r in h.collect())
    f = stats.histogram(d, "x", 0.5, by=["g"], fill_empty=True)
    per = f.groupBy("g").agg(F.count(F.lit(1)).alias("bins")).collect()
    assert len({r["bins"] for r in per}) == 1  # every group has every bin


def test_kde_integrates(spark):
    d = data(spark)
    k = stats.kde(d, "x", 0.3, by=["g"]).collect()
    lo, hi = min(r["x"] for r in k), max(r["x"] for r in k)
    step = (hi - lo) / 511
    for g in "012":
        area = sum(r["density"] for r in k if r["g"] == g) * step
        assert 0.85 < area < 1.01


def test_boxplot_and_letter_values(spark):
    d = data(spark)
    b = stats.boxplot_stats(d, "x", ["g"], 1.5).collect()
    for r in b:
        assert r["ymin"] >= r["lower"] - 1.5 * (r["upper"] - r["lower"]) - 1e-12
        assert r["lower"] <= r["middle"] <= r["upper"]
        assert r["relvarwidth"] == pytest.approx(math.sqrt(r["n"]))
    lv = stats.letter_values(d, "x", ["g"]).filter(F.col("k") == 1).collect()
    med = {r["g"]: r for r in stats.boxplot_stats(d, "x", ["g"]).collect()}
    for r in lv:
        assert r["lower"] == pytest.approx(med[r["g"]]["middle"]) and r["upper"] == pytest.approx(r["lower"])


def test_2d_bins_count_everything(spark):
    d = data(spark).filter(F.col("x").isNotNull())
    assert stats.bin2d(d, "x", "y", 20).agg(F.sum("n")).first()[0] == 2000
    assert stats.hexbin(d, "x", "y", 15).agg(F.sum("n")).first()[0] == 2000


def test_smooth_line_and_cubic(spark):
    rows = [(float(x), float(2.0 + 0.5 * x + 0.1 * x ** 3)) for x in np.linspace(-2, 2, 50)]
    d = spark.createDataFrame(rows, "x double, y double")
    line = stats.smooth_line(d, "x", "y").first()
    assert line["intercept"] == pytest.approx(2.0, abs=1e-9)
    cub = stats.smooth_poly(d, "x", "y", 3).first()
    # back-transform the centred/scaled fit at x = 1
    z = (1.0 - cub["center"]) / cub["scale"]
    assert cub["b0"] + cub["b1"] * z + cub["b2"] * z ** 2 + cub["b3"] * z ** 3 == pytest.approx(2.6, abs=1e-8)


def test_density_has_a_bandwidth_for_each_group(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    groups = {"wide": rng.normal(100, 50, 1500), "narrow": rng.normal(0, 0.5, 900), "one": np.array([7.0]), "same": np.full(20, 3.0)}
    d = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("wide", None), (None, 5.0)], "g string, x double")
    bw = {r["g"]: r["bw"] for r in stats.bandwidths(d, "x", ["g"]).collect()}
    for g in ("wide", "narrow"):
        v = groups[g]
        want = 0.9 * min(v.std(ddof=1), (np.quantile(v, .75) - np.quantile(v, .25)) / 1.34) * len(v) ** -0.2
        assert abs(bw[g] - want) < 1e-9 * want
    assert bw["same"] == 0.9 * 3 * 20 ** -0.2 and bw["one"] == 0.9 * 7
    k = stats.kde(d.where("g in ('wide', 'narrow')"), "x", by=["g"]).collect()
    for g in ("wide", "narrow"):  # against the plain sum of kernels
        rows = sorted((r["x"], r["density"]) for r in k if r["g"] == g)
        x, got = np.array(rows).T
        z = (x[:, None] - groups[g][None, :]) / bw[g]
        plain = np.exp(-0.5 * z * z).sum(1) / (len(groups[g]) * bw[g] * np.sqrt(2 * np.pi))
        wide_cells = (x[-1] - x[0] + 8 * bw[g]) / stats.CELLS / bw[g]
        assert np.abs(got - plain).max() < max(2e-3, wide_cells ** 2) * plain.max()
    assert stats.kde(d, "x", by=["g"]).count() == 5 * 512


def test_loess_equals_a_plain_local_fit(spark):
    import numpy as np
    rng = np.random.default_rng(8)
    groups = {"a": np.sort(rng.uniform(-2, 5, 1200)), "b": np.concatenate([rng.normal(100, 1, 700), rng.normal(110, 4, 500)]), None: np.linspace(0, 1, 300)}
    data = {g: (x, np.sin(x if g == "a" else x / 3) + 0.3 * rng.normal(size=len(x))) for g, x in groups.items()}
    rows = [(g, float(a), float(b)) for g, (x, y) in data.items() for a, b in zip(x, y)] + [("a", None, 1.0), ("a", 1.0, float("nan"))]
    got = stats.loess(spark.createDataFrame(rows, "g string, x double, y double").repartition(5), "x", "y", 0.4, ["g"]).collect()
    for g, (x, y) in data.items():
        line = sorted((r["x"], r["fit"]) for r in got if r["g"] == g)
        assert len(line) == 80 and np.allclose([line[0][0], line[-1][0]], [x.min(), x.max()])
        for at, fit in line[::6]:
            far = np.abs(x - at)
            reach = np.sort(far)[int(np.floor(0.4 * len(x))) - 1]
            w = np.sqrt(np.clip(1 - (far / reach) ** 3, 0, None) ** 3)
            a = np.stack([np.ones_like(x), x - at, (x - at) ** 2], 1)
            plain = np.linalg.lstsq(a * w[:, None], y * w, rcond=None)[0][0]
            assert abs(fit - plain) < 1e-3 * max(1.0, y.std()), (g, at, fit, plain)


def test_loess_of_a_line_is_the_line(spark):
    d = spark.range(500).selectExpr("cast(id as double) as x", "3.0 - 0.25 * id as y")
    got = stats.loess(d, "x", "y").collect()
    assert all(abs(r["fit"] - (3 - 0.25 * r["x"])) < 1e-6 for r in got) and [r["point"] for r in sorted(got)] == list(range(80))
    one = stats.loess(d.limit(1), "x", "y").collect()
    assert all(abs(r["fit"] - 3) < 1e-9 for r in one)
