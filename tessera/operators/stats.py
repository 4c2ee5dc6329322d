"""The statistics behind common plots, each a DataFrame -> small DataFrame.

Every statistic is an aggregation keyed by (group..., bin...) so it runs as a
partial + final hash aggregate: a hot group is combined map-side before the
shuffle.  Quantile-based statistics use the distributed exact quantiles;
scalars that fix a layout (range, bin width) are computed once as scalar
subqueries, never by collecting rows.
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.operators.agg import keep_on_rows
from tessera.plans.ordered import exact_quantiles, match_groups
from tessera.plans.select import settled, thin_scan


def _n():
    return F.count(F.lit(1)).alias("n")


# ---------------------------------------------------------------- histograms

def bin_index(x: Column, width: float, boundary: float, lowest: Column | float | None = None) -> Column:
    """Right-closed bin number ``k`` of ``(b + (k-1) w, b + k w]``; the lowest bin also takes its left edge."""
    k = F.ceil((x - boundary) / width)
    if lowest is not None:
        kmin = F.floor((lowest - boundary) / width) + 1
        k = F.greatest(k, kmin)
    return k.cast("bigint")


def histogram(df: DataFrame, x: str, width: float, by: Sequence[str] = (), boundary: float | None = None,
              fill_empty: bool = False) -> DataFrame:
    """``geom_histogram(binwidth = w)``: bins centred on multiples of ``w`` by default.

    Returns ``by..., xmin, x, xmax, n, density`` with density = n / (n_group * w).
    NA values are dropped.  With ``fill_empty`` every bin between the lowest
    and highest is present per group (frequency polygons).
    """
    b = width / 2 if boundary is None else boundary
    d = df.filter(F.col(x).isNotNull() & ~F.isnan(F.col(x)))
    lo = d.agg(F.min(x)).scalar()
    d = d.withColumn("_k", bin_index(F.col(x), width, b, lo))
    h = d.groupBy(*by, "_k").agg(_n())
    if fill_empty:
        from tessera.operators.reshape import complete
        ends = h.agg(F.min("_k"), F.max("_k")).first()
        every = df.sparkSession.range(ends[0] or 0, (ends[1] or 0) + 1).select(F.col("id").alias("value")) if ends[0] is not None \
            else df.sparkSession.range(0).select(F.col("id").alias("value"))
        group = F.struct(*by) if by else F.lit(1)
        h = complete(h.select(group.alias("_group"), "_k", "n"), "_group", {"_k": every})
        h = h.select(*[F.col("_group")[b].alias(b) for b in by], "_k", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    tot = h.groupBy(*by).agg(F.sum("n").alias("_tot")) if by else None
    h = keep_on_rows(h, list(by), tot) if by else h.withColumn("_tot", F.lit(d.agg(F.count(F.lit(1))).scalar()))
    return h.select(*by, (F.lit(b) + (F.col("_k") - 1) * width).alias("xmin"),
                    (F.lit(b) + (F.col("_k") - 0.5) * width).alias("x"),
                    (F.lit(b) + F.col("_k") * width).alias("xmax"), "n",
                    (F.col("n") / (F.col("_tot") * width)).alias("density"))


def histogram_bins(df: DataFrame, x: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """``geom_histogram()`` with its default 30 bins: width = range / (bins - 1), first bin centred on the minimum."""
    d = df.filter(F.col(x).isNotNull())
    lo, hi = d.agg(F.min(x)).scalar(), d.agg(F.max(x)).scalar()
    width = (hi - lo) / (bins - 1)
    b = lo - width / 2
    k = F.ceil((F.col(x) - b) / width)
    return (d.withColumn("_k", F.greatest(k, F.lit(1)).cast("bigint")).groupBy(*by, "_k").agg(_n())
            .select(*by, (b + (F.col("_k") - 0.5) * width).alias("x"), "n"))


# ---------------------------------------------------------------- densities

#: cells of the grid that a group's values are counted in before the convolution
CELLS = 1024


def bandwidths(df: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """R's default bandwidth of each group, ``by..., n, bw``: 0.9 * min(sd, IQR / 1.34) * n^-1/5.

    Where that is zero the sd stands alone, then the size of the first quartile, then 1.
    """
    by = list(by)
    q = exact_quantiles(df, x, [0.25, 0.75], by)
    s = df.groupBy(*by).agg(F.count(x).alias("n"), F.stddev_samp(x).alias("_sd"))
    both = keep_on_rows(s, by, q) if by else s.crossJoin(q)  # one row each
    sd = F.when(F.col("_sd") > 0, F.col("_sd"))
    iqr = F.when(F.col("q1") > F.col("q0"), (F.col("q1") - F.col("q0")) / 1.34)
    size = F.coalesce(F.least(sd, F.coalesce(iqr, sd)), F.when(F.abs("q0") > 0, F.abs("q0")), F.lit(1.0))
    return both.where("n > 0").select(*by, "n", (0.9 * size * F.pow(F.col("n"), F.lit(-0.2))).alias("bw"))


def kde(df: DataFrame, x: str, bw: float | None = None, by: Sequence[str] = (), n_grid: int = 512) -> DataFrame:
    """Gaussian kernel density at ``n_grid`` points over the data range, every point for every group.

    Each value is dealt between the two nearest of ``CELLS`` cells, which reach four bandwidths beyond the range; a group's cells
    are convolved with the kernel by Fourier transforms and read off linearly at the points.  Without ``bw`` each group has its
    own default bandwidth.  A group's rows never meet: only its cells do.
    """
    by = list(by)
    d = df.select(*by, F.col(x).cast("double").alias("_v"))
    d = d.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    ends = d.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    if bw is None:
        d = keep_on_rows(d, by, settled(bandwidths(d, "_v", by).drop("n"))) if by else d.withColumn("bw", F.lit(bandwidths(d, "_v").first()["bw"]))
    else:
        d = d.withColumn("bw", F.lit(float(bw)))
    margin, last = 4 * F.col("bw"), CELLS - 1
    width = (F.lit(hi) - F.lit(lo) + 2 * margin) / last
    at = (F.col("_v") - F.lit(lo) + margin) / width
    d = d.select(*by, "bw", F.floor(at).cast("int").alias("_k"), (at - F.floor(at)).alias("_w"))
    cells = d.groupBy(*by, "bw", "_k").agg(F.sum(1 - F.col("_w")).alias("_s0"), F.sum("_w").alias("_s1"))
    names = [f"k{i}" for i in range(len(by))]
    cells = cells.select(*[F.col(c).alias(k) for c, k in zip(by, names)], "bw", "_k", "_s0", "_s1")
    kinds = "".join(f"{k} {cells.schema[k].dataType.simpleString()}, " for k in names)

    def convolve(t: pa.Table) -> pa.Table:
        b, k = t.column("bw")[0].as_py(), t.column("_k").to_numpy()
        count = np.bincount(k, t.column("_s0").to_numpy(), CELLS + 1) + np.bincount(k + 1, t.column("_s1").to_numpy(), CELLS + 1)
        delta = (hi - lo + 8 * b) / last
        steps = np.concatenate([np.arange(CELLS + 1), np.arange(CELLS - 1, 0, -1)])  # distances around the circle of twice the cells
        kernel = np.exp(-0.5 * (steps * delta / b) ** 2) / (b * np.sqrt(2 * np.pi))
        smooth = np.fft.irfft(np.fft.rfft(count[:CELLS], 2 * CELLS) * np.fft.rfft(kernel), 2 * CELLS)[:CELLS] / count.sum()
        points = lo + (hi - lo) * np.arange(n_grid) / (n_grid - 1)
        value = np.interp((points - lo + 4 * b) / delta, np.arange(CELLS), np.maximum(smooth, 0))
        keys = [pa.concat_arrays([t.column(c).combine_chunks().slice(0, 1)]).take(pa.array(np.zeros(n_grid, np.int64))) for c in names]
        return pa.Table.from_arrays([*keys, pa.array(np.arange(n_grid, dtype=np.int32)), pa.array(points), pa.array(value)], [*names, "_g", "x", "density"])

    grouped = cells.groupBy(*names) if names else cells.withColumn("k", F.lit(0)).groupBy("k")
    dens = grouped.applyInArrow(convolve, kinds + "_g int, x double, density double")
    return dens.select(*[F.col(k).alias(c) for c, k in zip(by, names)], "_g", "x", "density")


def kde_sql(src: str, by: str | None, bw: str | None = None, n_grid: int = 512, digits: int = 6) -> str:
    """The twin of :func:`kde` in DuckDB SQL over rows ``g, v``, with the convolution as plain sums; ``bw`` None is the default of each group."""
    default = f"""0.9 * least(stddev_samp(v), (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) / 1.34) * pow(count(*), -0.2)"""
    return f"""
WITH d AS ({src}), r AS (SELECT min(v) AS lo, max(v) AS hi FROM d),
s AS (SELECT g, count(*) AS n, {bw or default} AS bw FROM d GROUP BY g),
p AS (SELECT d.g, bw, (v - lo + 4 * bw) / ((hi - lo + 8 * bw) / {CELLS - 1}) AS cell FROM d JOIN s ON d.g = s.g, r),
c AS (SELECT g, k, sum(w) AS c FROM (SELECT g, floor(cell) AS k, 1 - (cell - floor(cell)) AS w FROM p UNION ALL SELECT g, floor(cell) + 1, cell - floor(cell) FROM p) GROUP BY g, k),
e AS (SELECT c.g, j.j, sum(c.c * exp(-0.5 * pow((j.j - c.k) * ((hi - lo + 8 * bw) / {CELLS - 1}) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS f
      FROM c JOIN s ON c.g = s.g, r, range(0, {CELLS}) j(j) WHERE abs(j.j - c.k) * ((hi - lo + 8 * bw) / {CELLS - 1}) < 12 * bw GROUP BY c.g, j.j),
q AS (SELECT s.g, i.i, lo + (hi - lo) * i.i / {n_grid - 1} AS x, ((hi - lo) * i.i / {n_grid - 1} + 4 * bw) / ((hi - lo + 8 * bw) / {CELLS - 1}) AS cell FROM s, r, range(0, {n_grid}) i(i))
SELECT {f"q.g AS {by}, " if by else ""}CAST(q.i AS INTEGER) AS _g, round(x, 6) AS x,
       round(coalesce(a.f, 0) + (coalesce(b.f, 0) - coalesce(a.f, 0)) * (cell - floor(cell)), {digits}) AS density
FROM q LEFT JOIN e a ON a.g = q.g AND a.j = floor(q.cell) LEFT JOIN e b ON b.g = q.g AND b.j = floor(q.cell) + 1"""


# ---------------------------------------------------------------- boxplots

def boxplot_stats(df: DataFrame, x: str, by: Sequence[str], coef: float = 1.5) -> DataFrame:
    """``geom_boxplot``: Q1 / median / Q3 (type 7), whiskers at the extreme values
    within ``coef`` * IQR of the box, number of outliers, and sqrt(n) width.

    The quartiles are selected between brackets; one more aggregate of the rows
    takes what lies within and beyond the whiskers.  A group of NA only keeps its
    row, with n = 0.
    """
    by = list(by)
    v = F.col(x).cast("double")
    values = df.select(*by, F.when(~F.isnan(v), v).alias("_v"))
    q = settled(exact_quantiles(values, "_v", [0.25, 0.5, 0.75], by, with_n=True)
                .withColumnsRenamed({"q0": "lower", "q1": "middle", "q2": "upper"}))
    iqr = F.col("upper") - F.col("lower")
    inside = (F.col("_v") >= F.col("lower") - coef * iqr) & (F.col("_v") <= F.col("upper") + coef * iqr)
    w = keep_on_rows(values, by, q.drop("n")).groupBy(*by).agg(
        F.min(F.when(inside, F.col("_v"))).alias("ymin"), F.max(F.when(inside, F.col("_v"))).alias("ymax"),
        F.count_if(~inside).alias("n_out"))
    return keep_on_rows(q, by, w).withColumn("relvarwidth", F.sqrt("n"))


def boxplot_outliers(df: DataFrame, x: str, by: Sequence[str], coef: float = 1.5) -> DataFrame:
    """The rows that ``geom_boxplot`` draws as points: beyond ``coef`` * IQR of their group's box."""
    q = settled(exact_quantiles(df, x, [0.25, 0.75], by=by))
    j = keep_on_rows(df, list(by), q)
    iqr = F.col("q1") - F.col("q0")
    return j.filter((F.col(x) < F.col("q0") - coef * iqr) | (F.col(x) > F.col("q1") + coef * iqr)).drop("q0", "q1")


def outlier_na(df: DataFrame, x: str, by: Sequence[str], coef: float = 2.0) -> DataFrame:
    """Grouped ``if_else(x < q25 - coef*IQR | x > q75 + coef*IQR, NA, x)``: keep the row, blank the value."""
    q = settled(exact_quantiles(df.select(*by, x), x, [0.25, 0.75], by=by).withColumnsRenamed({"q0": "_q25", "q1": "_q75"}))
    j = keep_on_rows(df, list(by), q)
    iqr = F.col("_q75") - F.col("_q25")
    out = (F.col(x) < F.col("_q25") - coef * iqr) | (F.col(x) > F.col("_q75") + coef * iqr)
    return j.withColumn(x, F.when(out, F.lit(None)).otherwise(F.col(x))).drop("_q25", "_q75")


def letter_depths(n: Column) -> Column:
    """Depths of all letter values of ``n`` observations: d1 = (1 + n) / 2, d(k+1) = (1 + floor(d(k))) / 2,
    for k = 1 .. floor(log2 n) - 3 (Tukey's rule, at least 1).  Since floor(d(k)) is n / 2^k rounded up, d(k) is known at once."""
    letters = F.greatest(F.floor(F.log2(n)).cast("int") - 3, F.lit(1))
    return F.transform(F.sequence(F.lit(1), letters), lambda k: (F.ceil(n / F.pow(F.lit(2.0), k - 1)) + 1) / F.lit(2.0))


def letter_values(df: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
    """Letter values (letter-value plot): each averages the order statistics at floor(d)
    and ceil(d) of its depth ``d``, from below and from above.

    The order statistics are selected between brackets; the letters follow from the
    group's size, without a limit.
    """
    by = list(by)

    def positions(n: Column) -> Column:
        return F.array_distinct(F.flatten(F.transform(letter_depths(n), lambda d: F.array(
            F.floor(d), F.ceil(d), n + 1 - F.floor(d), n + 1 - F.ceil(d)).cast("array<bigint>"))))

    values = thin_scan(df, by, x, positions).filter(F.col(x).isNotNull())
    n = F.col("_total")
    wanted = F.flatten(F.transform(letter_depths(n), lambda d, i: F.array(*[
        F.struct((i + 1).cast("bigint").alias("k"), d.alias("depth"), F.lit(side).alias("side"), pos.cast("bigint").alias("p"))
        for side, pos in (("lo", F.floor(d)), ("lo", F.ceil(d)), ("hi", n + 1 - F.floor(d)), ("hi", n + 1 - F.ceil(d)))])))
    # each distinct value keeps the order statistics it covers
    got = values.select(*by, x, F.explode(F.filter(wanted, lambda w: (w["p"] > F.col("_cum") - F.col("_n")) & (w["p"] <= F.col("_cum")))).alias("w"))
    return got.groupBy(*by, F.col("w.k").alias("k"), F.col("w.depth").alias("depth")).agg(
        F.avg(F.when(F.col("w.side") == "lo", F.col(x))).alias("lower"), F.avg(F.when(F.col("w.side") == "hi", F.col(x))).alias("upper"))


# ---------------------------------------------------------------- 2-D bins

def bin2d(df: DataFrame, x: str, y: str, bins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """``geom_bin2d(bins)``: rectangular counts; equal-width bins over each range (last bin closed)."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    r = d.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    wx, wy = (r[1] - r[0]) / bins, (r[3] - r[2]) / bins
    bx = F.least(F.floor((F.col(x) - r[0]) / wx), F.lit(bins - 1)).cast("bigint")
    by_ = F.least(F.floor((F.col(y) - r[2]) / wy), F.lit(bins - 1)).cast("bigint")
    g = d.groupBy(*by, bx.alias("bin_x"), by_.alias("bin_y")).agg(_n())
    return g.select(*by, "bin_x", "bin_y", (r[0] + (F.col("bin_x") + 0.5) * wx).alias("x"),
                    (r[2] + (F.col("bin_y") + 0.5) * wy).alias("y"), "n")


def hexbin(df: DataFrame, x: str, y: str, xbins: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """``geom_hex``: hexagonal counts on two offset lattices (nearest hexagon centre).

    Scaled coordinates ``sx = c1 (x - xmin)``, ``sy = c2 (y - ymin)`` with
    ``c1 = xbins / xrange`` and ``c2 = xbins / (yrange * sqrt(3))``; a point
    belongs to lattice 1 at (round(sx), round(sy)) or lattice 2 at
    (floor(sx) + .5, floor(sy) + .5), whichever is nearer in the hexagon metric.
    """
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    r = d.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    c1 = xbins / (r[1] - r[0])
    c2 = xbins / ((r[3] - r[2]) * math.sqrt(3))
    sx = (F.col(x) - r[0]) * c1
    sy = (F.col(y) - r[2]) * c2
    j1, i1 = F.floor(sx + 0.5), F.floor(sy + 0.5)
    j2, i2 = F.floor(sx), F.floor(sy)
    d1 = (sx - j1) * (sx - j1) + 3 * (sy - i1) * (sy - i1)
    d2 = (sx - j2 - 0.5) * (sx - j2 - 0.5) + 3 * (sy - i2 - 0.5) * (sy - i2 - 0.5)
    first = d1 <= d2
    cx = F.when(first, j1).otherwise(j2 + 0.5)
    cy = F.when(first, i1).otherwise(i2 + 0.5)
    g = d.groupBy(*by, cx.alias("_cx"), cy.alias("_cy")).agg(_n())
    return g.select(*by, (F.lit(r[0]) + F.col("_cx") / c1).alias("x"), (F.lit(r[2]) + F.col("_cy") / c2).alias("y"), "n")


# ---------------------------------------------------------------- smooths

def smooth_line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """``stat_smooth(method = "lm", y ~ x)`` per group: intercept and slope from one aggregate."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return d.groupBy(*by).agg(F.regr_intercept(y, x).alias("intercept"), F.regr_slope(y, x).alias("slope"),
                              F.count(F.lit(1)).alias("n"))


def smooth_band(df: DataFrame, x: str, y: str, by: Sequence[str] = (), points: int = 80, z: float = 1.959963984540054) -> DataFrame:
    """The line of :func:`smooth_line` with its confidence band at ``points`` places over each group's range.

    ``z`` is the normal quantile (95 % by default); Student's follows from it by the
    first term of its expansion in the residual degrees of freedom.
    """
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.avg(x).alias("_mx"), F.regr_slope(y, x).alias("_b"),
                           F.regr_intercept(y, x).alias("_a"), F.regr_sxx(y, x).alias("_sxx"), F.regr_syy(y, x).alias("_syy"),
                           F.regr_sxy(y, x).alias("_sxy"), F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    p = g.withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(points - 1).cast("bigint"))))
    at = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("point") / (points - 1)
    t = F.lit(z) + (z ** 3 + z) / (4 * (F.col("_n") - 2))
    s2 = (F.col("_syy") - F.col("_b") * F.col("_sxy")) / (F.col("_n") - 2)
    half = t * F.sqrt(s2 * (1 / F.col("_n") + F.pow(F.col("x") - F.col("_mx"), 2) / F.col("_sxx")))
    return (p.withColumn("x", at).withColumn("fit", F.col("_a") + F.col("_b") * F.col("x")).withColumn("_h", half)
            .select(*by, "point", "x", "fit", (F.col("fit") - F.col("_h")).alias("low"), (F.col("fit") + F.col("_h")).alias("high")))


def smooth_poly(df: DataFrame, x: str, y: str, degree: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """``stat_smooth(method = "lm", y ~ x + I(x^2) + I(x^3))`` per group.

    Gram sums (powers of x up to 2·degree, x^k·y) come from one aggregate; each
    group's (degree+1)^2 system is then solved by a grouped pandas function
    over that one row per group.  x is centred and scaled by the group's mean
    and sd first, for a well-conditioned system.
    """
    import numpy as np
    import pandas as pd

    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    st = d.groupBy(*by).agg(F.avg(x).alias("_mx"), F.stddev_pop(x).alias("_sx"))
    if by:
        z = keep_on_rows(d, list(by), st)
    else:
        s0 = st.first()
        z = d.withColumn("_mx", F.lit(s0["_mx"])).withColumn("_sx", F.lit(s0["_sx"]))
    z = z.withColumn("_z", (F.col(x) - F.col("_mx")) / F.col("_sx"))
    sums = [F.sum(F.pow("_z", k)).alias(f"_p{k}") for k in range(2 * degree + 1)]
    sums += [F.sum(F.pow("_z", k) * F.col(y)).alias(f"_q{k}") for k in range(degree + 1)]
    g = z.groupBy(*by).agg(*sums, F.first("_mx").alias("_mx"), F.first("_sx").alias("_sx"))
    p = degree + 1
    names = list(by)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():
            A = np.array([[r[f"_p{i + j}"] for j in range(p)] for i in range(p)], dtype=float)
            b = np.array([r[f"_q{i}"] for i in range(p)], dtype=float)
            beta = np.linalg.solve(A, b)
            rows.append([r[c] for c in names] + [float(r["_mx"]), float(r["_sx"])] + [float(v) for v in beta])
        return pd.DataFrame(rows, columns=names + ["center", "scale"] + [f"b{k}" for k in range(p)])

    schema = ", ".join([f"`{c}` {dict(d.dtypes)[c]}" for c in names] + ["center double", "scale double"]
                       + [f"b{k} double" for k in range(p)])
    if names:
        return g.groupBy(*names).applyInPandas(solve, schema)
    return g.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(
        lambda pdf: solve(pdf), schema)


# ---------------------------------------------------------------- local regression

#: bins of a group's range whose moments stand for its rows, and places at which a local fit is made
LOESS_BINS = 4096
LOESS_VERTICES = 257


def _moments(shift: np.ndarray, m: list[np.ndarray], power: int) -> np.ndarray:
    """Sum of (d + shift)^power over a bin's rows, from its sums of d^0 .. d^power."""
    return sum(math.comb(power, i) * shift ** (power - i) * m[i] for i in range(power + 1))


def _local_fits(at: np.ndarray, centre: np.ndarray, m: list[np.ndarray], my: list[np.ndarray], span: float) -> tuple[np.ndarray, np.ndarray]:
    """Value and slope at each place of the quadratic fitted to its neighbourhood with tricube weights."""
    n = m[0]
    total = n.sum()
    need = max(1.0, np.floor(min(span, 1.0) * total + 1e-9))
    value, slope = np.empty(len(at)), np.empty(len(at))
    for k, v in enumerate(at):
        shift = centre - v
        far = np.abs(shift)
        order = np.argsort(far, kind="stable")
        reach = far[order][np.searchsorted(np.cumsum(n[order]), need)] * max(1.0, span)
        reach = max(reach, 2.0 / LOESS_BINS)
        near = far < reach
        w = (1 - (far[near] / reach) ** 3) ** 3
        part, party = [x[near] for x in m], [x[near] for x in my]
        s = [float((w * _moments(shift[near], part, p)).sum()) / reach ** p for p in range(5)]
        t = [float((w * _moments(shift[near], party, p)).sum()) / reach ** p for p in range(3)]
        b = np.linalg.lstsq(np.array([[s[i + j] for j in range(3)] for i in range(3)]), np.array(t), rcond=1e-10)[0]
        value[k], slope[k] = b[0], b[1] / reach
    return value, slope


def loess(df: DataFrame, x: str, y: str, span: float = 0.75, by: Sequence[str] = (), points: int = 80) -> DataFrame:
    """Local quadratic regression of each group at ``points`` places over its range: ``by..., point, x, fit``.

    Rows are summed to moments of ``LOESS_BINS`` fine bins of the group's range.  A group's bins then give weighted quadratic fits, each
    over the nearest ``span`` of the rows, at ``LOESS_VERTICES`` places, whose values and slopes are joined by cubics.  A row with NA
    in ``x`` or ``y`` is left out.
    """
    by = list(by)
    names = [f"k{i}" for i in range(len(by))]
    d = df.select(*[F.col(c).alias(k) for c, k in zip(by, names)], F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    d = d.where(F.col("_x").isNotNull() & F.col("_y").isNotNull() & ~F.isnan("_x") & ~F.isnan("_y"))
    ends = settled(d.groupBy(*names).agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")))
    d = keep_on_rows(d, names, ends) if names else d.crossJoin(ends)  # without keys: one row
    place = F.when(F.col("hi") > F.col("lo"), (F.col("_x") - F.col("lo")) / (F.col("hi") - F.col("lo"))).otherwise(0.5)
    d = d.withColumn("_t", place).withColumn("_b", F.least(F.floor(F.col("_t") * LOESS_BINS), F.lit(LOESS_BINS - 1)).cast("int"))
    off = F.col("_t") - (F.col("_b") + 0.5) / LOESS_BINS
    d = d.withColumn("_d", off)
    sums = [F.sum(F.pow("_d", F.lit(p))).alias(f"m{p}") for p in range(5)] + [F.sum(F.pow("_d", F.lit(p)) * F.col("_y")).alias(f"y{p}") for p in range(3)]
    bins = d.groupBy(*names, "lo", "hi", "_b").agg(*sums)
    kinds = "".join(f"{k} {bins.schema[k].dataType.simpleString()}, " for k in names)

    def fit(t: pa.Table) -> pa.Table:
        t = t.sort_by("_b")
        lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
        centre = (t.column("_b").to_numpy() + 0.5) / LOESS_BINS
        m, my = [t.column(f"m{p}").to_numpy() for p in range(5)], [t.column(f"y{p}").to_numpy() for p in range(3)]
        at = np.linspace(0, 1, LOESS_VERTICES)
        if hi > lo:
            value, slope = _local_fits(at, centre, m, my, span)
        else:  # one place: the mean
            value, slope = np.full(LOESS_VERTICES, my[0].sum() / m[0].sum()), np.zeros(LOESS_VERTICES)
        where = np.linspace(0, 1, points)
        i = np.minimum((where * (LOESS_VERTICES - 1)).astype(int), LOESS_VERTICES - 2)
        h = at[1] - at[0]
        u = (where - at[i]) / h
        got = ((1 + 2 * u) * (1 - u) ** 2 * value[i] + u * (1 - u) ** 2 * h * slope[i]
               + u * u * (3 - 2 * u) * value[i + 1] + u * u * (u - 1) * h * slope[i + 1])
        keys = [t.column(c).combine_chunks().take(pa.array(np.zeros(points, np.int64))) for c in names]
        return pa.Table.from_arrays([*keys, pa.array(np.arange(points)), pa.array(lo + (hi - lo) * where), pa.array(got)], [*names, "point", "x", "fit"])

    grouped = bins.groupBy(*names) if names else bins.withColumn("k", F.lit(0)).groupBy("k")
    out = grouped.applyInArrow(fit, kinds + "point bigint, x double, fit double")
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, names)], "point", "x", "fit")
