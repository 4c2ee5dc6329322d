"""§2.13 distribution and covariation statistics (the data behind the plots)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.operators import stats
from tessera.operators.agg import count_with_levels
from tessera.sources.views import CUT_LEVELS
from tessera.workloads import query


def _n():
    return F.count(F.lit(1)).alias("n")


def _hist_sql(table, x, w, by="", where="TRUE", density=True):
    b = w / 2
    byc = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    dens = f", round(n / (sum(n) OVER ({part}) * {w}), 6) AS density" if density else ""
    return f"""
WITH d AS (SELECT * FROM {table} WHERE {x} IS NOT NULL AND {where}),
b AS (SELECT {byc}CAST(greatest(ceil(({x} - {b}) / {w}), floor(((SELECT min({x}) FROM d) - {b}) / {w}) + 1) AS BIGINT) AS k
      FROM d),
h AS (SELECT {byc}k, count(*) AS n FROM b GROUP BY {byc}k)
SELECT {byc}round(CAST({b} + (k - 1) * {w} AS DOUBLE), 6) AS xmin, round(CAST({b} + (k - 0.5) * {w} AS DOUBLE), 6) AS x,
       round(CAST({b} + k * {w} AS DOUBLE), 6) AS xmax,
       n{dens} FROM h"""


def _round_hist(h, density=True):
    cols = [c for c in h.columns if c not in ("xmin", "x", "xmax", "n", "density")]
    out = [*cols, F.round("xmin", 6).alias("xmin"), F.round("x", 6).alias("x"), F.round("xmax", 6).alias("xmax"), "n"]
    if density:
        out.append(F.round("density", 6).alias("density"))
    return h.select(*out)


@query("stat_count", section="2.13", sql="SELECT clarity, count(*) AS n FROM gems GROUP BY clarity")
def stat_count(t):
    return t.gems.groupBy("clarity").agg(_n())


@query("stat_fill", section="2.13", sql="""
SELECT cut, color, n, round(n / sum(n) OVER (PARTITION BY cut), 6) AS prop FROM (SELECT cut, color, count(*) AS n FROM gems
GROUP BY cut, color)""")
def stat_fill(t):
    from tessera.operators.windows import share_within
    c = t.gems.groupBy("cut", "color").agg(_n())
    return c.select("cut", "color", "n", F.round(share_within("n", ["cut"]), 6).alias("prop"))


@query("stat_count_empty", section="2.13", sql=f"""
SELECT l.cut, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM (VALUES {", ".join(f"('{c}')" for c in CUT_LEVELS)}) l(cut)
LEFT JOIN (SELECT cut, count(*) AS n FROM gems WHERE carat > 4.9 AND color = 'R' GROUP BY cut) c ON l.cut = c.cut""")
def stat_count_empty(t):
    # scale_x_discrete(drop = FALSE): unused levels of the factor are kept with n = 0
    lv = t.spark.createDataFrame([(c,) for c in CUT_LEVELS], "cut string")
    g = t.gems.filter((F.col("carat") > 4.9) & (F.col("color") == "R"))
    return count_with_levels(g, "cut", lv)


@query("stat_sum", section="2.13", sql="""
SELECT cut, color, n, round(n / (SELECT count(*) FROM gems), 6) AS prop FROM (SELECT cut, color, count(*) AS n FROM gems
GROUP BY cut, color)""")
def stat_sum(t):
    total = t.gems.agg(F.count(F.lit(1))).scalar()
    return t.gems.groupBy("cut", "color").agg(_n()).withColumn("prop", F.round(F.col("n") / total, 6))


@query("stat_tile", section="2.13", sql="""
SELECT month, dest, count(*) AS n, round(avg(dep_delay), 6) AS fill FROM deliveries GROUP BY month, dest""")
def stat_tile(t):
    return t.deliveries.groupBy("month", "dest").agg(_n(), F.round(F.avg("dep_delay"), 6).alias("fill"))


@query("stat_histogram", section="2.13", sql=_hist_sql("gems", "carat", 0.5))
def stat_histogram(t):
    return _round_hist(stats.histogram(t.gems, "carat", 0.5))


@query("hist_zoom_vs_limit", section="2.13", sql=f"""
WITH z AS ({_hist_sql("gems", "y", 0.5, density=False)}),
l AS ({_hist_sql("gems", "y", 0.5, where="y BETWEEN 2 AND 8", density=False)})
SELECT z.x, z.n AS n_zoom, CAST(coalesce(l.n, 0) AS BIGINT) AS n_limit FROM z LEFT JOIN l ON z.x = l.x WHERE z.x BETWEEN 2 AND 8""")
def hist_zoom_vs_limit(t):
    # coord_cartesian(xlim) zooms into bins of all rows; xlim() removes rows before binning
    zoom = _round_hist(stats.histogram(t.gems, "y", 0.5), density=False)
    lim = _round_hist(stats.histogram(t.gems.filter(F.col("y").between(2, 8)), "y", 0.5), density=False)
    j = zoom.filter(F.col("x").between(2, 8)).join(lim.select("x", F.col("n").alias("n_limit")), "x", "left")
    return j.select("x", F.col("n").alias("n_zoom"), F.coalesce("n_limit", F.lit(0)).cast("bigint").alias("n_limit"))


FREQ_SQL = """
WITH d AS (SELECT origin, dep_delay FROM deliveries WHERE dep_delay IS NOT NULL),
b AS (SELECT origin, CAST(greatest(ceil((dep_delay - 50) / 100), floor(((SELECT min(dep_delay) FROM d) - 50) / 100) + 1) AS BIGINT) AS k FROM d),
r AS (SELECT min(k) AS k0, max(k) AS k1 FROM b),
g AS (SELECT o.origin, s.k FROM (SELECT DISTINCT origin FROM d) o, r, range(r.k0, r.k1 + 1) s(k)),
h AS (SELECT g.origin, g.k, CAST(count(b.k) AS BIGINT) AS n FROM g LEFT JOIN b ON g.origin = b.origin AND g.k = b.k GROUP BY 1, 2)
SELECT origin, round(CAST(50 + (k - 0.5) * 100 AS DOUBLE), 6) AS x, n, round(n / (sum(n) OVER (PARTITION BY origin) * 100), 9) AS density FROM h"""


@query("stat_freqpoly", section="2.13", sql=FREQ_SQL.replace(", round(n / (sum(n) OVER (PARTITION BY origin) * 100), 9) AS density", ""))
def stat_freqpoly(t):
    h = stats.histogram(t.deliveries, "dep_delay", 100, by=["origin"], fill_empty=True)
    return h.select("origin", F.round("x", 6).alias("x"), "n")


@query("stat_freqpoly_density", section="2.13", sql=FREQ_SQL)
def stat_freqpoly_density(t):
    h = stats.histogram(t.deliveries, "dep_delay", 100, by=["origin"], fill_empty=True)
    return h.select("origin", F.round("x", 6).alias("x"), "n", F.round("density", 9).alias("density"))


KDE_BW = 0.05


@query("stat_density", section="2.13", sql=stats.kde_sql("SELECT cut AS g, log10(price) AS v FROM gems", "cut", f"CAST({KDE_BW} AS DOUBLE)"))
def stat_density(t):
    g = t.gems.select("cut", F.log10("price").alias("v"))
    k = stats.kde(g, "v", KDE_BW, by=["cut"])
    return k.select("cut", F.col("_g").cast("int").alias("_g"), F.round("x", 6).alias("x"),
                    F.round("density", 6).alias("density"))


def _box_sql(table, x, by, coef):
    return f"""
WITH d AS (SELECT {by}, {x} AS v FROM {table} WHERE {x} IS NOT NULL),
q AS (SELECT {by}, quantile_cont(v, 0.25) AS lower, quantile_cont(v, 0.5) AS middle, quantile_cont(v, 0.75) AS upper,
             count(*) AS n FROM d GROUP BY {by}),
j AS (SELECT d.*, q.lower, q.upper, v >= q.lower - {coef} * (q.upper - q.lower) AND v <= q.upper + {coef} * (q.upper - q.lower) AS inside
      FROM d JOIN q USING ({by}))
SELECT q.{by}, round(q.lower, 6) AS lower, round(q.middle, 6) AS middle, round(q.upper, 6) AS upper, q.n,
       round(w.ymin, 6) AS ymin, round(w.ymax, 6) AS ymax, w.n_out, round(sqrt(q.n), 6) AS relvarwidth
FROM q JOIN (SELECT {by}, min(v) FILTER (WHERE inside) AS ymin, max(v) FILTER (WHERE inside) AS ymax,
                    count(*) FILTER (WHERE NOT inside) AS n_out FROM j GROUP BY {by}) w USING ({by})"""


def _round_box(b, by):
    return b.select(by, *[F.round(c, 6).alias(c) for c in ("lower", "middle", "upper")], "n",
                    F.round("ymin", 6).alias("ymin"), F.round("ymax", 6).alias("ymax"), "n_out",
                    F.round("relvarwidth", 6).alias("relvarwidth"))


@query("stat_boxplot", section="2.13", sql=_box_sql("gems", "price", "cut", 1.5))
def stat_boxplot(t):
    return _round_box(stats.boxplot_stats(t.gems, "price", ["cut"], 1.5), "cut")


@query("outlier_flag", section="2.13", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, cut,
  CASE WHEN price < q25 - 2 * (q75 - q25) OR price > q75 + 2 * (q75 - q25) THEN NULL ELSE price END AS price
FROM (SELECT *, quantile_cont(price, 0.25) OVER (PARTITION BY cut) AS q25, quantile_cont(price, 0.75) OVER (PARTITION BY cut) AS q75
      FROM gems)""")
def outlier_flag(t):
    g = t.gems.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cut", "price")
    return stats.outlier_na(g, "price", ["cut"], 2.0)


@query("stat_letter_value", section="2.13", sql="""
WITH RECURSIVE d AS (SELECT cut, price FROM gems WHERE price IS NOT NULL),
n AS (SELECT cut, count(*) AS n FROM d GROUP BY cut),
lv(cut, n, k, depth) AS (SELECT cut, n, 1, (n + 1) / 2.0 FROM n
  UNION ALL SELECT cut, n, k + 1, (floor(depth) + 1) / 2.0 FROM lv WHERE k + 1 <= greatest(floor(log2(n)) - 3, 1)),
o AS (SELECT cut, price, row_number() OVER (PARTITION BY cut ORDER BY price) AS p FROM d)
SELECT lv.cut, CAST(lv.k AS BIGINT) AS k, lv.depth,
  (SELECT avg(price) FROM o WHERE o.cut = lv.cut AND (o.p = floor(lv.depth) OR o.p = ceil(lv.depth))) AS lower,
  (SELECT avg(price) FROM o WHERE o.cut = lv.cut AND (o.p = lv.n + 1 - floor(lv.depth) OR o.p = lv.n + 1 - ceil(lv.depth))) AS upper
FROM lv""")
def stat_letter_value(t):
    return stats.letter_values(t.gems, "price", ["cut"])


@query("stat_bin2d", section="2.13", sql="""
WITH r AS (SELECT min(carat) AS x0, (max(carat) - min(carat)) / 50 AS wx, min(price) AS y0, (max(price) - min(price)) / 50 AS wy FROM gems),
b AS (SELECT CAST(least(floor((carat - x0) / wx), 49) AS BIGINT) AS bin_x, CAST(least(floor((price - y0) / wy), 49) AS BIGINT) AS bin_y
      FROM gems, r)
SELECT bin_x, bin_y, round((SELECT x0 FROM r) + (bin_x + 0.5) * (SELECT wx FROM r), 6) AS x,
       round((SELECT y0 FROM r) + (bin_y + 0.5) * (SELECT wy FROM r), 6) AS y, count(*) AS n FROM b GROUP BY bin_x, bin_y""")
def stat_bin2d(t):
    b = stats.bin2d(t.gems, "carat", "price", bins=50)
    return b.select("bin_x", "bin_y", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "n")


@query("stat_hex", section="2.13", sql=f"""
WITH r AS (SELECT min(carat) AS x0, 30 / (max(carat) - min(carat)) AS c1, min(price) AS y0,
                  30 / ((max(price) - min(price)) * sqrt(3)) AS c2 FROM gems),
s AS (SELECT (carat - x0) * c1 AS sx, (price - y0) * c2 AS sy FROM gems, r),
c AS (SELECT CASE WHEN (sx - floor(sx + 0.5)) ^ 2 + 3 * (sy - floor(sy + 0.5)) ^ 2
                   <= (sx - floor(sx) - 0.5) ^ 2 + 3 * (sy - floor(sy) - 0.5) ^ 2 THEN floor(sx + 0.5) ELSE floor(sx) + 0.5 END AS cx,
             CASE WHEN (sx - floor(sx + 0.5)) ^ 2 + 3 * (sy - floor(sy + 0.5)) ^ 2
                   <= (sx - floor(sx) - 0.5) ^ 2 + 3 * (sy - floor(sy) - 0.5) ^ 2 THEN floor(sy + 0.5) ELSE floor(sy) + 0.5 END AS cy FROM s)
SELECT round((SELECT x0 FROM r) + cx / (SELECT c1 FROM r), 6) AS x, round((SELECT y0 FROM r) + cy / (SELECT c2 FROM r), 6) AS y,
       count(*) AS n FROM c GROUP BY cx, cy""")
def stat_hex(t):
    h = stats.hexbin(t.gems, "carat", "price", xbins=30)
    return h.select(F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), "n")


@query("stat_box_binned", section="2.13", sql=_box_sql(
    "(SELECT round(0.25 + (ceil((carat - 0.25) / 0.5) - 0.5) * 0.5, 6) AS carat_bin, price FROM gems)", "price", "carat_bin", 1.5))
def stat_box_binned(t):
    g = t.gems.withColumn("carat_bin", F.round(scalars.cut_width_bin("carat", 0.5), 6))
    return _round_box(stats.boxplot_stats(g, "price", ["carat_bin"], 1.5), "carat_bin")


@query("stat_smooth_lm", section="2.13", sql="""
SELECT cut, round(regr_intercept(log10(price), log10(carat)), 6) AS intercept, round(regr_slope(log10(price), log10(carat)), 6) AS slope,
       count(*) AS n FROM gems GROUP BY cut""")
def stat_smooth_lm(t):
    # log10 scales are applied before the fit
    g = t.gems.select("cut", F.log10("carat").alias("lx"), F.log10("price").alias("ly"))
    s = stats.smooth_line(g, "lx", "ly", by=["cut"])
    return s.select("cut", F.round("intercept", 6).alias("intercept"), F.round("slope", 6).alias("slope"), "n")


@query("stat_smooth_band", section="2.13", sql="""
WITH d AS (SELECT cut, log10(carat) AS x, log10(price) AS y FROM gems),
g AS (SELECT cut, count(*) AS n, avg(x) AS mx, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx,
             (regr_syy(y, x) - regr_slope(y, x) * regr_sxy(y, x)) / (count(*) - 2) AS s2, min(x) AS lo, max(x) AS hi FROM d GROUP BY cut),
p AS (SELECT g.*, i.k AS point, lo + (hi - lo) * i.k / 4 AS x0, 1.959963984540054 + 9.489237 / (4 * (n - 2)) AS t FROM g, range(5) i(k))
SELECT cut, point, round(x0, 6) AS x, round(a + b * x0, 6) AS fit, round(a + b * x0 - t * sqrt(s2 * (1.0 / n + pow(x0 - mx, 2) / sxx)), 6) AS low,
       round(a + b * x0 + t * sqrt(s2 * (1.0 / n + pow(x0 - mx, 2) / sxx)), 6) AS high FROM p""")
def stat_smooth_band(t):
    # the 95 % band that stat_smooth draws around its line
    g = t.gems.select("cut", F.log10("carat").alias("lx"), F.log10("price").alias("ly"))
    b = stats.smooth_band(g, "lx", "ly", by=["cut"], points=5)
    return b.select("cut", "point", *[F.round(c, 6).alias(c) for c in ("x", "fit", "low", "high")])


@query("stat_smooth_loess", section="2.13")
def stat_smooth_loess(t):
    # geom_smooth() with local regression, per cut on log10 axes
    g = t.gems.select("cut", F.log10("carat").alias("lx"), F.log10("price").alias("ly"))
    return stats.loess(g, "lx", "ly", by=["cut"])


# the cubic in closed form: orthogonal polynomials of z, one coefficient each, multiplied out
@query("stat_smooth_cubic", section="2.13", sql="""
WITH d AS (SELECT color, log10(carat) AS x, log10(price) AS y FROM gems WHERE carat < 3),
m AS (SELECT color, avg(x) AS mx, stddev_pop(x) AS sx FROM d GROUP BY color),
z AS (SELECT d.color, (x - mx) / sx AS z, y, mx, sx FROM d JOIN m ON d.color = m.color),
a AS (SELECT color, avg(z * z * z) AS m3, avg(z * z * z * z) AS m4 FROM z GROUP BY color),
p AS (SELECT z.*, m3, m4, z * z - 1 - m3 * z AS p2 FROM z JOIN a ON z.color = a.color),
c AS (SELECT color, avg(z * z * z * p2) / avg(p2 * p2) AS c2 FROM p GROUP BY color),
q AS (SELECT p.*, c2, z * z * z - m3 - m4 * z - c2 * p2 AS p3 FROM p JOIN c ON p.color = c.color),
f AS (SELECT color, any_value(mx) AS center, any_value(sx) AS scale, any_value(m3) AS m3, any_value(m4) AS m4, any_value(c2) AS c2, avg(y) AS d0,
             avg(y * z) AS d1, avg(y * p2) / avg(p2 * p2) AS d2, avg(y * p3) / avg(p3 * p3) AS d3 FROM q GROUP BY color)
SELECT color, round(center, 6) AS center, round(scale, 6) AS scale, round(d0 - d2 - d3 * m3 + d3 * c2, 6) AS b0, round(d1 - d2 * m3 - d3 * m4 + d3 * c2 * m3, 6) AS b1,
       round(d2 - d3 * c2, 6) AS b2, round(d3, 6) AS b3 FROM f""")
def stat_smooth_cubic(t):
    # y ~ x + I(x^2) + I(x^3) per colour on log10 axes
    g = t.gems.filter(F.col("carat") < 3).select("color", F.log10("carat").alias("lx"), F.log10("price").alias("ly"))
    s = stats.smooth_poly(g, "lx", "ly", 3, by=["color"])
    return s.select("color", *[F.round(c, 6).alias(c) for c in ("center", "scale", "b0", "b1", "b2", "b3")])


@query("scale_log10", section="2.13", sql=_hist_sql("(SELECT log10(price) AS lp FROM gems)", "lp", 0.1))
def scale_log10(t):
    return _round_hist(stats.histogram(t.gems.select(F.log10("price").alias("lp")), "lp", 0.1))


@query("facet_by", section="2.13", sql=_hist_sql("gems", "carat", 0.5, by="cut"))
def facet_by(t):
    return _round_hist(stats.histogram(t.gems, "carat", 0.5, by=["cut"]))


PAIR_COLS = ["carat", "x", "y", "z", "price"]


@query("pairs_matrix", section="2.13", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS r FROM gems"
    for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]))
def pairs_matrix(t):
    # all numeric pairs in one aggregate, then stacked to one row per pair
    pairs = [(a, b) for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]]
    wide = t.gems.agg(*[F.round(F.corr(a, b), 6).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr(f"stack({len(pairs)}, {stack}) AS (var1, var2, r)")


@query("point_sample", section="2.13", sql="SELECT carat, price FROM gems")
def point_sample(t):
    # geom_point draws every row; jitter and transparency are layout
    return t.gems.select("carat", "price")


@query("stat_histogram_default", section="2.13", sql="""
WITH r AS (SELECT min(carat) AS lo, (max(carat) - min(carat)) / 29 AS w FROM gems),
b AS (SELECT CAST(greatest(ceil((carat - (r.lo - r.w / 2)) / r.w), 1) AS BIGINT) AS k FROM gems, r)
SELECT round((SELECT lo - w / 2 FROM r) + (k - 0.5) * (SELECT w FROM r), 6) AS x, count(*) AS n FROM b GROUP BY k""")
def stat_histogram_default(t):
    # geom_histogram() without a bin width: 30 bins
    return stats.histogram_bins(t.gems, "carat").select(F.round("x", 6).alias("x"), "n")


@query("stat_density_default", section="2.13", sql=stats.kde_sql("SELECT cut AS g, log10(price) AS v FROM gems", "cut"))
def stat_density_default(t):
    # geom_density() and geom_violin(): each group has its own default bandwidth
    k = stats.kde(t.gems.select("cut", F.log10("price").alias("v")), "v", by=["cut"])
    return k.select("cut", "_g", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


@query("boxplot_outliers", section="2.13", sql="""
WITH q AS (SELECT cut, quantile_cont(price, 0.25) AS lo, quantile_cont(price, 0.75) AS hi FROM gems GROUP BY cut)
SELECT g.cut, g.l_orderkey, g.l_linenumber, g.l_partkey, g.l_suppkey, round(g.price, 6) AS price FROM gems g JOIN q ON g.cut = q.cut
WHERE price < lo - 0.5 * (hi - lo) OR price > hi + 0.5 * (hi - lo)""")
def boxplot_outliers(t):
    # the points beyond the whiskers, here at half an inter-quartile range
    g = t.gems.select("cut", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price")
    o = stats.boxplot_outliers(g, "price", ["cut"], 0.5)
    return o.withColumn("price", F.round("price", 6))


@query("pairs_by_level", section="2.13", sql=" UNION ALL ".join(
    f"SELECT cut, '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS r FROM gems GROUP BY cut"
    for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]))
def pairs_by_level(t):
    # the upper panels of a pairs plot coloured by a factor: one correlation per pair and level
    pairs = [(a, b) for i, a in enumerate(PAIR_COLS) for b in PAIR_COLS[i + 1:]]
    wide = t.gems.groupBy("cut").agg(*[F.round(F.corr(a, b), 6).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return wide.selectExpr("cut", f"stack({len(pairs)}, {stack}) AS (var1, var2, r)")


@query("pairs_box", section="2.13", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS variable, * FROM ({_box_sql('gems', c, 'cut', 1.5)})" for c in ("carat", "x", "price")))
def pairs_box(t):
    # numeric against factor in a pairs plot: the box statistics of every numeric column, in one scan
    long = t.gems.select("cut", "carat", "x", "price").unpivot(["cut"], ["carat", "x", "price"], "variable", "value")
    b = stats.boxplot_stats(long, "value", ["variable", "cut"], 1.5)
    return b.select("variable", "cut", *[F.round(c, 6).alias(c) for c in ("lower", "middle", "upper")], "n",
                    *[F.round(c, 6).alias(c) for c in ("ymin", "ymax")], "n_out", F.round("relvarwidth", 6).alias("relvarwidth"))
