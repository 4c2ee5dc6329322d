"""§2.21 composed analyses: end-to-end questions built from the operators."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tessera.functions import scalars
from tessera.operators import factors, reshape, verbs, windows
from tessera.operators.agg import keep_on_rows, n_distinct
from tessera.operators.joins import membership_flag
from tessera.plans.ordered import exact_quantiles
from tessera.session import stored
from tessera.workloads import query


def _n():
    return F.count(F.lit(1)).alias("n")


@query("cancel_by_hour", section="2.21", sql="""
SELECT sched_dep_time // 100 AS hour, round(avg(CASE WHEN dep_time IS NULL THEN 1.0 ELSE 0.0 END), 6) AS prop_cancelled,
       count(*) AS n FROM deliveries GROUP BY 1 HAVING sched_dep_time // 100 > 1""")
def cancel_by_hour(t):
    g = t.deliveries.groupBy(scalars.intdiv("sched_dep_time", 100).cast("bigint").alias("hour")).agg(
        F.round(F.avg(F.col("dep_time").isNull().cast("double")), 6).alias("prop_cancelled"), _n())
    return g.filter(F.col("hour") > 1)


@query("na_report", section="2.21", sql="""
SELECT count(*) FILTER (WHERE dep_time IS NULL) AS dep_time, count(*) FILTER (WHERE dep_delay IS NULL) AS dep_delay,
       count(*) FILTER (WHERE arr_delay IS NULL) AS arr_delay, count(*) FILTER (WHERE air_time IS NULL) AS air_time
FROM deliveries""")
def na_report(t):
    # the columns holding NAs (one small row to the driver), then their NA counts
    d = t.deliveries
    cols = verbs.columns_with_na(d)
    return d.select(*cols).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


@query("worst_on_time", section="2.21", sql="""
SELECT tailnum, max(dep_delay) AS dep_delay_rec FROM deliveries WHERE dep_delay IS NOT NULL GROUP BY tailnum
ORDER BY dep_delay_rec DESC""")
def worst_on_time(t):
    return (t.deliveries.filter(F.col("dep_delay").isNotNull()).groupBy("tailnum")
            .agg(F.max("dep_delay").alias("dep_delay_rec")).orderBy(F.desc("dep_delay_rec")))


@query("delay_by_time", section="2.21", sql="""
SELECT sched_dep_time, count(*) FILTER (WHERE dep_delay > 0) AS n_delay, round(avg(dep_delay), 6) AS m_delay,
       round(avg(CASE WHEN dep_delay > 0 THEN 1.0 ELSE 0.0 END), 6) AS p_delay, sum(dep_delay) AS t_delay
FROM deliveries WHERE dep_delay IS NOT NULL GROUP BY sched_dep_time""")
def delay_by_time(t):
    d = t.deliveries.filter(F.col("dep_delay").isNotNull())
    return d.groupBy("sched_dep_time").agg(
        F.count_if(F.col("dep_delay") > 0).alias("n_delay"), F.round(F.avg("dep_delay"), 6).alias("m_delay"),
        F.round(F.avg((F.col("dep_delay") > 0).cast("double")), 6).alias("p_delay"),
        F.sum("dep_delay").alias("t_delay"))


@query("delay_share", section="2.21", sql="""
SELECT carrier, flight, origin, dest, round_even(t_delay / sum(t_delay) OVER (PARTITION BY dest), 3) AS p_delay
FROM (SELECT dest, origin, carrier, flight, sum(dep_delay) AS t_delay FROM deliveries WHERE dep_delay > 0
      GROUP BY dest, origin, carrier, flight)""")
def delay_share(t):
    f = (t.deliveries.filter(F.col("dep_delay") > 0).groupBy("dest", "origin", "carrier", "flight")
         .agg(F.sum("dep_delay").alias("t_delay")))
    # the destination total is aggregated and joined back (no window over a whole destination)
    tot = f.groupBy("dest").agg(F.sum("t_delay").alias("_tot"))
    f = keep_on_rows(f, ["dest"], tot)
    return f.select("carrier", "flight", "origin", "dest", F.bround(F.col("t_delay") / F.col("_tot"), 3).alias("p_delay"))


@query("hour_autocorr", section="2.21", sql="""
WITH h AS (SELECT year, month, dep_time // 100 AS hour, avg(dep_delay) AS dep_delay, count(*) AS n FROM deliveries
           GROUP BY year, month, dep_time // 100 HAVING count(*) > 5),
l AS (SELECT *, lag(dep_delay) OVER (ORDER BY year, month, hour NULLS LAST) AS dep_delay_lag FROM h)
SELECT round(corr(dep_delay, dep_delay_lag), 6) AS r, count(*) AS n_pairs FROM l WHERE dep_delay > 0 AND dep_delay_lag IS NOT NULL""")
def hour_autocorr(t):
    h = (t.deliveries.groupBy("year", "month", scalars.intdiv("dep_time", 100).alias("hour"))
         .agg(F.avg("dep_delay").alias("dep_delay"), _n()).filter(F.col("n") > 5))
    lagged = windows.lag(h, [], [F.col("year").asc(), F.col("month").asc(), F.col("hour").asc_nulls_last()],
                         "dep_delay", 1, name="dep_delay_lag")
    f = lagged.filter((F.col("dep_delay") > 0) & F.col("dep_delay_lag").isNotNull())
    return f.agg(F.round(F.corr("dep_delay", "dep_delay_lag"), 6).alias("r"), F.count(F.lit(1)).alias("n_pairs"))


@query("fast_outliers", section="2.21", sql="""
SELECT origin, dest, round(quantile_cont(air_time, 0.25), 6) AS at_q25, round(quantile_cont(air_time, 0.5), 6) AS at_q50,
       round(quantile_cont(air_time, 0.75), 6) AS at_q75,
       count(*) FILTER (WHERE air_time < q25 - 2 * (q75 - q25)) AS n_fast
FROM (SELECT *, quantile_cont(air_time, 0.25) OVER (PARTITION BY origin, dest) AS q25,
             quantile_cont(air_time, 0.75) OVER (PARTITION BY origin, dest) AS q75 FROM deliveries)
GROUP BY origin, dest""")
def fast_outliers(t):
    d = t.deliveries.select("origin", "dest", "air_time")
    q = exact_quantiles(d, "air_time", [0.25, 0.5, 0.75], by=["origin", "dest"])
    flagged = keep_on_rows(d, ["origin", "dest"], q).withColumn(
        "fast", F.col("air_time") < F.col("q0") - 2 * (F.col("q2") - F.col("q0")))
    cnt = flagged.groupBy("origin", "dest").agg(F.count_if("fast").alias("n_fast"))
    return keep_on_rows(q, ["origin", "dest"], cnt).select(
        "origin", "dest", F.round("q0", 6).alias("at_q25"), F.round("q1", 6).alias("at_q50"),
        F.round("q2", 6).alias("at_q75"), "n_fast")


@query("slowest_relative", section="2.21", sql="""
SELECT origin, dest, tailnum, air_time, at_min, at_rel FROM (
  SELECT *, rank() OVER (PARTITION BY origin, dest ORDER BY at_rel DESC) AS r FROM (
    SELECT origin, dest, tailnum, air_time, min(air_time) OVER (PARTITION BY origin, dest) AS at_min,
           round(air_time / min(air_time) OVER (PARTITION BY origin, dest), 6) AS at_rel FROM deliveries
    WHERE air_time IS NOT NULL)) WHERE r = 1""")
def slowest_relative(t):
    d = t.deliveries.select("origin", "dest", "tailnum", "air_time").filter(F.col("air_time").isNotNull())
    d = keep_on_rows(d, ["origin", "dest"], d.groupBy("origin", "dest").agg(F.min("air_time").alias("at_min")))
    d = d.withColumn("at_rel", F.round(F.col("air_time") / F.col("at_min"), 6))
    top = d.groupBy("origin", "dest").agg(F.max("at_rel").alias("at_rel"))
    return d.join(top, ["origin", "dest", "at_rel"])


@query("carrier_rank", section="2.21", sql="""
WITH d AS (SELECT * FROM deliveries WHERE air_time IS NOT NULL),
k AS (SELECT dest FROM d GROUP BY dest HAVING count(DISTINCT carrier) > 1),
m AS (SELECT dest, origin, carrier, round(avg(air_time), 6) AS at_mean FROM d WHERE dest IN (SELECT dest FROM k)
      GROUP BY dest, origin, carrier)
SELECT dest, origin, carrier, at_mean, rank() OVER (PARTITION BY dest, origin ORDER BY at_mean) AS at_rnk FROM m""")
def carrier_rank(t):
    d = t.deliveries.filter(F.col("air_time").isNotNull())
    keep = d.groupBy("dest").agg(n_distinct("carrier").alias("nc")).filter(F.col("nc") > 1).select("dest")
    m = (d.join(keep, "dest", "left_semi").groupBy("dest", "origin", "carrier")
         .agg(F.round(F.avg("air_time"), 6).alias("at_mean")))
    # ranked within (dest, origin) on the aggregated table: at most one row per carrier
    w = Window.partitionBy("dest", "origin").orderBy("at_mean")
    return m.withColumn("at_rnk", F.rank().over(w).cast("bigint"))


@query("speed_variation", section="2.21", sql="""
SELECT dest, round(var_samp(air_time), 6) AS at_var, count(air_time) AS n FROM deliveries GROUP BY dest ORDER BY at_var DESC""")
def speed_variation(t):
    return (t.deliveries.groupBy("dest").agg(F.round(F.var_samp("air_time"), 6).alias("at_var"),
                                             F.count("air_time").alias("n")).orderBy(F.desc("at_var")))


@query("party_over_time", section="2.21", sql="""
SELECT year, partyid, n, round(n / sum(n) OVER (PARTITION BY year), 6) AS p FROM (
  SELECT year, CASE WHEN partyid IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN partyid IN ('4-NOT SPECIFIED', '5-LOW') THEN 'low'
                    ELSE partyid END AS partyid, count(*) AS n FROM survey GROUP BY 1, 2)""")
def party_over_time(t):
    p = factors.fct_collapse("partyid", {"high": ["1-URGENT", "2-HIGH"], "low": ["4-NOT SPECIFIED", "5-LOW"]})
    c = t.survey.groupBy("year", p.alias("partyid")).agg(_n())
    return c.select("year", "partyid", "n", F.round(windows.share_within("n", ["year"]), 6).alias("p"))


@query("denom_relig", section="2.21", sql="""
SELECT relig, count(*) AS n FROM survey WHERE denom NOT IN ('D0', 'D1') GROUP BY relig""")
def denom_relig(t):
    from tessera.functions.logic import r_in
    s = t.survey
    return s.filter(~r_in("denom", ["D0", "D1"])).groupBy("relig").agg(_n())


@query("cancel_vs_delay", section="2.21", sql="""
SELECT year, month, day, row_number() OVER (ORDER BY year, month, day) AS year_day, n_cancel, p_cancel, dd_ave FROM (
  SELECT year, month, day, count(*) FILTER (WHERE dep_time IS NULL) AS n_cancel,
         round(avg(CASE WHEN dep_time IS NULL THEN 1.0 ELSE 0.0 END), 6) AS p_cancel, round(avg(dep_delay), 6) AS dd_ave
  FROM deliveries GROUP BY year, month, day)""")
def cancel_vs_delay(t):
    g = t.deliveries.groupBy("year", "month", "day").agg(
        F.count_if(F.col("dep_time").isNull()).alias("n_cancel"),
        F.round(F.avg(F.col("dep_time").isNull().cast("double")), 6).alias("p_cancel"),
        F.round(F.avg("dep_delay"), 6).alias("dd_ave"))
    return windows.row_number(g, [], ["year", "month", "day"], "year_day")


@query("absent_by_carrier", section="2.21", sql="""
SELECT carrier, CAST(sum(CASE WHEN absent THEN 1 ELSE 0 END) AS BIGINT) AS n_absent, count(*) AS n_total,
       round(avg(CASE WHEN absent THEN 1.0 ELSE 0.0 END), 6) AS p_absent
FROM (SELECT carrier, tailnum NOT IN (SELECT tailnum FROM known_suppliers) AS absent FROM deliveries)
GROUP BY carrier HAVING sum(CASE WHEN absent THEN 1 ELSE 0 END) > 0""")
def absent_by_carrier(t):
    d = membership_flag(t.deliveries, "tailnum", t.known_suppliers, "tailnum").withColumn("absent", ~F.col("present"))
    g = d.groupBy("carrier").agg(F.count_if("absent").alias("n_absent"), F.count(F.lit(1)).alias("n_total"),
                                 F.round(F.avg(F.col("absent").cast("double")), 6).alias("p_absent"))
    return g.filter(F.col("n_absent") > 0)


@query("month_dest_heat", section="2.21", sql="""
WITH s AS (SELECT month, dest, CASE WHEN count(*) > 5 THEN round(avg(dep_delay), 6) END AS dep_delay FROM deliveries
           GROUP BY month, dest),
c AS (SELECT m.month, d.dest, s.dep_delay FROM (SELECT DISTINCT month FROM s) m CROSS JOIN (SELECT DISTINCT dest FROM s) d
      LEFT JOIN s ON s.month = m.month AND s.dest = d.dest),
k AS (SELECT * FROM c WHERE dest NOT IN (SELECT dest FROM c GROUP BY dest HAVING bool_or(dep_delay IS NULL)))
SELECT month, k.dest, dep_delay, dest_ord FROM k JOIN (SELECT dest, row_number() OVER (ORDER BY avg(dep_delay), dest) AS dest_ord
  FROM k GROUP BY dest) o ON k.dest = o.dest""")
def month_dest_heat(t):
    # suppress small cells -> complete(month, dest) -> drop destinations with a gap -> reorder by mean
    s = (t.deliveries.groupBy("month", "dest")
         .agg(F.when(F.count(F.lit(1)) > 5, F.round(F.avg("dep_delay"), 6)).alias("dep_delay")))
    s = stored(s)  # one row a cell; the steps below read it often
    c = reshape.complete(s, "dest", {"month": reshape.domain(s, "month")})
    gap = c.groupBy("dest").agg(F.bool_or(F.col("dep_delay").isNull()).alias("_gap"))
    k = keep_on_rows(c, ["dest"], gap).filter(~F.col("_gap")).drop("_gap")
    order = factors.levels_by(k, "dest", F.avg("dep_delay"))
    return factors.apply_levels(k, "dest", order)


@query("carat_spike", section="2.21", sql="""
SELECT carat, count(*) AS n FROM gems WHERE carat IN (0.9, 1.0) GROUP BY carat""")
def carat_spike(t):
    from tessera.functions.logic import r_in
    return t.gems.filter(r_in("carat", [0.9, 1.0])).groupBy("carat").agg(_n())


@query("price_cut_paradox", section="2.21", sql="""
SELECT round(0.25 + (ceil((carat - 0.25) / 0.5) - 0.5) * 0.5, 6) AS carat_bin, cut, count(*) AS n,
       round(median(price), 6) AS median_price FROM gems GROUP BY 1, 2""")
def price_cut_paradox(t):
    g = t.gems.withColumn("carat_bin", F.round(scalars.cut_width_bin("carat", 0.5), 6))
    q = exact_quantiles(g, "price", [0.5], by=["carat_bin", "cut"], with_n=True)
    return q.select("carat_bin", "cut", "n", F.round("q0", 6).alias("median_price"))
