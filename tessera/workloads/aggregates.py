"""§2.4 aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.logic import all_na_rm, any_na_rm, mean_strict, sum_na_rm
from tessera.operators.agg import count_na, count_with_levels, n_distinct, share_na
from tessera.operators.agg import keep_on_rows
from tessera.plans.ordered import exact_quantiles, group_positions
from tessera.workloads import query

ORDER_KEY = ["date", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
ORDER_SQL = "date, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate"


def n_rows():
    return F.count(F.lit(1)).alias("n")


@query("count_by", section="2.4", sql="SELECT dest, count(*) AS n FROM deliveries GROUP BY dest")
def count_by(t):
    return t.deliveries.groupBy("dest").agg(n_rows())


@query("count_sorted", section="2.4", sql="SELECT dest, count(*) AS n FROM deliveries GROUP BY dest ORDER BY n DESC, dest")
def count_sorted(t):
    return t.deliveries.groupBy("dest").agg(n_rows()).orderBy(F.desc("n"), "dest")


@query("count_weighted", section="2.4", sql="""
SELECT tailnum, round(coalesce(sum(distance), 0), 2) AS n FROM deliveries GROUP BY tailnum""")
def count_weighted(t):
    return t.deliveries.groupBy("tailnum").agg(F.round(sum_na_rm("distance"), 2).alias("n"))


@query("count_all", section="2.4", sql="SELECT count(*) AS n FROM deliveries WHERE dep_delay > 1000")
def count_all(t):
    return t.deliveries.filter(F.col("dep_delay") > 1000).agg(n_rows())


@query("count_two_way", section="2.4", sql="SELECT color, cut, count(*) AS n FROM gems GROUP BY color, cut")
def count_two_way(t):
    return t.gems.groupBy("color", "cut").agg(n_rows())


@query("count_with_empty", section="2.4", sql="""
SELECT b.dest, CAST(coalesce(c.n, 0) AS BIGINT) AS n, c.mean_delay FROM (SELECT DISTINCT p_brand AS dest FROM part) b
LEFT JOIN (SELECT dest, count(*) AS n, round(avg(dep_delay), 6) AS mean_delay FROM deliveries
           WHERE dep_delay > 1700 AND origin = '1-URGENT' GROUP BY dest) c ON b.dest = c.dest""")
def count_with_empty(t):
    d = t.deliveries.filter((F.col("dep_delay") > 1700) & (F.col("origin") == "1-URGENT"))
    levels = t.part.select(F.col("p_brand").alias("dest"))
    return count_with_levels(d, "dest", levels, F.round(F.avg("dep_delay"), 6).alias("mean_delay"))


@query("count_expr", section="2.4", sql="""
SELECT sched_dep_time // 100 AS hour, count(*) AS n FROM deliveries GROUP BY 1""")
def count_expr(t):
    return t.deliveries.groupBy(F.floor(F.col("sched_dep_time") / 100).alias("hour")).agg(n_rows())


@query("n_distinct_by", section="2.4", sql="""
SELECT dest, count(DISTINCT carrier) AS n_carriers,
       count(DISTINCT arr_delay) + CAST(max(CASE WHEN arr_delay IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_arr
FROM deliveries GROUP BY dest""")
def n_distinct_by(t):
    return t.deliveries.groupBy("dest").agg(n_distinct("carrier").alias("n_carriers"),
                                            n_distinct("arr_delay").alias("n_arr"))


@query("mean_narm", section="2.4", sql="SELECT dest, round(avg(dep_delay), 6) AS mean_delay FROM deliveries GROUP BY dest")
def mean_narm(t):
    return t.deliveries.groupBy("dest").agg(F.round(F.avg("dep_delay"), 6).alias("mean_delay"))


@query("mean_strict", section="2.4", sql="""
SELECT carrier, dest, CASE WHEN count(*) = count(arr_delay) THEN round(avg(arr_delay), 6) END AS mean_strict,
       round(avg(arr_delay), 6) AS mean_narm
FROM deliveries GROUP BY carrier, dest""")
def mean_strict_q(t):
    return t.deliveries.groupBy("carrier", "dest").agg(F.round(mean_strict("arr_delay"), 6).alias("mean_strict"),
                                                       F.round(F.avg("arr_delay"), 6).alias("mean_narm"))


@query("sum_by", section="2.4", sql="""
SELECT carrier, coalesce(sum(dep_delay), 0) AS total_narm,
       CASE WHEN count(*) = count(dep_delay) THEN coalesce(sum(dep_delay), 0) END AS total_strict,
       coalesce(sum(CASE WHEN dep_delay > 1720 THEN dep_delay END), 0) AS total_big
FROM deliveries GROUP BY carrier""")
def sum_by(t):
    from tessera.functions.logic import sum_strict
    return t.deliveries.groupBy("carrier").agg(
        sum_na_rm("dep_delay").alias("total_narm"), sum_strict("dep_delay").alias("total_strict"),
        sum_na_rm(F.when(F.col("dep_delay") > 1720, F.col("dep_delay"))).cast("double").alias("total_big"))


@query("count_na", section="2.4", sql="""
SELECT dest, count(*) FILTER (WHERE dep_time IS NULL) AS n_na, round(avg(CASE WHEN dep_time IS NULL THEN 1.0 ELSE 0.0 END), 6) AS share_na
FROM deliveries GROUP BY dest""")
def count_na_q(t):
    return t.deliveries.groupBy("dest").agg(count_na("dep_time").alias("n_na"),
                                            F.round(share_na("dep_time"), 6).alias("share_na"))


@query("count_na_across", section="2.4", sql="""
SELECT count(*) FILTER (WHERE date IS NULL) AS date, count(*) FILTER (WHERE year IS NULL) AS year, count(*) FILTER (WHERE month IS NULL) AS month,
 count(*) FILTER (WHERE day IS NULL) AS day, count(*) FILTER (WHERE l_orderkey IS NULL) AS l_orderkey, count(*) FILTER (WHERE l_partkey IS NULL) AS l_partkey,
 count(*) FILTER (WHERE l_suppkey IS NULL) AS l_suppkey, count(*) FILTER (WHERE l_linenumber IS NULL) AS l_linenumber,
 count(*) FILTER (WHERE l_extendedprice IS NULL) AS l_extendedprice, count(*) FILTER (WHERE l_shipdate IS NULL) AS l_shipdate,
 count(*) FILTER (WHERE carrier IS NULL) AS carrier, count(*) FILTER (WHERE flight IS NULL) AS flight, count(*) FILTER (WHERE origin IS NULL) AS origin,
 count(*) FILTER (WHERE dest IS NULL) AS dest, count(*) FILTER (WHERE tailnum IS NULL) AS tailnum, count(*) FILTER (WHERE sched_dep_time IS NULL) AS sched_dep_time,
 count(*) FILTER (WHERE dep_time IS NULL) AS dep_time, count(*) FILTER (WHERE dep_delay IS NULL OR isnan(dep_delay)) AS dep_delay,
 count(*) FILTER (WHERE arr_delay IS NULL OR isnan(arr_delay)) AS arr_delay, count(*) FILTER (WHERE air_time IS NULL OR isnan(air_time)) AS air_time,
 count(*) FILTER (WHERE distance IS NULL OR isnan(distance)) AS distance, count(*) FILTER (WHERE time_hour IS NULL) AS time_hour
FROM deliveries""")
def count_na_across(t):
    from tessera.functions.logic import is_na
    d = t.deliveries
    return d.agg(*[F.count_if(is_na(f.name, f.dataType)).alias(f.name) for f in d.schema.fields])


@query("na_pattern", section="2.4", sql="""
SELECT dep_delay IS NULL AS dep_na, arr_delay IS NULL AS arr_na, air_time IS NULL AS air_na, count(*) AS n
FROM deliveries GROUP BY 1, 2, 3""")
def na_pattern(t):
    return t.deliveries.groupBy(F.col("dep_delay").isNull().alias("dep_na"), F.col("arr_delay").isNull().alias("arr_na"),
                                F.col("air_time").isNull().alias("air_na")).agg(n_rows())


@query("median_by", section="2.4", sql="SELECT dest, round(median(dep_delay), 6) AS median_delay FROM deliveries GROUP BY dest")
def median_by(t):
    q = exact_quantiles(t.deliveries, "dep_delay", [0.5], by=["dest"])
    return q.select("dest", F.round("q0", 6).alias("median_delay"))


@query("quantile_by", section="2.4", sql="""
SELECT origin, round(quantile_cont(dep_delay, 0.95), 6) AS q95, round(quantile_cont(dep_delay, 0.05), 6) AS q05
FROM deliveries GROUP BY origin""")
def quantile_by(t):
    q = exact_quantiles(t.deliveries, "dep_delay", [0.95, 0.05], by=["origin"])
    return q.select("origin", F.round("q0", 6).alias("q95"), F.round("q1", 6).alias("q05"))


@query("iqr_by", section="2.4", sql="""
SELECT dest, round(quantile_cont(distance, 0.75) - quantile_cont(distance, 0.25), 6) AS iqr FROM deliveries GROUP BY dest""")
def iqr_by(t):
    q = exact_quantiles(t.deliveries, "distance", [0.25, 0.75], by=["dest"])
    return q.select("dest", F.round(F.col("q1") - F.col("q0"), 6).alias("iqr"))


@query("minmax_by", section="2.4", sql="""
SELECT dest, max(arr_delay) AS max_delay, min(arr_delay) AS min_delay FROM deliveries GROUP BY dest""")
def minmax_by(t):
    return t.deliveries.groupBy("dest").agg(F.max("arr_delay").alias("max_delay"), F.min("arr_delay").alias("min_delay"))


@query("var_sd_by", section="2.4", sql="""
SELECT dest, round(var_samp(distance), 2) AS var_dist, round(stddev_samp(distance), 6) AS sd_dist FROM deliveries GROUP BY dest""")
def var_sd_by(t):
    return t.deliveries.groupBy("dest").agg(F.round(F.var_samp("distance"), 2).alias("var_dist"),
                                            F.round(F.stddev_samp("distance"), 6).alias("sd_dist"))


@query("range_stats", section="2.4", sql="""
SELECT origin, count(*) AS n, count(*) FILTER (WHERE dep_delay IS NULL) AS n_na, round(avg(dep_delay), 6) AS dd_mean,
       round(stddev_samp(dep_delay), 6) AS dd_sd, min(dep_delay) AS dd_min, round(quantile_cont(dep_delay, 0.25), 6) AS dd_q25,
       round(quantile_cont(dep_delay, 0.5), 6) AS dd_median, round(quantile_cont(dep_delay, 0.75), 6) AS dd_q75,
       max(dep_delay) AS dd_max, round(quantile_cont(dep_delay, 0.75) - quantile_cont(dep_delay, 0.25), 6) AS dd_iqr,
       max(dep_delay) - min(dep_delay) AS dd_range
FROM deliveries GROUP BY origin""")
def range_stats(t):
    d = t.deliveries
    basic = d.groupBy("origin").agg(n_rows(), count_na("dep_delay").alias("n_na"), F.round(F.avg("dep_delay"), 6).alias("dd_mean"),
                                    F.round(F.stddev_samp("dep_delay"), 6).alias("dd_sd"),
                                    F.min("dep_delay").alias("dd_min"), F.max("dep_delay").alias("dd_max"))
    q = exact_quantiles(d, "dep_delay", [0.25, 0.5, 0.75], by=["origin"])
    out = keep_on_rows(basic, ["origin"], q)
    # derived statistic computed from others of the same summary
    return out.select("origin", "n", "n_na", "dd_mean", "dd_sd", "dd_min",
                      F.round("q0", 6).alias("dd_q25"), F.round("q1", 6).alias("dd_median"),
                      F.round("q2", 6).alias("dd_q75"), "dd_max",
                      F.round(F.col("q2") - F.col("q0"), 6).alias("dd_iqr"),
                      (F.col("dd_max") - F.col("dd_min")).alias("dd_range"))


@query("first_nth_last", section="2.4", sql=f"""
SELECT dest, max(CASE WHEN rn = 1 THEN dep_delay END) AS first_delay, max(CASE WHEN rn = 5 THEN dep_delay END) AS fifth_delay,
       max(CASE WHEN rn = cnt THEN dep_delay END) AS last_delay
FROM (SELECT dest, dep_delay, row_number() OVER (PARTITION BY dest ORDER BY {ORDER_SQL}) AS rn,
             count(*) OVER (PARTITION BY dest) AS cnt FROM deliveries WHERE dep_delay IS NOT NULL) GROUP BY dest""")
def first_nth_last(t):
    d = t.deliveries.filter(F.col("dep_delay").isNotNull())
    key = F.struct(*ORDER_KEY)
    ends = d.groupBy("dest").agg(F.min_by("dep_delay", key).alias("first_delay"),
                                 F.max_by("dep_delay", key).alias("last_delay"))
    fifth = (group_positions(d.select("dest", "dep_delay", *ORDER_KEY), ["dest"], ORDER_KEY)
             .filter(F.col("pos") == 5).select("dest", F.col("dep_delay").alias("fifth_delay")))
    return ends.join(fifth, "dest", "left")


@query("all_any_by", section="2.4", sql="""
SELECT tailnum, coalesce(bool_and(arr_delay < 1500), true) AS all_small, coalesce(bool_or(arr_delay > 1700), false) AS any_big
FROM deliveries GROUP BY tailnum""")
def all_any_by(t):
    return t.deliveries.groupBy("tailnum").agg(all_na_rm(F.col("arr_delay") < 1500).alias("all_small"),
                                               any_na_rm(F.col("arr_delay") > 1700).alias("any_big"))


@query("bool_prod_min", section="2.4", sql="""
SELECT tailnum, CAST(min(CASE WHEN distance > 1000 THEN 1 ELSE 0 END) AS BIGINT) AS prod_flag,
       CAST(min(CASE WHEN distance > 1000 THEN 1 ELSE 0 END) AS BIGINT) AS min_flag, bool_and(distance > 1000) AS all_flag
FROM deliveries GROUP BY tailnum""")
def bool_prod_min(t):
    f = (F.col("distance") > 1000).cast("int")
    return t.deliveries.groupBy("tailnum").agg(
        F.product(f).cast("bigint").alias("prod_flag"), F.min(f).cast("bigint").alias("min_flag"),
        F.bool_and(F.col("distance") > 1000).alias("all_flag"))


@query("mean_of_flag", section="2.4", sql="""
SELECT dest, round(avg(CASE WHEN dep_delay <= 60 THEN 1.0 WHEN dep_delay > 60 THEN 0.0 END), 6) AS share_small,
       count(*) FILTER (WHERE arr_delay >= 300) AS n_late FROM deliveries GROUP BY dest""")
def mean_of_flag(t):
    return t.deliveries.groupBy("dest").agg(F.round(F.avg((F.col("dep_delay") <= 60).cast("double")), 6).alias("share_small"),
                                            F.count_if(F.col("arr_delay") >= 300).alias("n_late"))


@query("filtered_mean", section="2.4", sql="""
SELECT dest, round(avg(CASE WHEN dep_delay > 0 THEN dep_delay END), 6) AS mean_pos,
       round(avg(CASE WHEN dep_delay < 0 THEN dep_delay END), 6) AS mean_neg, count(*) AS n FROM deliveries GROUP BY dest""")
def filtered_mean(t):
    x = F.col("dep_delay")
    return t.deliveries.groupBy("dest").agg(F.round(F.avg(F.when(x > 0, x)), 6).alias("mean_pos"),
                                            F.round(F.avg(F.when(x < 0, x)), 6).alias("mean_neg"), n_rows())


@query("filter_then_mean", section="2.4", sql="""
SELECT dest, round(avg(dep_delay), 6) AS mean_delay, count(*) AS n FROM deliveries WHERE dep_delay > 1720 GROUP BY dest""")
def filter_then_mean(t):
    return (t.deliveries.filter(F.col("dep_delay") > 1720).groupBy("dest")
            .agg(F.round(F.avg("dep_delay"), 6).alias("mean_delay"), n_rows()))


@query("suppress_small", section="2.4", sql="""
SELECT dest, date, CASE WHEN count(*) > 5 THEN round(avg(dep_delay), 6) END AS mean_delay, count(*) AS n
FROM deliveries GROUP BY dest, date""")
def suppress_small(t):
    return t.deliveries.groupBy("dest", "date").agg(
        F.when(F.count(F.lit(1)) > 5, F.round(F.avg("dep_delay"), 6)).alias("mean_delay"), n_rows())


@query("having_n", section="2.4", sql="""
SELECT dest, origin, count(*) AS n, round(avg(arr_delay), 6) AS mean_arr FROM deliveries
GROUP BY dest, origin HAVING count(*) > 480""")
def having_n(t):
    g = t.deliveries.groupBy("dest", "origin").agg(n_rows(), F.round(F.avg("arr_delay"), 6).alias("mean_arr"))
    return g.filter(F.col("n") > 480)


@query("global_corr", section="2.4", sql="""
SELECT round(corr(dep_delay, distance), 6) AS r, round(corr(arr_delay, dep_delay), 6) AS r_delays FROM deliveries""")
def global_corr(t):
    return t.deliveries.agg(F.round(F.corr("dep_delay", "distance"), 6).alias("r"),
                            F.round(F.corr("arr_delay", "dep_delay"), 6).alias("r_delays"))


@query("drop_groups", section="2.4", sql="""
SELECT dest, round(avg(n), 6) AS mean_n, max(n) AS max_n, count(*) AS n_carriers
FROM (SELECT dest, carrier, count(*) AS n FROM deliveries GROUP BY dest, carrier) GROUP BY dest""")
def drop_groups(t):
    g = t.deliveries.groupBy("dest", "carrier").agg(n_rows())
    return g.groupBy("dest").agg(F.round(F.avg("n"), 6).alias("mean_n"), F.max("n").alias("max_n"),
                                 F.count(F.lit(1)).alias("n_carriers"))
