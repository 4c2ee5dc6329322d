"""§2.2 projections / filters / predicates, §2.3 joins, §2.7 set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.logic import r_in, xor
from tessera.operators import joins, verbs
from tessera.workloads import query

DELIV_COLS = ("date, year, month, day, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, "
              "l_shipdate, carrier, flight, origin, dest, tailnum, sched_dep_time, dep_time, dep_delay, "
              "arr_delay, air_time, distance, time_hour")


@query("select_cols", section="2.2", sql="SELECT dest, carrier, dep_delay FROM deliveries")
def select_cols(t):
    return t.deliveries.select("dest", "carrier", "dep_delay")


@query("select_range", section="2.2", sql="""
SELECT date, year, month, day, carrier, flight, origin, dest, tailnum, sched_dep_time, dep_time,
       dep_delay, arr_delay, air_time, distance, time_hour FROM deliveries""")
def select_range(t):
    # select(-(l_orderkey:l_shipdate)): drop a positional range
    return verbs.select_range(t.deliveries, "l_orderkey", "l_shipdate", negate=True)


@query("select_where", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, carat, clarity, x, y, z, price FROM gems""")
def select_where(t):
    return verbs.select_where(t.gems, verbs.is_numeric)


@query("select_where_any_na", section="2.2", sql="SELECT dep_time, dep_delay, arr_delay, air_time FROM deliveries")
def select_where_any_na(t):
    return verbs.select_where_any_na(t.deliveries)


@query("relocate_front", section="2.2", sql="""
SELECT price, l_orderkey, l_partkey, l_suppkey, l_linenumber, carat, cut, color, clarity, x, y, z FROM gems""")
def relocate_front(t):
    return verbs.relocate_front(t.gems, "price")


@query("rename_col", section="2.2", sql="SELECT DISTINCT dest AS faa FROM deliveries")
def rename_col(t):
    return t.deliveries.select(F.col("dest").alias("faa")).distinct()


@query("mutate_cols", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, gain, hours, round(gain / hours, 6) AS gain_per_hour,
       dep_delay - 1 AS dep_delay
FROM (SELECT *, dep_delay - arr_delay AS gain, air_time / 60 AS hours FROM deliveries)""")
def mutate_cols(t):
    # later expressions see earlier ones; a same-name assignment overwrites
    d = verbs.mutate(t.deliveries,
                     gain=F.col("dep_delay") - F.col("arr_delay"),
                     hours=F.col("air_time") / 60,
                     gain_per_hour=F.round(F.try_divide(F.col("gain"), F.col("hours")), 6),
                     dep_delay=F.col("dep_delay") - 1)
    return d.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "gain", "hours",
                    "gain_per_hour", "dep_delay")


@query("mutate_keep_used", section="2.2", sql="""
SELECT dep_time, sched_dep_time, dep_time // 100 * 60 + dep_time % 100 AS dep_min,
       sched_dep_time // 100 * 60 + sched_dep_time % 100 AS sched_min FROM deliveries""")
def mutate_keep_used(t):
    from tessera.functions.scalars import hhmm_minutes
    return verbs.mutate_keep_used(t.deliveries, ["dep_time", "sched_dep_time"],
                                  dep_min=hhmm_minutes("dep_time"), sched_min=hhmm_minutes("sched_dep_time"))


@query("across_cast", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round_even(carat, 0) AS carat, cut, color, clarity,
       round_even(x, 0) AS x, round_even(y, 0) AS y, round_even(z, 0) AS z, round_even(price, 0) AS price FROM gems""")
def across_cast(t):
    # mutate(across(where(is.double), round))
    return verbs.across(t.gems, lambda f: f.dataType.typeName() == "double", lambda c: F.bround(c, 0))


@query("filter_and", section="2.2", sql="""
SELECT * FROM deliveries WHERE dest = 'Brand#1' AND dep_delay > 0 AND month IN (11, 12)""")
def filter_and(t):
    d = t.deliveries
    return verbs.filter_all(d, F.col("dest") == "Brand#1", F.col("dep_delay") > 0, F.col("month").isin(11, 12))


@query("filter_named_flag", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, dep_delay, distance, dep_delay < 0 AS early,
       distance > 50000 AS long_haul FROM deliveries WHERE dep_delay < 0 AND distance > 50000""")
def filter_named_flag(t):
    d = verbs.mutate(t.deliveries, early=F.col("dep_delay") < 0, long_haul=F.col("distance") > 50000)
    return d.filter(F.col("early") & F.col("long_haul")).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "dep_delay", "distance", "early", "long_haul")


@query("filter_between", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, x, x BETWEEN 3 AND 20 AS inside FROM gems
WHERE NOT (x BETWEEN 3 AND 20) OR x BETWEEN 10 AND 12""")
def filter_between(t):
    g = t.gems
    return g.filter(~F.col("x").between(3, 20) | F.col("x").between(10, 12)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "x", F.col("x").between(3, 20).alias("inside"))


@query("filter_in", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, month, arr_delay FROM deliveries
WHERE month IN (11, 12) AND (arr_delay IS NULL OR arr_delay IN (0, 1))""")
def filter_in(t):
    # %in% is never NA, and NA %in% c(NA, ...) is TRUE
    d = t.deliveries
    return d.filter(r_in("month", [11, 12]) & r_in("arr_delay", [None, 0.0, 1.0])).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "month", "arr_delay")


@query("filter_if_any_na", section="2.2", sql=f"""
SELECT {DELIV_COLS} FROM deliveries WHERE dep_time IS NULL OR dep_delay IS NULL OR arr_delay IS NULL OR air_time IS NULL""")
def filter_if_any_na(t):
    return verbs.filter_if_any_na(t.deliveries)


@query("na_omit", section="2.2", sql="""
SELECT dest, dep_delay, arr_delay FROM deliveries WHERE dep_delay IS NOT NULL AND arr_delay IS NOT NULL""")
def na_omit(t):
    return verbs.na_omit(t.deliveries.select("dest", "dep_delay", "arr_delay"))


@query("replace_outlier_na", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN x < 3 OR x > 20 THEN NULL ELSE x END AS x FROM gems""")
def replace_outlier_na(t):
    return t.gems.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         verbs.replace_outside("x", 3, 20).alias("x"))


@query("distinct_keys", section="2.2", sql="SELECT DISTINCT tailnum FROM deliveries")
def distinct_keys(t):
    return t.deliveries.select("tailnum").distinct()


@query("anti_join_natural", section="2.3", sql="""
SELECT faa AS dest FROM (SELECT DISTINCT dest AS faa FROM deliveries) d
WHERE NOT EXISTS (SELECT 1 FROM known_brands k WHERE k.dest IS NOT DISTINCT FROM d.faa)""")
def anti_join_natural(t):
    # distinct(faa = dest) |> anti_join(airports): natural key, NA matches NA
    d = t.deliveries.select("dest").distinct()
    return joins.anti_join(d, t.known_brands)


@query("semi_flag", section="2.3", sql="""
SELECT carrier, count(*) AS n, CAST(sum(CASE WHEN absent THEN 1 ELSE 0 END) AS BIGINT) AS n_absent,
       round(avg(CASE WHEN absent THEN 1.0 ELSE 0.0 END), 6) AS share_absent
FROM (SELECT carrier, tailnum NOT IN (SELECT tailnum FROM known_suppliers) AS absent FROM deliveries)
GROUP BY carrier""")
def semi_flag(t):
    d = joins.membership_flag(t.deliveries, "tailnum", t.known_suppliers, "tailnum", "present")
    return (d.withColumn("absent", ~F.col("present"))
            .groupBy("carrier")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if("absent").alias("n_absent"),
                 F.round(F.avg(F.col("absent").cast("double")), 6).alias("share_absent")))


@query("inner_join_multi", section="2.3", sql="""
SELECT d.l_orderkey, d.l_partkey, d.l_suppkey, d.l_linenumber, d.origin, d.day, d.dep_delay,
       w.n_events, w.mean_value, d.year AS year_x, w.year AS year_y
FROM deliveries d JOIN (SELECT *, CAST(2024 AS BIGINT) AS year FROM daily_events) w
  ON d.origin = w.origin AND d.day = w.day""")
def inner_join_multi(t):
    # two-key equi join; the shared non-key name `year` gets suffixes
    w = t.daily_events.withColumn("year", F.lit(2024).cast("bigint"))
    d = t.deliveries.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "origin", "day",
                            "dep_delay", "year")
    return joins.inner_join(d, w.select("origin", "day", "n_events", "mean_value", "year"), ["origin", "day"])


@query("bind_rows", section="2.7", sql="""
SELECT 'returns' AS model, l_returnflag AS level, count(*) AS n, NULL::DOUBLE AS mean_price FROM lineitem GROUP BY 2
UNION ALL
SELECT 'status' AS model, l_linestatus AS level, count(*) AS n, round(avg(l_extendedprice), 6) AS mean_price
FROM lineitem GROUP BY 2""")
def bind_rows_q(t):
    li = t.lineitem
    a = li.groupBy(F.col("l_returnflag").alias("level")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("model", F.lit("returns"))
    b = li.groupBy(F.col("l_linestatus").alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("l_extendedprice"), 6).alias("mean_price")) \
        .withColumn("model", F.lit("status"))
    return joins.bind_rows(a, b)


@query("combine_flags", section="2.7", sql="""
SELECT l_orderkey, l_linenumber, x AND NOT y AS x_not_y, NOT x AND y AS y_not_x, x <> y AS x_xor_y, x OR y AS x_or_y
FROM (SELECT l_orderkey, l_linenumber, l_quantity > 25 AS x, l_discount > 0.05 AS y FROM lineitem)
WHERE x OR y""")
def combine_flags(t):
    li = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") > 25).alias("x"),
                           (F.col("l_discount") > 0.05).alias("y"))
    return li.filter(F.col("x") | F.col("y")).select(
        "l_orderkey", "l_linenumber", (F.col("x") & ~F.col("y")).alias("x_not_y"),
        (~F.col("x") & F.col("y")).alias("y_not_x"), xor("x", "y").alias("x_xor_y"),
        (F.col("x") | F.col("y")).alias("x_or_y"))


@query("filter_group", section="2.2", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, dest, dep_delay FROM (
  SELECT *, avg(dep_delay) OVER (PARTITION BY dest) AS m FROM deliveries) WHERE dep_delay > m""")
def filter_group(t):
    # grouped filter(x > mean(x)): the group statistic is aggregated and joined back, not windowed
    from tessera.operators.agg import keep_on_rows
    d = t.deliveries.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "dest", "dep_delay")
    d = keep_on_rows(d, ["dest"], d.groupBy("dest").agg(F.avg("dep_delay").alias("_m")))
    return d.filter(F.col("dep_delay") > F.col("_m")).drop("_m")


def _na_count(c):
    return F.count_if(F.col(c).isNull())


def _r6mean(c):
    return F.round(F.avg(c), 6)


@query("across_fn", section="2.20", sql="""
SELECT origin, round(avg(dep_delay), 6) AS dep_delay_mean, round(avg(arr_delay), 6) AS arr_delay_mean,
       round(avg(air_time), 6) AS air_time_mean, count(*) FILTER (WHERE dep_delay IS NULL) AS dep_delay_na,
       count(*) FILTER (WHERE arr_delay IS NULL) AS arr_delay_na, count(*) FILTER (WHERE air_time IS NULL) AS air_time_na
FROM deliveries GROUP BY origin""")
def across_fn(t):
    # across(cols, list(mean = ~ mean(.x, na.rm = TRUE), na = ~ sum(is.na(.x)))): Column -> Column lambdas
    fns = {"mean": _r6mean, "na": _na_count}
    cols = ["dep_delay", "arr_delay", "air_time"]
    return t.deliveries.groupBy("origin").agg(*[f(c).alias(f"{c}_{n}") for n, f in fns.items() for c in cols])


@query("where_fn", section="2.20", sql="SELECT carrier, origin, dest FROM deliveries")
def where_fn(t):
    # select(where(is.character)): a predicate on the schema field
    return verbs.select_where(t.deliveries, verbs.is_character)
