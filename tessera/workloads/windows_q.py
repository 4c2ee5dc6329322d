"""§2.5 window functions and §2.6 sorts, top-k and sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.random import hash_uniform, hash_uniform_sql
from tessera.operators import sorting, windows
from tessera.operators.agg import keep_on_rows, n_distinct
from tessera.plans.ordered import exact_quantiles, scan
from tessera.plans.select import settled
from tessera.session import stored
from tessera.workloads import query

KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
KEY_SQL = ", ".join(KEY)
ORDER = ["date"] + KEY
ORDER_SQL = "date, " + KEY_SQL


def _d(t, *extra):
    return t.deliveries.select(*KEY, *[c for c in extra if c not in KEY])


@query("min_rank", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, arr_delay,
  CASE WHEN arr_delay IS NOT NULL THEN rank() OVER (PARTITION BY dest ORDER BY arr_delay ASC NULLS LAST) END AS min_rank,
  CASE WHEN arr_delay IS NOT NULL THEN rank() OVER (PARTITION BY dest ORDER BY arr_delay DESC NULLS LAST) END AS min_rank_desc
FROM deliveries""")
def min_rank_q(t):
    d = windows.min_rank(_d(t, "dest", "arr_delay"), ["dest"], "arr_delay", "min_rank")
    return windows.min_rank(d, ["dest"], "arr_delay", "min_rank_desc", desc=True)


@query("dense_rank", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, arr_delay,
  CASE WHEN arr_delay IS NOT NULL THEN dense_rank() OVER (PARTITION BY dest ORDER BY arr_delay ASC NULLS LAST) END AS dense_rank
FROM deliveries""")
def dense_rank_q(t):
    return windows.dense_rank(_d(t, "dest", "arr_delay"), ["dest"], "arr_delay", "dense_rank")


@query("row_number_x", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, arr_delay,
  CASE WHEN arr_delay IS NOT NULL THEN row_number() OVER (PARTITION BY dest ORDER BY arr_delay ASC NULLS LAST, {KEY_SQL}) END AS row_number
FROM deliveries""")
def row_number_x(t):
    return windows.row_number(_d(t, "dest", "arr_delay"), ["dest"], ["arr_delay"] + KEY, "row_number",
                              na_col="arr_delay")


@query("percent_rank", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, arr_delay,
  round(CASE WHEN arr_delay IS NOT NULL THEN (rank() OVER (PARTITION BY dest ORDER BY arr_delay ASC NULLS LAST) - 1)
        / (count(arr_delay) OVER (PARTITION BY dest) - 1) END, 6) AS percent_rank
FROM deliveries""")
def percent_rank_q(t):
    d = windows.percent_rank(_d(t, "dest", "arr_delay"), ["dest"], "arr_delay")
    return d.withColumn("percent_rank", F.round("percent_rank", 6))


@query("cume_dist", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, arr_delay,
  round(CASE WHEN arr_delay IS NOT NULL THEN count(arr_delay) OVER (PARTITION BY dest ORDER BY arr_delay
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / count(arr_delay) OVER (PARTITION BY dest) END, 6) AS cume_dist
FROM deliveries""")
def cume_dist_q(t):
    d = windows.cume_dist(_d(t, "dest", "arr_delay"), ["dest"], "arr_delay")
    return d.withColumn("cume_dist", F.round("cume_dist", 6))


@query("lag_lead", section="2.5", sql=f"""
SELECT {KEY_SQL}, tailnum, dep_delay,
  lag(dep_delay) OVER w AS lag_dep_delay, lead(dep_delay) OVER w AS lead_dep_delay,
  CASE WHEN row_number() OVER w = 1 THEN dep_delay ELSE lag(dep_delay) OVER w END AS lag_default
FROM deliveries WINDOW w AS (PARTITION BY tailnum ORDER BY {ORDER_SQL})""")
def lag_lead(t):
    d = _d(t, "date", "tailnum", "dep_delay")
    d = scan(d, ["tailnum"], ORDER, pos="_pos", lags=[("dep_delay", 1, "lag_dep_delay"), ("dep_delay", -1, "lead_dep_delay")])
    # lag(x, default = first(x)): the default fills only the group's first row
    d = d.withColumn("lag_default", F.when(F.col("_pos") == 1, F.col("dep_delay")).otherwise(F.col("lag_dep_delay")))
    return d.drop("_pos", "date")


@query("diff_prev", section="2.5", sql=f"""
SELECT {KEY_SQL}, carrier, distance, distance - lag(distance) OVER w AS diff, distance = lag(distance) OVER w AS same
FROM deliveries WINDOW w AS (PARTITION BY carrier ORDER BY {ORDER_SQL})""")
def diff_prev(t):
    d = windows.lag(_d(t, "date", "carrier", "distance"), ["carrier"], ORDER, "distance", 1, name="_prev")
    return d.select(*KEY, "carrier", "distance", (F.col("distance") - F.col("_prev")).alias("diff"),
                    (F.col("distance") == F.col("_prev")).alias("same"))


@query("cumsum_col", section="2.5", sql=f"""
SELECT {KEY_SQL}, carrier, round(sum(distance) OVER w, 2) AS cum_distance,
  CASE WHEN sum(CASE WHEN dep_delay IS NULL THEN 1 ELSE 0 END) OVER w = 0 THEN sum(dep_delay) OVER w END AS cum_delay
FROM deliveries WINDOW w AS (PARTITION BY carrier ORDER BY {ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def cumsum_col(t):
    d = _d(t, "date", "carrier", "distance", "dep_delay")
    d = scan(d, ["carrier"], ORDER, sums=[("distance", "cum_distance"), ("dep_delay", "cum_delay")])
    return d.select(*KEY, "carrier", F.round("cum_distance", 2).alias("cum_distance"), "cum_delay")


@query("gap_groups", section="2.5", sql="""
SELECT user_id, event_id, ts, CAST(sum(flag) OVER (PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS session
FROM (SELECT user_id, event_id, ts, CASE WHEN epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))
        >= 43200 THEN 1 ELSE 0 END AS flag FROM sessions_in)""")
def gap_groups(t):
    # cumsum(gap >= 12 h): consecutive session numbers per user, starting at 0
    e = t.sessions_in.select("user_id", "event_id", "ts")
    e = windows.lag(e, ["user_id"], ["ts", "event_id"], "ts", 1, name="_prev_ts")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_prev_ts").cast("timestamp"))
    e = e.withColumn("_flag", F.when(gap >= 43200 * 1_000_000, 1).otherwise(0))
    e = windows.running_sum(e, ["user_id"], ["ts", "event_id"], "_flag", "session")
    return e.select("user_id", "event_id", "ts", F.col("session").cast("bigint").alias("session"))


@query("rank_buckets", section="2.5", sql=f"""
SELECT {KEY_SQL}, (rn - 1) % 3 AS round_robin, (rn - 1) // 3 AS block
FROM (SELECT {KEY_SQL}, row_number() OVER (ORDER BY {KEY_SQL}) AS rn FROM lineitem)""")
def rank_buckets(t):
    # bare row_number() over the whole table: distributed positions, no single-task window
    d = windows.row_number(t.lineitem.select(*KEY), [], KEY, "rn")
    row0 = F.col("rn") - 1
    return d.select(*KEY, F.pmod(row0, F.lit(3)).cast("bigint").alias("round_robin"),
                    F.floor(row0 / 3).cast("bigint").alias("block"))


@query("group_prop", section="2.5", sql="""
SELECT dest, carrier, n, round(n / sum(n) OVER (PARTITION BY dest), 6) AS prop
FROM (SELECT dest, carrier, count(*) AS n FROM deliveries GROUP BY dest, carrier)""")
def group_prop(t):
    g = t.deliveries.groupBy("dest", "carrier").agg(F.count(F.lit(1)).alias("n"))
    return g.select("dest", "carrier", "n", F.round(windows.share_within("n", ["dest"]), 6).alias("prop"))


@query("global_prop", section="2.5", sql="""
SELECT origin, n, round(n / sum(n) OVER (), 6) AS prop FROM (SELECT origin, count(*) AS n FROM deliveries GROUP BY origin)""")
def global_prop(t):
    g = t.deliveries.groupBy("origin").agg(F.count(F.lit(1)).alias("n"))
    total = t.deliveries.agg(F.count(F.lit(1))).scalar()  # scalar subquery: no unpartitioned window
    return g.select("origin", "n", F.round(F.col("n") / total, 6).alias("prop"))


@query("group_stat_mutate", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, distance, round(quantile_cont(distance, 0.9) OVER (PARTITION BY dest), 6) AS q90,
  min(distance) OVER (PARTITION BY dest) AS min_dist, nd AS n_carriers
FROM deliveries JOIN (SELECT dest AS d2, count(DISTINCT carrier) AS nd FROM deliveries GROUP BY dest) ON dest = d2""")
def group_stat_mutate(t):
    d = stored(_d(t, "dest", "distance", "carrier"))  # read by the sketch, the selection, the summary and the join
    q = exact_quantiles(d, "distance", [0.9], by=["dest"]).select("dest", F.round("q0", 6).alias("q90"))
    s = d.groupBy("dest").agg(F.min("distance").alias("min_dist"), n_distinct("carrier").alias("n_carriers"))
    return keep_on_rows(d, ["dest"], settled(keep_on_rows(s, ["dest"], q))).drop("carrier")


@query("rel_to_group_min", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, air_time, ratio FROM (
  SELECT *, rank() OVER (PARTITION BY dest ORDER BY ratio DESC) AS r FROM (
    SELECT {KEY_SQL}, dest, air_time, round(air_time / min(air_time) OVER (PARTITION BY dest), 6) AS ratio
    FROM deliveries WHERE air_time IS NOT NULL)) WHERE r = 1""")
def rel_to_group_min(t):
    d = _d(t, "dest", "air_time").filter(F.col("air_time").isNotNull())
    d = keep_on_rows(d, ["dest"], d.groupBy("dest").agg(F.min("air_time").alias("_min")))
    d = d.withColumn("ratio", F.round(F.col("air_time") / F.col("_min"), 6)).drop("_min")
    # top rank = rows at the group maximum (ties kept): aggregate + join, no window
    top = d.groupBy("dest").agg(F.max("ratio").alias("ratio"))
    return d.join(top, ["dest", "ratio"])


@query("first_last_in_group", section="2.5", sql=f"""
SELECT {KEY_SQL}, dest, arr_delay, r FROM (
  SELECT {KEY_SQL}, dest, arr_delay, rank() OVER (PARTITION BY dest ORDER BY arr_delay) AS r,
         count(arr_delay) OVER (PARTITION BY dest) AS n_nn, max(arr_delay) OVER (PARTITION BY dest) AS mx
  FROM deliveries WHERE arr_delay IS NOT NULL) WHERE r = 1 OR arr_delay = mx""")
def first_last_in_group(t):
    # filter(r %in% c(1, max(r))) with r = min_rank(x): the rows at both ends, ties kept
    d = windows.min_rank(_d(t, "dest", "arr_delay").filter(F.col("arr_delay").isNotNull()), ["dest"], "arr_delay", "r")
    mx = d.groupBy("dest").agg(F.max("r").alias("_mx"))
    return keep_on_rows(d, ["dest"], mx).filter((F.col("r") == 1) | (F.col("r") == F.col("_mx"))).drop("_mx")


@query("arrange_multi", section="2.6", sql="""
SELECT dest, arr_delay, flight FROM deliveries ORDER BY dest, arr_delay DESC NULLS LAST, flight""")
def arrange_multi(t):
    return sorting.arrange(t.deliveries.select("dest", "arr_delay", "flight"), "dest", sorting.desc("arr_delay"), "flight")


@query("top_n_global", section="2.6", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, price FROM gems
ORDER BY price DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 6""")
def top_n_global(t):
    g = t.gems.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "price")
    return sorting.arrange(g, sorting.desc("price"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").limit(6)


@query("top_k_rank", section="2.6", sql=f"""
SELECT {KEY_SQL}, dep_delay, r FROM (SELECT {KEY_SQL}, dep_delay, rank() OVER (ORDER BY dep_delay DESC) AS r
FROM deliveries WHERE dep_delay IS NOT NULL) WHERE r <= 10""")
def top_k_rank(t):
    # min_rank(desc(delay)) <= 10: ties kept.  The 10th value is found by a top-k,
    # then every row at or above it is kept and ranked among those few rows.
    d = _d(t, "dep_delay").filter(F.col("dep_delay").isNotNull())
    cut = d.orderBy(F.desc("dep_delay")).limit(10).agg(F.min("dep_delay")).scalar()
    top = d.filter(F.col("dep_delay") >= cut)
    return windows.min_rank(top, [], "dep_delay", "r", desc=True).filter(F.col("r") <= 10)


@query("top_k_group", section="2.6", sql=f"""
SELECT {KEY_SQL}, dest, dep_delay FROM (SELECT {KEY_SQL}, dest, dep_delay,
  row_number() OVER (PARTITION BY dest ORDER BY dep_delay, {KEY_SQL}) AS rn FROM deliveries WHERE dep_delay IS NOT NULL)
WHERE rn < 4""")
def top_k_group(t):
    d = _d(t, "dest", "dep_delay").filter(F.col("dep_delay").isNotNull())
    return sorting.top_k_per_group(d, 3, ["dest"], [F.col("dep_delay")] + [F.col(k) for k in KEY]).drop("_rn")


@query("sort_factor", section="2.6", sql="""
SELECT id, relig, relig_ord FROM survey JOIN (SELECT relig AS lv, CAST(row_number() OVER (ORDER BY relig) AS BIGINT) AS relig_ord
FROM (SELECT DISTINCT relig FROM survey)) ON relig = lv ORDER BY relig_ord, id""")
def sort_factor(t):
    from tessera.operators.factors import apply_levels, levels_sorted
    s = t.survey.select("id", "relig")
    return apply_levels(s, "relig", levels_sorted(s, "relig")).orderBy("relig_ord", "id")


SAMPLE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query("sample_n", section="2.6", sql=f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, carat, price FROM gems
ORDER BY {sorting.hash_key_sql(1984, SAMPLE_KEY)}, carat, price LIMIT 1000""")
def sample_n(t):
    # equal rows have equal hashes: which of them is drawn makes no difference
    g = t.gems.select(*SAMPLE_KEY, "carat", "price")
    return g.orderBy(sorting.hash_key(1984, SAMPLE_KEY), "carat", "price").limit(1000)


@query("sample_n_by", section="2.6", sql=f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, cut, price FROM (
  SELECT *, row_number() OVER (PARTITION BY cut ORDER BY {sorting.hash_key_sql(1984, ['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber'])}) AS rn
  FROM gems WHERE carat < 3) WHERE rn <= 500""")
def sample_n_by(t):
    g = t.gems.filter(F.col("carat") < 3)
    s = sorting.sample_n_by(g, 500, 1984, ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], ["cut"])
    return s.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cut", "price")


@query("sample_index_na", section="2.6", sql=f"""
SELECT o_orderkey, CASE WHEN {hash_uniform_sql(7, 'o_orderkey')} < 1.0 / 3 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders""")
def sample_index_na(t):
    o = t.orders
    return o.select("o_orderkey", F.when(hash_uniform(7, "o_orderkey") < 1.0 / 3, F.lit(None))
                    .otherwise(F.col("o_totalprice")).alias("o_totalprice"))
