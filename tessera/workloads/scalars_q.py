"""§2.9 numeric scalars, §2.10 logical / conditional functions, §2.12 dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import logic, scalars
from tessera.functions.dates import FEASTS, date_parts, easter_sql, holiday_flags
from tessera.operators import windows
from tessera.plans.ordered import exact_quantiles
from tessera.workloads import query

LK = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
LK_SQL = ", ".join(LK)


@query("arith_recycle", section="2.9", sql="""
SELECT o_orderkey, o_totalprice / 5 AS div5, o_totalprice * CASE WHEN (rn - 1) % 2 = 0 THEN 1 ELSE 2 END AS times12,
       o_totalprice * CASE (rn - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS times123
FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)""")
def arith_recycle(t):
    # x * c(1, 2): the short vector is recycled along row positions
    o = windows.row_number(t.orders.select("o_orderkey", "o_totalprice"), [], ["o_orderkey"], "rn")
    return o.select("o_orderkey", (F.col("o_totalprice") / 5).alias("div5"),
                    (F.col("o_totalprice") * scalars.recycle("rn", [1, 2])).alias("times12"),
                    (F.col("o_totalprice") * scalars.recycle("rn", [1, 2, 3])).alias("times123"))


@query("pmin_pmax", section="2.9", sql="""
SELECT l_orderkey, l_linenumber, least(dep_delay, arr_delay) AS row_min, greatest(dep_delay, arr_delay) AS row_max,
       (SELECT min(least(dep_delay, arr_delay)) FROM deliveries) AS col_min,
       (SELECT max(greatest(dep_delay, arr_delay)) FROM deliveries) AS col_max FROM deliveries""")
def pmin_pmax(t):
    # pmin/pmax are row-wise (NA skipped); min/max in mutate are whole-column values
    d = t.deliveries
    rmin, rmax = F.least("dep_delay", "arr_delay"), F.greatest("dep_delay", "arr_delay")
    col_min = d.agg(F.min(rmin)).scalar()
    col_max = d.agg(F.max(rmax)).scalar()
    return d.select("l_orderkey", "l_linenumber", rmin.alias("row_min"), rmax.alias("row_max"),
                    col_min.alias("col_min"), col_max.alias("col_max"))


@query("intdiv_mod", section="2.9", sql="""
SELECT l_orderkey, l_linenumber, CAST(floor((l_partkey - 1000) / 7) AS BIGINT) AS q,
       (l_partkey - 1000) - 7 * CAST(floor((l_partkey - 1000) / 7) AS BIGINT) AS r,
       (l_partkey - 1000) - (-7) * CAST(floor((l_partkey - 1000) / -7) AS BIGINT) AS r_negdiv FROM lineitem""")
def intdiv_mod(t):
    x = F.col("l_partkey") - 1000
    return t.lineitem.select("l_orderkey", "l_linenumber", scalars.intdiv(x, 7).alias("q"),
                             scalars.r_mod(x, 7).alias("r"), scalars.r_mod(x, -7).alias("r_negdiv"))


@query("hhmm_split", section="2.9", sql=f"""
SELECT {LK_SQL}, sched_dep_time // 100 AS hour, sched_dep_time % 100 AS minute,
       round(sched_dep_time // 100 + (sched_dep_time % 100) / 60, 6) AS hours FROM deliveries""")
def hhmm_split(t):
    s = F.col("sched_dep_time")
    return t.deliveries.select(*LK, scalars.intdiv(s, 100).cast("bigint").alias("hour"),
                               scalars.r_mod(s, 100).alias("minute"),
                               F.round(scalars.hhmm_hours(s), 6).alias("hours"))


@query("round_5min", section="2.9", sql=f"""
SELECT {LK_SQL}, sched_dep_time, h * 100 + m5 AS faithful, ((h + m5 // 60) % 24) * 100 + m5 % 60 AS carried
FROM (SELECT {LK_SQL}, sched_dep_time, sched_dep_time // 100 AS h,
             CAST(round_even((sched_dep_time % 100) / 5, 0) * 5 AS BIGINT) AS m5 FROM deliveries)""")
def round_5min(t):
    # the faithful form rounds :57-:59 to :60 without a carry; the carried form wraps the hour
    s = F.col("sched_dep_time")
    h = scalars.intdiv(s, 100)
    m5 = (F.bround(scalars.r_mod(s, 100) / 5, 0) * 5).cast("bigint")
    return t.deliveries.select(*LK, "sched_dep_time", (h * 100 + m5).cast("bigint").alias("faithful"),
                               (F.pmod(h + scalars.intdiv(m5, 60), F.lit(24)) * 100 + F.pmod(m5, F.lit(60)))
                               .cast("bigint").alias("carried"))


@query("round_digits", section="2.9", sql="""
SELECT o_orderkey, round_even(o_totalprice, 0) AS r0, round_even(o_totalprice / 7, 2) AS r2,
       round_even(o_totalprice, -1) AS r_1, round_even(o_totalprice, -3) AS r_3 FROM orders""")
def round_digits(t):
    x = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.bround(x, 0).alias("r0"), F.bround(x / 7, 2).alias("r2"),
                           F.bround(x, -1).alias("r_1"), F.bround(x, -3).alias("r_3"))


@query("floor_ceil", section="2.9", sql="""
SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS DOUBLE) AS fl, CAST(ceil(o_totalprice / 1000) AS DOUBLE) AS ce,
       round(floor(o_totalprice / 0.01) * 0.01, 6) AS fl_cent FROM orders""")
def floor_ceil(t):
    x = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.floor(x / 1000).cast("double").alias("fl"),
                           F.ceil(x / 1000).cast("double").alias("ce"),
                           F.round(scalars.floor_to(x, 0.01), 6).alias("fl_cent"))


@query("round_multiple", section="2.9", sql="""
SELECT o_orderkey, round_even(o_totalprice / 4, 0) * 4 AS to4, round(round_even(o_totalprice / 0.25, 0) * 0.25, 6) AS to_quarter
FROM orders""")
def round_multiple(t):
    return t.orders.select("o_orderkey", scalars.round_multiple("o_totalprice", 4).alias("to4"),
                           F.round(scalars.round_multiple("o_totalprice", 0.25), 6).alias("to_quarter"))


@query("abs_val", section="2.9", sql="""
SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS dev,
       CASE WHEN l_quantity - 25 < 0 THEN -(l_quantity - 25) ELSE l_quantity - 25 END AS dev2 FROM lineitem""")
def abs_val(t):
    v = F.col("l_quantity") - 25
    return t.lineitem.select("l_orderkey", "l_linenumber", F.abs(v).alias("dev"),
                             F.when(v < 0, -v).otherwise(v).alias("dev2"))


@query("log_exp", section="2.9", sql="""
SELECT l_orderkey, l_linenumber, ln(l_discount) AS ln_disc, round(log10(l_extendedprice), 6) AS lg,
       round(exp(l_discount), 6) AS ex, round(sqrt(l_quantity), 6) AS sq FROM lineitem""")
def log_exp(t):
    # log(0) = -Inf as in R (Spark's ln(0) is NULL)
    return t.lineitem.select("l_orderkey", "l_linenumber", scalars.r_log("l_discount").alias("ln_disc"),
                             F.round(F.log10("l_extendedprice"), 6).alias("lg"),
                             F.round(F.exp("l_discount"), 6).alias("ex"), F.round(F.sqrt("l_quantity"), 6).alias("sq"))


@query("near_tol", section="2.9", sql="""
SELECT l_orderkey, l_linenumber, abs(sqrt(l_quantity) * sqrt(l_quantity) - l_quantity) < 1.5e-8 AS near_default,
       sqrt(l_quantity) * sqrt(l_quantity) = l_quantity AS exact FROM lineitem""")
def near_tol(t):
    sq = F.sqrt("l_quantity") * F.sqrt("l_quantity")
    return t.lineitem.select("l_orderkey", "l_linenumber", logic.near(sq, "l_quantity").alias("near_default"),
                             (sq == F.col("l_quantity")).alias("exact"))


@query("parity", section="2.9", sql="""
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, count(*) AS n FROM lineitem GROUP BY 1""")
def parity(t):
    p = F.when(F.pmod("l_linenumber", F.lit(2)) == 0, "even").otherwise("odd")
    return t.lineitem.groupBy(p.alias("parity")).agg(F.count(F.lit(1)).alias("n"))


@query("last_digit", section="2.9", sql="""
SELECT CAST(floor(price) AS BIGINT) % 10 AS digit, count(*) AS n FROM gems GROUP BY 1""")
def last_digit(t):
    return t.gems.groupBy(F.pmod(F.floor("price"), F.lit(10)).alias("digit")).agg(F.count(F.lit(1)).alias("n"))


@query("cut_breaks", section="2.9", sql="""
SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'sm' WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'md'
            WHEN l_quantity > 25 AND l_quantity <= 40 THEN 'lg' WHEN l_quantity > 40 AND l_quantity <= 45 THEN 'xl' END AS size,
       count(*) AS n FROM lineitem GROUP BY 1""")
def cut_breaks(t):
    b = scalars.cut_breaks("l_quantity", [0, 10, 25, 40, 45], ["sm", "md", "lg", "xl"])
    return t.lineitem.groupBy(b.alias("size")).agg(F.count(F.lit(1)).alias("n"))


@query("cut_width", section="2.9", sql="""
SELECT round(y0 + (greatest(ceil((y - y0) / 2), floor(((SELECT min(y) FROM gems) - y0) / 2) + 1) - 0.5) * 2, 6) AS bin, count(*) AS n
FROM gems, (SELECT CAST(0 AS DOUBLE) AS y0) GROUP BY 1""")
def cut_width(t):
    # y = 0 lies on the lowest edge: it belongs to the first bin, not to one below it
    low = t.gems.agg(F.min("y")).scalar()
    bins = F.round(scalars.cut_width_bin("y", 2.0, boundary=0.0, lowest=low), 6)
    return t.gems.groupBy(bins.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("cut_number", section="2.9", sql="""
WITH e AS (SELECT quantile_cont(price, [0.2, 0.4, 0.6, 0.8]) AS q FROM gems)
SELECT 1 + CAST((price > q[1]) AS BIGINT) + CAST((price > q[2]) AS BIGINT) + CAST((price > q[3]) AS BIGINT)
         + CAST((price > q[4]) AS BIGINT) AS bin, count(*) AS n, min(price) AS lo, max(price) AS hi
FROM gems, e GROUP BY 1""")
def cut_number(t):
    # equal-count bins: type-7 quantile edges (one small row) inlined as a scalar subquery
    edges = exact_quantiles(t.gems, "price", [0.2, 0.4, 0.6, 0.8]).select(F.array("q0", "q1", "q2", "q3")).scalar()
    above = [(F.col("price") > F.element_at(edges, i)).cast("bigint") for i in range(1, 5)]
    g = t.gems.withColumn("bin", above[0] + above[1] + above[2] + above[3] + 1)
    return g.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi"))


@query("na_compare", section="2.10", sql=f"""
SELECT {LK_SQL}, arr_delay > 5 AS gt5, arr_delay = NULL AS eq_na, NULL = NULL AS na_na FROM deliveries""")
def na_compare(t):
    na = F.lit(None).cast("double")
    return t.deliveries.select(*LK, (F.col("arr_delay") > 5).alias("gt5"), (F.col("arr_delay") == na).alias("eq_na"),
                               (na == na).alias("na_na"))


def _with_nan(t):
    # NaN created from data: 0/0 where the discount is zero, R-style (Spark's ANSI mode would raise)
    d = F.col("l_discount")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(d == 0, F.lit(float("nan"))).otherwise(d).alias("x"),
                             F.when(F.col("l_tax") == 0, F.lit(None)).otherwise(F.col("l_tax")).alias("y"))


@query("is_na", section="2.10", sql="""
SELECT l_orderkey, l_linenumber, x IS NULL OR isnan(x) AS x_na, y IS NULL OR isnan(y) AS y_na, isnan(x) AS x_nan
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN 'NaN'::DOUBLE ELSE l_discount END AS x,
             CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS y FROM lineitem)""")
def is_na(t):
    d = _with_nan(t)
    return d.select("l_orderkey", "l_linenumber", logic.is_na("x", d.schema["x"].dataType).alias("x_na"),
                    logic.is_na("y", d.schema["y"].dataType).alias("y_na"), F.isnan("x").alias("x_nan"))


@query("is_nan", section="2.10", sql="""
SELECT count(*) FILTER (WHERE isnan(l_discount / l_discount)) AS zero_div_zero,
       count(*) FILTER (WHERE isnan(l_discount * (1 / l_discount))) AS zero_times_inf,
       count(*) FILTER (WHERE isnan(1 / l_discount - 1 / l_discount)) AS inf_minus_inf,
       count(*) FILTER (WHERE isnan(sqrt(-l_quantity))) AS sqrt_neg FROM lineitem""")
def is_nan(t):
    d = F.col("l_discount")
    inv = logic_r_divide(F.lit(1.0), d)
    return t.lineitem.agg(F.count_if(F.isnan(logic_r_divide(d, d))).alias("zero_div_zero"),
                          F.count_if(F.isnan(d * inv)).alias("zero_times_inf"),
                          F.count_if(F.isnan(inv - inv)).alias("inf_minus_inf"),
                          F.count_if(F.isnan(F.sqrt(-F.col("l_quantity")))).alias("sqrt_neg"))


def logic_r_divide(a, b):
    return logic.r_divide(a, b)


@query("kleene", section="2.10", sql=f"""
SELECT {LK_SQL}, (dep_delay > 0) AND (arr_delay > 0) AS both_late, (dep_delay > 0) OR (arr_delay > 0) AS any_late
FROM deliveries""")
def kleene(t):
    a, b = F.col("dep_delay") > 0, F.col("arr_delay") > 0
    return t.deliveries.select(*LK, (a & b).alias("both_late"), (a | b).alias("any_late"))


@query("xor_op", section="2.10", sql=f"SELECT {LK_SQL}, (dep_delay > 0) <> (arr_delay > 0) AS one_late FROM deliveries")
def xor_op(t):
    return t.deliveries.select(*LK, logic.xor(F.col("dep_delay") > 0, F.col("arr_delay") > 0).alias("one_late"))


@query("if_else3", section="2.10", sql=f"""
SELECT {LK_SQL}, CASE WHEN arr_delay IS NULL THEN 'unknown' WHEN arr_delay > 0 THEN 'late' ELSE 'on time' END AS status,
       CASE WHEN arr_delay IS NULL THEN NULL WHEN arr_delay > 0 THEN 'late' ELSE 'on time' END AS status_na FROM deliveries""")
def if_else3(t):
    c = F.col("arr_delay") > 0
    return t.deliveries.select(*LK, logic.if_else(c, "late", "on time", "unknown").alias("status"),
                               logic.if_else(c, "late", "on time").alias("status_na"))


@query("if_else_nested", section="2.10", sql=f"""
SELECT {LK_SQL}, CASE WHEN arr_delay IS NULL THEN NULL WHEN arr_delay > 0 THEN
  (CASE WHEN arr_delay > 1000 THEN 'very' ELSE 'some' END) ELSE 'none' END AS lateness FROM deliveries""")
def if_else_nested(t):
    a = F.col("arr_delay")
    return t.deliveries.select(*LK, logic.if_else(a > 0, logic.if_else(a > 1000, "very", "some"), "none").alias("lateness"))


@query("case_when", section="2.10", sql=f"""
SELECT {LK_SQL}, CASE WHEN l_quantity - 25 > 0 THEN '+ve' WHEN l_quantity - 25 > 2 THEN 'big'
  WHEN l_quantity - 25 < 0 THEN '-ve' END AS sign FROM lineitem""")
def case_when(t):
    # overlapping arms: the first match wins, so "big" never appears; no match (0) -> NA
    x = F.col("l_quantity") - 25
    return t.lineitem.select(*LK, logic.case_when((x > 0, F.lit("+ve")), (x > 2, F.lit("big")),
                                                  (x < 0, F.lit("-ve"))).alias("sign"))


def delay_status():
    d = F.col("dep_delay")
    return logic.case_when(
        (F.col("dep_time").isNull(), F.lit("cancelled")),
        (d < -1000, F.lit("very early")),
        (d < -30, F.lit("early")),
        (F.abs(d) <= 30, F.lit("on time")),
        (d < 1000, F.lit("late")),
        (d < float("inf"), F.lit("very late")))


DELAY_STATUS_SQL = """CASE WHEN dep_time IS NULL THEN 'cancelled' WHEN dep_delay < -1000 THEN 'very early'
  WHEN dep_delay < -30 THEN 'early' WHEN abs(dep_delay) <= 30 THEN 'on time' WHEN dep_delay < 1000 THEN 'late'
  WHEN dep_delay < 'Infinity'::DOUBLE THEN 'very late' END"""


@query("case_when_status", section="2.10", sql=f"""
SELECT {DELAY_STATUS_SQL} AS status, count(*) AS n FROM deliveries GROUP BY 1""")
def case_when_status(t):
    return t.deliveries.groupBy(delay_status().alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("type_mismatch", section="2.10", sql=f"""
SELECT {LK_SQL}, CASE WHEN arr_delay IS NULL THEN NULL WHEN arr_delay > 0 THEN 'late' ELSE origin END AS label FROM deliveries""")
def type_mismatch(t):
    # branch types are checked up front (R raises on if_else(TRUE, "a", 1)); compatible branches pass
    d = t.deliveries
    yes, no = F.lit("late"), F.col("origin")
    logic.check_branch_types(d, yes, no)
    return d.select(*LK, logic.if_else(F.col("arr_delay") > 0, yes, no).alias("label"))


@query("week_label", section="2.10", sql="""
SELECT CASE WHEN dayname(date) IN ('Saturday', 'Sunday') THEN 'weekend' ELSE 'weekday' END AS day_type, count(*) AS n
FROM deliveries GROUP BY 1""")
def week_label(t):
    wd = F.date_format("date", "EEEE")
    lab = F.when(logic.r_in(wd, ["Saturday", "Sunday"]), "weekend").otherwise("weekday")
    return t.deliveries.groupBy(lab.alias("day_type")).agg(F.count(F.lit(1)).alias("n"))


@query("holiday_label", section="2.10", sql="""
SELECT holiday IS NOT NULL AS is_holiday, holiday, count(*) AS n FROM (
  SELECT CASE WHEN month = 1 AND day = 1 THEN 'New Year' WHEN month = 7 AND day = 4 THEN '4th of July'
    WHEN month = 11 AND day BETWEEN 22 AND 28 AND dayname(date) = 'Thursday' THEN 'Thanksgiving'
    WHEN month = 12 AND day IN (24, 25) THEN 'Christmas' END AS holiday FROM deliveries) GROUP BY 1, 2""")
def holiday_label(t):
    # count(is_holiday, holiday) over all rows: ordinary days are counted too
    m, dd = F.col("month"), F.col("day")
    thanks = (m == 11) & dd.between(22, 28) & (F.date_format("date", "EEEE") == "Thursday")
    lab = logic.case_when(((m == 1) & (dd == 1), F.lit("New Year")), ((m == 7) & (dd == 4), F.lit("4th of July")),
                          (thanks, F.lit("Thanksgiving")), ((m == 12) & dd.isin(24, 25), F.lit("Christmas")))
    d = t.deliveries.select(lab.alias("holiday"))
    return d.groupBy(F.col("holiday").isNotNull().alias("is_holiday"), "holiday").agg(F.count(F.lit(1)).alias("n"))


@query("as_date", section="2.12", sql=f"SELECT {LK_SQL}, CAST(time_hour AS DATE) AS date_only FROM deliveries")
def as_date(t):
    return t.deliveries.select(*LK, F.to_date("time_hour").alias("date_only"))


@query("day_of_year_seq", section="2.12", sql="""
SELECT year, month, day, row_number() OVER (PARTITION BY year ORDER BY month, day) AS day_num, n
FROM (SELECT year, month, day, count(*) AS n FROM deliveries GROUP BY year, month, day)""")
def day_of_year_seq(t):
    days = t.deliveries.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))
    return windows.row_number(days, ["year"], ["month", "day"], "day_num")


@query("date_parts", section="2.12", sql="""
SELECT strftime(date, '%a') AS date_dow, strftime(date, '%b') AS date_month, CAST(year(date) AS BIGINT) AS date_year,
       count(*) AS n FROM deliveries GROUP BY 1, 2, 3""")
def date_parts_q(t):
    return t.deliveries.groupBy(*date_parts("date")).agg(F.count(F.lit(1)).alias("n"))


def _holiday_sql(col):
    y = f"year({col})"
    e = easter_sql(y)
    parts = {
        "AllSouls": f"make_date({y}, 11, 2)", "AshWednesday": f"({e} - 46)", "ChristmasEve": f"make_date({y}, 12, 24)",
        "Easter": e, "ChristmasDay": f"make_date({y}, 12, 25)", "GoodFriday": f"({e} - 2)",
        "NewYearsDay": f"make_date({y}, 1, 1)", "PalmSunday": f"({e} - 7)",
    }
    return ", ".join(f"CAST({col} = {v} AS INTEGER) AS {col}_{k}" for k, v in parts.items())


@query("holiday_flags", section="2.12", sql=f"""
SELECT doc_id, arrival_date, {_holiday_sql('arrival_date')} FROM doc_quality""")
def holiday_flags_q(t):
    d = t.doc_quality
    return d.select("doc_id", "arrival_date", *holiday_flags("arrival_date", FEASTS))


@query("string_na_text", section="2.12", sql="""
SELECT doc_id, CASE WHEN lang = 'fr' THEN NULL ELSE lang END AS lang2,
       (CASE WHEN lang = 'fr' THEN NULL ELSE lang END) IS NULL AS lang_na FROM documents""")
def string_na_text(t):
    l2 = F.when(F.col("lang") == "fr", F.lit(None)).otherwise(F.col("lang"))
    return t.documents.select("doc_id", l2.alias("lang2"), l2.isNull().alias("lang_na"))
