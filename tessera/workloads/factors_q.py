"""§2.11 factors: level tables, reordering, recoding and lumping."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import factors, leveled
from tessera.workloads import query

TYPO_MONTHS = ["Jam"] + factors.MONTH_ABB[1:]


def _case_pos(expr, levels):
    arms = " ".join(f"WHEN '{lv}' THEN {i}" for i, lv in enumerate(levels, 1))
    return f"CASE {expr} {arms} END"


def _n():
    return F.count(F.lit(1)).alias("n")


@query("fct_new", section="2.11", sql=f"""
SELECT CASE WHEN {_case_pos("strftime(o_orderdate, '%b')", TYPO_MONTHS)} IS NOT NULL THEN strftime(o_orderdate, '%b') END AS month,
       CAST({_case_pos("strftime(o_orderdate, '%b')", TYPO_MONTHS)} AS BIGINT) AS month_ord, count(*) AS n
FROM orders GROUP BY 1, 2""")
def fct_new(t):
    # factor(x, levels) with a misspelt level: the unmatched month silently becomes NA
    o = t.orders.select(F.date_format("o_orderdate", "MMM").alias("month"))
    return factors.fct_new(o, "month", TYPO_MONTHS).groupBy("month", "month_ord").agg(_n())


@query("fct_strict", section="2.11", sql="""
SELECT strftime(o_orderdate, '%b') AS month, CAST(month(o_orderdate) AS BIGINT) AS month_ord, count(*) AS n FROM orders GROUP BY 1, 2""")
def fct_strict(t):
    # fct(x, levels): an unknown value raises (tested); with complete levels it passes
    o = t.orders.select(F.date_format("o_orderdate", "MMM").alias("month"))
    return factors.fct_strict(o, "month", factors.MONTH_ABB).groupBy("month", "month_ord").agg(_n())


@query("fct_levels", section="2.11", sql="""
SELECT relig AS level, row_number() OVER (ORDER BY relig) AS ord FROM (SELECT DISTINCT relig FROM survey)""")
def fct_levels(t):
    return factors.levels_sorted(t.survey, "relig")


@query("fct_reorder", section="2.11", sql="""
SELECT relig AS level, row_number() OVER (ORDER BY median(tvhours), relig) AS ord FROM survey GROUP BY relig""")
def fct_reorder(t):
    return factors.fct_reorder_median(t.survey, "relig", "tvhours")


@query("fct_reorder2", section="2.11", sql="""
SELECT partyid AS level, row_number() OVER (ORDER BY y DESC, partyid) AS ord FROM (
  SELECT partyid, tvhours AS y, row_number() OVER (PARTITION BY partyid ORDER BY age DESC, tvhours DESC) AS rn
  FROM survey WHERE age IS NOT NULL) WHERE rn = 1""")
def fct_reorder2(t):
    return factors.fct_reorder2(t.survey, "partyid", "age", "tvhours")


@query("reorder_mean", section="2.11", sql="""
SELECT dest AS level, row_number() OVER (ORDER BY avg(dep_delay), dest) AS ord FROM deliveries GROUP BY dest""")
def reorder_mean(t):
    return factors.levels_by(t.deliveries, "dest", F.avg("dep_delay"))


@query("fct_relevel", section="2.11", sql="""
SELECT level, row_number() OVER (ORDER BY CASE WHEN level = 'MACHINERY' THEN 0 ELSE 1 END, level) AS ord
FROM (SELECT DISTINCT rincome AS level FROM survey)""")
def fct_relevel(t):
    return factors.fct_relevel(factors.levels_sorted(t.survey, "rincome"), ["MACHINERY"])


@query("fct_infreq", section="2.11", sql="""
SELECT marital AS level, row_number() OVER (ORDER BY count(*) DESC, marital) AS ord FROM survey GROUP BY marital""")
def fct_infreq(t):
    return factors.fct_infreq(t.survey, "marital")


@query("fct_rev", section="2.11", sql="""
SELECT marital AS level, row_number() OVER (ORDER BY count(*), marital DESC) AS ord FROM survey GROUP BY marital""")
def fct_rev(t):
    return factors.fct_rev(factors.fct_infreq(t.survey, "marital"))


@query("fct_recode", section="2.11", sql="""
SELECT CASE partyid WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '4-NOT SPECIFIED' THEN 'Low'
  WHEN '5-LOW' THEN 'Low' ELSE partyid END AS partyid, count(*) AS n FROM survey GROUP BY 1""")
def fct_recode(t):
    # unlisted levels kept; a repeated new name merges two levels
    m = {"Urgent": "1-URGENT", "High": "2-HIGH", "Low": ["4-NOT SPECIFIED", "5-LOW"]}
    return t.survey.groupBy(factors.fct_recode("partyid", m).alias("partyid")).agg(_n())


@query("fct_collapse", section="2.11", sql="""
SELECT CASE WHEN relig IN ('R0', 'R1') THEN 'low' WHEN relig IN ('R2', 'R3', 'R4') THEN 'mid' ELSE relig END AS relig,
       count(*) AS n FROM survey GROUP BY 1""")
def fct_collapse(t):
    return t.survey.groupBy(factors.fct_collapse("relig", {"low": ["R0", "R1"], "mid": ["R2", "R3", "R4"]})
                            .alias("relig")).agg(_n())


@query("fct_lump_lowfreq", section="2.11", sql="""
WITH c AS (SELECT relig AS level, count(*) AS n FROM survey GROUP BY relig),
r AS (SELECT level, n, row_number() OVER (ORDER BY n DESC, level) AS i,
      coalesce(sum(n) OVER (ORDER BY n DESC, level ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS left_n FROM c),
cut AS (SELECT coalesce(min(i) FILTER (WHERE n > left_n), 1000000000) AS k FROM r)
SELECT CASE WHEN i > k THEN 'Other' ELSE level END AS relig, CAST(sum(n) AS BIGINT) AS n FROM r, cut GROUP BY 1""")
def fct_lump_lowfreq(t):
    s = t.survey
    counts = s.groupBy(F.col("relig").alias("level")).agg(_n())
    m = factors.lump_lowfreq_table(counts)
    return (s.join(m, s.relig == m.level)  # one row per level
            .groupBy(F.col("new_level").alias("relig")).agg(_n()))


@query("fct_lump_n", section="2.11", sql="""
WITH c AS (SELECT relig AS level, count(*) AS n FROM survey GROUP BY relig),
r AS (SELECT level, n, rank() OVER (ORDER BY n DESC) AS rk FROM c),
k AS (SELECT count(*) FILTER (WHERE rk > 3) AS n_out FROM r)
SELECT CASE WHEN rk > 3 AND n_out > 1 THEN 'Other' ELSE level END AS relig, CAST(sum(n) AS BIGINT) AS n FROM r, k GROUP BY 1""")
def fct_lump_n(t):
    # the existing level named "Other" merges with the lump
    s = t.survey
    counts = s.groupBy(F.col("relig").alias("level")).agg(_n())
    m = factors.lump_n_table(counts, 3)
    return s.join(m, s.relig == m.level).groupBy(F.col("new_level").alias("relig")).agg(_n())


@query("fct_interaction", section="2.11", sql="""
SELECT race || '.' || marital AS race_marital, count(*) AS n FROM survey GROUP BY 1""")
def fct_interaction(t):
    return t.survey.groupBy(factors.fct_interaction("race", "marital").alias("race_marital")).agg(_n())


@query("num_to_factor", section="2.11", sql="""
SELECT CAST(year AS VARCHAR) AS level, row_number() OVER (ORDER BY year) AS ord FROM (SELECT DISTINCT year FROM survey)""")
def num_to_factor(t):
    # factor(year): levels in numeric order, values as text
    from pyspark.sql import Window
    y = t.survey.select("year").distinct()
    return y.select(F.col("year").cast("string").alias("level"),
                    F.row_number().over(Window.orderBy("year")).cast("bigint").alias("ord"))


@query("fct_carried", section="2.11", sql="""
WITH lv AS (SELECT level, row_number() OVER (ORDER BY level) AS ord
            FROM (SELECT DISTINCT rincome AS level FROM survey WHERE rincome IS NOT NULL)),
c AS (SELECT rincome AS level, count(*) AS n FROM survey WHERE relig = 'R0' AND age > 60 GROUP BY rincome)
SELECT lv.level AS rincome, CAST(lv.ord AS BIGINT) AS ord, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM lv LEFT JOIN c ON lv.level = c.level
UNION ALL SELECT NULL, NULL, n FROM c WHERE level IS NULL""")
def fct_carried(t):
    # the levels are those of the whole table, and stay with the column through the filter
    kept = leveled.as_factor(t.survey, "rincome").where("relig = 'R0' AND age > 60")
    return leveled.count_levels(kept, "rincome")
