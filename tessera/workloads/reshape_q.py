"""§2.8 reshaping, completion and missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import reshape
from tessera.operators.agg import keep_on_rows
from tessera.operators.joins import membership_flag
from tessera.workloads import query

WIDE_SQL = """SELECT cust, year, max(CASE WHEN qtr = 1 THEN price END) AS q1, max(CASE WHEN qtr = 2 THEN price END) AS q2,
  max(CASE WHEN qtr = 3 THEN price END) AS q3, max(CASE WHEN qtr = 4 THEN price END) AS q4 FROM stocks_q GROUP BY cust, year"""


def _wide(t):
    return reshape.pivot_wider(t.stocks_q, ["cust", "year"], "qtr", "price", [1, 2, 3, 4], prefix="q")


@query("pivot_wider", section="2.8", sql=WIDE_SQL)
def pivot_wider(t):
    return _wide(t)


@query("pivot_longer", section="2.8", sql=f"""
WITH w AS ({WIDE_SQL})
SELECT cust, year, 'q1' AS qtr, q1 AS price FROM w UNION ALL SELECT cust, year, 'q2', q2 FROM w
UNION ALL SELECT cust, year, 'q3', q3 FROM w UNION ALL SELECT cust, year, 'q4', q4 FROM w""")
def pivot_longer(t):
    return reshape.pivot_longer(_wide(t), ["cust", "year"], ["q1", "q2", "q3", "q4"], "qtr", "price")


@query("pivot_roundtrip", section="2.8", sql=f"""
WITH w AS ({WIDE_SQL}), l AS (
SELECT cust, year, 'q1' AS qtr, q1 AS price FROM w UNION ALL SELECT cust, year, 'q2', q2 FROM w
UNION ALL SELECT cust, year, 'q3', q3 FROM w UNION ALL SELECT cust, year, 'q4', q4 FROM w)
SELECT year, qtr, count(*) AS n, count(*) FILTER (WHERE price IS NULL) AS n_missing FROM l GROUP BY year, qtr""")
def pivot_roundtrip(t):
    # wider then longer makes implicit missing cells explicit; count them
    long = reshape.pivot_longer(_wide(t), ["cust", "year"], ["q1", "q2", "q3", "q4"], "qtr", "price")
    return long.groupBy("year", "qtr").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("price").isNull()).alias("n_missing"))


@query("complete_keys", section="2.8", sql="""
WITH f AS (SELECT c.cust, y.year, q.qtr, TRUE AS hit FROM (SELECT DISTINCT cust FROM stocks_q) c
CROSS JOIN (SELECT DISTINCT year FROM stocks_q) y CROSS JOIN (SELECT DISTINCT qtr FROM stocks_q) q)
SELECT CASE WHEN f.hit THEN f.cust ELSE s.cust END AS cust, CASE WHEN f.hit THEN f.year ELSE s.year END AS year,
       CASE WHEN f.hit THEN f.qtr ELSE s.qtr END AS qtr, s.price
FROM f FULL JOIN stocks_q s ON s.cust IS NOT DISTINCT FROM f.cust AND s.year IS NOT DISTINCT FROM f.year
  AND s.qtr IS NOT DISTINCT FROM f.qtr""")
def complete_keys(t):
    s = t.stocks_q
    return reshape.complete(s, "cust", {"year": reshape.domain(s, "year"), "qtr": reshape.domain(s, "qtr")})


@query("complete_range", section="2.8", sql="""
WITH f AS (SELECT c.cust, y.year, q.qtr, TRUE AS hit FROM (SELECT DISTINCT cust FROM stocks_q) c
CROSS JOIN (SELECT * FROM range(1994, 2003) r(year)) y CROSS JOIN (SELECT DISTINCT qtr FROM stocks_q) q)
SELECT CASE WHEN f.hit THEN f.cust ELSE s.cust END AS cust, CASE WHEN f.hit THEN f.year ELSE s.year END AS year,
       CASE WHEN f.hit THEN f.qtr ELSE s.qtr END AS qtr, s.price
FROM f FULL JOIN stocks_q s ON s.cust IS NOT DISTINCT FROM f.cust AND s.year IS NOT DISTINCT FROM f.year
  AND s.qtr IS NOT DISTINCT FROM f.qtr""")
def complete_range(t):
    # complete(year = 1994:2002) adds the years of the range; rows of other years stay
    s = t.stocks_q
    years = F.sequence(F.lit(1994).cast("bigint"), F.lit(2002).cast("bigint"))
    return reshape.complete(s, "cust", {"year": years, "qtr": reshape.domain(s, "qtr")})


@query("complete_levels", section="2.8", sql="""
SELECT l.relig, CAST(coalesce(s.n, 0) AS BIGINT) AS n, s.mean_age FROM (SELECT DISTINCT relig FROM survey) l
LEFT JOIN (SELECT relig, count(*) AS n, round(avg(age), 6) AS mean_age FROM survey
           WHERE partyid = '1-URGENT' AND year = 1995 AND race = 'F' AND age > 80 GROUP BY relig) s ON l.relig = s.relig""")
def complete_levels(t):
    from tessera.operators.agg import count_with_levels
    s = t.survey
    sub = s.filter((F.col("partyid") == "1-URGENT") & (F.col("year") == 1995) & (F.col("race") == "F") & (F.col("age") > 80))
    return count_with_levels(sub, "relig", s.select("relig"), F.round(F.avg("age"), 6).alias("mean_age"))


@query("fill_down", section="2.8", sql="""
SELECT cust, year, qtr, CASE WHEN price IS NULL THEN last_value(price IGNORE NULLS) OVER (PARTITION BY cust ORDER BY year, qtr
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE price END AS price FROM stocks_q""")
def fill_down(t):
    return reshape.fill_down(t.stocks_q, ["cust"], ["year", "qtr"], ["price"])


@query("fill_fixed", section="2.8", sql="SELECT cust, year, qtr, coalesce(price, 0) AS price FROM stocks_q")
def fill_fixed(t):
    return t.stocks_q.withColumn("price", F.coalesce("price", F.lit(0.0)))


@query("na_if", section="2.8", sql="SELECT p_partkey, nullif(p_size, 50) AS p_size FROM part")
def na_if(t):
    return t.part.select("p_partkey", F.nullif(F.col("p_size"), F.lit(50)).alias("p_size"))


@query("drop_incomplete_groups", section="2.8", sql="""
WITH g AS (SELECT dest, day, count(*) AS n, CASE WHEN count(*) > 35 THEN round(avg(dep_delay), 6) END AS mean_delay
           FROM deliveries GROUP BY dest, day)
SELECT dest, day, n, mean_delay FROM g WHERE dest NOT IN (SELECT dest FROM g GROUP BY dest HAVING bool_or(mean_delay IS NULL))""")
def drop_incomplete_groups(t):
    # mutate(any_na = any(is.na(mean)), .by = dest) |> filter(!any_na): small cells have no mean
    g = t.deliveries.groupBy("dest", "day").agg(
        F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) > 35, F.round(F.avg("dep_delay"), 6)).alias("mean_delay"))
    flag = g.groupBy("dest").agg(F.bool_or(F.col("mean_delay").isNull()).alias("any_na"))
    return keep_on_rows(g, ["dest"], flag).filter(~F.col("any_na")).drop("any_na")


@query("missing_vs_key", section="2.8", sql="""
SELECT origin, round(avg(CASE WHEN tailnum IN (SELECT tailnum FROM known_suppliers) THEN 0.0 ELSE 1.0 END), 6) AS share_absent
FROM deliveries GROUP BY origin""")
def missing_vs_key(t):
    d = membership_flag(t.deliveries, "tailnum", t.known_suppliers, "tailnum", "present")
    return d.groupBy("origin").agg(F.round(F.avg((~F.col("present")).cast("double")), 6).alias("share_absent"))
