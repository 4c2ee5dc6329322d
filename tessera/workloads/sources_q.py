"""§2.1 sources and sinks, and the flagship pipeline."""

from __future__ import annotations

import math

from pyspark.sql import functions as F, types as T

from tessera.functions.random import hash_normal, hash_normal_sql, hash_uniform, hash_uniform_sql
from tessera.sources.csv import csv_problems, read_csv, scratch_path, stage_csv
from tessera.sources.inline import expand_values
from tessera.workloads import query


@query("flagship", section="2.21", sql="""
SELECT cut, round(avg(log10(price)), 6) AS mean_lprice, round(avg(carat), 6) AS mean_carat
FROM gems WHERE carat < 3 GROUP BY cut""")
def flagship(t):
    # select -> filter -> mutate -> group -> two means -> arrange
    return (t.gems.select("price", "carat", "cut")
            .filter(F.col("carat") < 3)
            .withColumn("lprice", F.log10("price"))
            .groupBy("cut")
            .agg(F.round(F.avg("lprice"), 6).alias("mean_lprice"),
                 F.round(F.avg("carat"), 6).alias("mean_carat"))
            .orderBy(F.desc("mean_lprice")))


@query("scan_parquet", section="2.1", sql="SELECT * FROM orders")
def scan_parquet_q(t):
    return t.orders


@query("read_csv_infer", section="2.1", sql="""
SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, s_name, CAST(CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_nationkey END AS INTEGER) AS s_nationkey,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier""")
def read_csv_infer(t):
    # hand-typed-looking CSV (padded fields, "NA" and empty fields) derived from the supplier table
    s = t.supplier.select("s_suppkey", "s_name", F.when(F.col("s_suppkey") % 7 == 0, "NA").otherwise(F.col("s_nationkey").cast("string")).alias("s_nationkey"),
                          F.when(F.col("s_suppkey") % 5 == 0, "").otherwise(F.col("s_acctbal").cast("string")).alias("s_acctbal"))
    path = stage_csv(s, "supplier", pad=True)
    return read_csv(t.spark, path)


@query("read_csv_problems", section="2.1", sql="""
SELECT 'c_custkey' AS col, 'int' AS expected, 'no. ' || c_custkey AS actual, count(*) AS n FROM customer WHERE c_custkey % 50 = 0 GROUP BY 3
UNION ALL SELECT 'day', 'date', 'soon', count(*) FROM customer WHERE c_custkey % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'digit', 'value in level set', CAST(c_custkey % 10 AS VARCHAR), count(*) FROM customer WHERE c_custkey % 10 > 7 GROUP BY 3""")
def read_csv_problems(t):
    # typed columns: what is neither missing nor of its type is NA and becomes a row of problems
    k = F.col("c_custkey")
    src = t.customer.select(F.when(k % 50 == 0, F.concat(F.lit("no. "), k.cast("string"))).otherwise(k.cast("string")).alias("c_custkey"),
                            F.when(k % 3 == 0, "soon").when(k % 3 == 1, "NA").otherwise("2024-02-29").alias("day"), (k % 10).cast("string").alias("digit"))
    found = csv_problems(t.spark, stage_csv(src, "problems"), "c_custkey int, day date, digit string", levels={"digit": [str(i) for i in range(8)]})
    return found.groupBy("col", "expected", "actual").agg(F.count(F.lit(1)).alias("n"))


@query("read_csv_na", section="2.1", sql="""
SELECT CAST(CASE WHEN c_custkey = 99 THEN NULL ELSE c_custkey END AS INTEGER) AS c_custkey, CAST(CASE WHEN c_nationkey = 9 THEN NULL ELSE c_nationkey END AS INTEGER) AS nation,
       CAST(CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey % 10 END AS INTEGER) AS digit,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE round(c_acctbal, 2) END AS balance FROM customer""")
def read_csv_na(t):
    # the sentinels "99" and "unknown" become NA in every column
    src = t.customer.select("c_custkey", F.when(F.col("c_nationkey") == 9, F.lit(99))
                            .otherwise(F.col("c_nationkey")).alias("nation"),
                            F.when((F.col("c_custkey") % 10) == 0, F.lit(99)).otherwise(F.col("c_custkey") % 10)
                            .alias("digit"),
                            F.when((F.col("c_custkey") % 4) == 0, F.lit("unknown")).otherwise(F.round("c_acctbal", 2).cast("string")).alias("balance"))
    return read_csv(t.spark, stage_csv(src, "na99"), na=["99", "unknown"])


@query("read_csv_factor", section="2.1", sql="""
SELECT strftime(o_orderdate, '%b') AS month, CAST(month(o_orderdate) AS BIGINT) AS month_ord, count(*) AS n FROM orders GROUP BY 1, 2""")
def read_csv_factor(t):
    # month column typed as a factor with 12 fixed levels; other text -> NA
    from tessera.operators.factors import MONTH_ABB, fct_new
    src = t.orders.select(F.date_format("o_orderdate", "MMM").alias("month"), F.col("o_totalprice").alias("value"))
    schema = T.StructType([T.StructField("month", T.StringType()), T.StructField("value", T.DoubleType())])
    df = read_csv(t.spark, stage_csv(src, "months"), schema=schema)
    return fct_new(df, "month", MONTH_ABB).groupBy("month", "month_ord").agg(F.count(F.lit(1)).alias("n"))


@query("inline_table", section="2.1", sql="""
WITH lab(origin, label) AS (VALUES ('1-URGENT', 'urgent'), ('2-HIGH', 'high'), ('5-LOW', 'low'))
SELECT d.origin, lab.label, count(*) AS n FROM deliveries d JOIN lab ON d.origin = lab.origin GROUP BY 1, 2""")
def inline_table(t):
    lab = t.spark.createDataFrame([("1-URGENT", "urgent"), ("2-HIGH", "high"), ("5-LOW", "low")],
                                  "origin string, label string")
    return (t.deliveries.join(F.broadcast(lab), "origin")
            .groupBy("origin", "label").agg(F.count(F.lit(1)).alias("n")))


@query("grid_table", section="2.1", sql="""
SELECT c.cut, g.log_carat FROM (SELECT DISTINCT cut FROM gems) c,
       (VALUES (ln(1.0)), (ln(2.0)), (ln(3.0))) g(log_carat)""")
def grid_table(t):
    # expand.grid(cut = levels seen in data, log_carat = log(1:3)): one explode per axis
    cuts = t.gems.select("cut").distinct()
    return expand_values(cuts, "log_carat", [math.log(1.0), math.log(2.0), math.log(3.0)])


@query("sim_table", section="2.1", sql=f"""
SELECT l_orderkey, l_linenumber, round(x, 6) AS x,
       round(-1.6 + 0.03 * x + 0.1 * {hash_normal_sql(2, 'l_orderkey', 'l_linenumber')}, 6) AS y,
       {hash_uniform_sql(3, 'l_orderkey', 'l_linenumber')} < 0.3 AS coin
FROM (SELECT l_orderkey, l_linenumber, 18 + 42 * {hash_uniform_sql(1, 'l_orderkey', 'l_linenumber')} AS x FROM lineitem)""")
def sim_table(t):
    # x ~ U(18, 60), y = -1.6 + .03 x + N(0, .1), Bernoulli(.3): seeded by row key
    x = 18 + 42 * hash_uniform(1, "l_orderkey", "l_linenumber")
    df = t.lineitem.select("l_orderkey", "l_linenumber", x.alias("x"))
    return df.select(
        "l_orderkey", "l_linenumber", F.round("x", 6).alias("x"),
        F.round(-1.6 + 0.03 * F.col("x") + 0.1 * hash_normal(2, "l_orderkey", "l_linenumber"), 6).alias("y"),
        (hash_uniform(3, "l_orderkey", "l_linenumber") < 0.3).alias("coin"))


@query("write_result", section="2.1", sql="""
SELECT cut, count(*) AS n FROM gems GROUP BY cut""")
def write_result(t):
    # the statistic behind a bar chart, persisted to the shared folder and read back
    stat = t.gems.groupBy("cut").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(t.spark, "stat")
    stat.write.parquet(path)
    return t.spark.read.parquet(path)
