"""§2.14 table profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import profile
from tessera.workloads import query


@query("glimpse", section="2.14")
def glimpse(t):
    return profile.glimpse(t.deliveries)


def _r(df, keep):
    return df.select(*[F.round(c, 6).alias(c) if c not in keep else F.col(c) for c in df.columns])


SKIM_NUM = ["doc_id", "n_chars", "toxic"]
SKIM_CHR = ["label", "lang", "source"]
SKIM_COLS = ["skim_type", "skim_variable", "n_missing", "complete_rate", "mean", "sd", "p0", "p25", "p50", "p75", "p100", "hist",
             "min_len", "max_len", "empty", "n_unique", "whitespace", "top_counts", "date_min", "date_median", "date_max"]


def _skim_sql(kind: str, c: str) -> str:
    """One row of the profile; the columns that do not apply are NULL."""
    v = {k: "NULL::DOUBLE" for k in ("mean", "sd", "p0", "p25", "p50", "p75", "p100")}
    v |= {k: "NULL::BIGINT" for k in ("min_len", "max_len", "empty", "n_unique", "whitespace")}
    v |= {k: "NULL::VARCHAR" for k in ("hist", "top_counts", "date_min", "date_median", "date_max")}
    v |= {"skim_type": f"'{kind}'", "skim_variable": f"'{c}'", "n_missing": f"count(*) FILTER (WHERE {c} IS NULL)",
          "complete_rate": f"round(count({c}) / count(*), 6)"}
    if kind == "numeric":
        v |= {"mean": f"round(avg({c}), 6)", "sd": f"round(stddev_samp({c}), 6)", "p0": f"round(CAST(min({c}) AS DOUBLE), 6)",
              "p100": f"round(CAST(max({c}) AS DOUBLE), 6)"}
        v |= {f"p{p}": f"round(quantile_cont(CAST({c} AS DOUBLE), 0.{p}), 6)" for p in (25, 50, 75)}
        v["hist"] = f"""(SELECT string_agg(CAST(coalesce(h.n, 0) AS VARCHAR), ',' ORDER BY r.k) FROM range(5) r(k) LEFT JOIN (
          SELECT CAST(CASE WHEN hi > lo THEN least(floor((x - lo) / ((hi - lo) / 5)), 4) ELSE 0 END AS BIGINT) AS k, count(*) AS n
          FROM (SELECT CAST({c} AS DOUBLE) AS x FROM doc_quality WHERE {c} IS NOT NULL),
               (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM doc_quality) GROUP BY 1) h ON r.k = h.k)"""
    elif kind == "character":
        v |= {"min_len": f"CAST(min(length({c})) AS BIGINT)", "max_len": f"CAST(max(length({c})) AS BIGINT)",
              "empty": f"count(*) FILTER (WHERE {c} = '')", "n_unique": f"count(DISTINCT {c})",
              "whitespace": f"count(*) FILTER (WHERE regexp_matches({c}, '^\\s+$'))"}
        v["top_counts"] = f"""(SELECT string_agg({c} || ': ' || CAST(n AS VARCHAR), ', ' ORDER BY n DESC, {c}) FROM (
          SELECT {c}, count(*) AS n FROM doc_quality WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 4))"""
    else:
        v |= {"date_min": f"CAST(min({c}) AS VARCHAR)", "date_max": f"CAST(max({c}) AS VARCHAR)", "n_unique": f"count(DISTINCT {c})",
              "date_median": f"CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(CAST({c} - DATE '1970-01-01' AS DOUBLE), 0.5)) AS INTEGER) AS VARCHAR)"}
    return "SELECT " + ", ".join(f"{v[k]} AS {k}" for k in SKIM_COLS) + " FROM doc_quality"


@query("skim", section="2.14", sql=" UNION ALL ".join(
    [_skim_sql("numeric", c) for c in SKIM_NUM] + [_skim_sql("character", c) for c in SKIM_CHR] + [_skim_sql("Date", "arrival_date")]))
def skim(t):
    s = profile.skim(t.doc_quality.select(*SKIM_NUM, *SKIM_CHR, "arrival_date"))
    rounded = {"complete_rate", "mean", "sd", "p0", "p25", "p50", "p75", "p100"}
    return _r(s.select(*SKIM_COLS), set(SKIM_COLS) - rounded)


@query("summary_cols", section="2.14", sql=" UNION ALL ".join(
    f"""SELECT '{c}' AS variable, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q1,
  round(quantile_cont({c}, 0.5), 6) AS median, round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.75), 6) AS q3,
  round(max({c}), 6) AS max FROM gems""" for c in ["x", "y", "z"]))
def summary_cols(t):
    return _r(profile.summary_cols(t.gems, ["x", "y", "z"]), {"variable"})


@query("zero_check", section="2.14", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, x, y, z FROM gems WHERE x = 0 OR y = 0 OR z = 0""")
def zero_check(t):
    g = t.gems
    return g.filter((F.col("x") == 0) | (F.col("y") == 0) | (F.col("z") == 0)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "x", "y", "z")
