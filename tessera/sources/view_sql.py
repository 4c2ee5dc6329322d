"""The derived views in DuckDB SQL, used only by the oracle queries.

Same definitions as ``tessera.sources.views``, written in DuckDB's dialect
(integer date difference, ``//`` only on non-negative operands).
"""

from __future__ import annotations

import re

VIEW_SQL = {
    "deliveries": """
SELECT CAST(o.o_orderdate AS DATE) AS date,
       CAST(year(o.o_orderdate) AS BIGINT) AS year,
       CAST(month(o.o_orderdate) AS BIGINT) AS month,
       CAST(day(o.o_orderdate) AS BIGINT) AS day,
       l.l_orderkey, l.l_partkey, l.l_suppkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber,
       l.l_extendedprice, l.l_shipdate,
       'C' || CAST(l.l_suppkey % 16 AS VARCHAR) AS carrier,
       l.l_orderkey AS flight,
       o.o_orderpriority AS origin,
       p.p_brand AS dest,
       l.l_suppkey AS tailnum,
       CAST(((7 * l.l_orderkey + l.l_partkey) % 24) * 100 + (l.l_orderkey + 11 * l.l_linenumber) % 60 AS BIGINT) AS sched_dep_time,
       CASE WHEN (l.l_orderkey + l.l_linenumber) % 37 <> 0 THEN CAST(((7 * l.l_orderkey + l.l_partkey) % 24) * 100 + (l.l_orderkey + 11 * l.l_linenumber) % 60 AS BIGINT) END AS dep_time,
       CASE WHEN (l.l_orderkey + l.l_linenumber) % 37 <> 0 THEN CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS DOUBLE) END AS dep_delay,
       CASE WHEN (l.l_orderkey + l.l_linenumber) % 37 <> 0 AND l.l_partkey % 53 <> 0
            THEN CAST(CAST(l.l_shipdate AS DATE) - CAST(o.o_orderdate AS DATE) AS DOUBLE) + l.l_linenumber - 4 END AS arr_delay,
       CASE WHEN (l.l_orderkey + l.l_linenumber) % 37 <> 0 AND l.l_partkey % 53 <> 0 THEN l.l_quantity END AS air_time,
       l.l_extendedprice AS distance,
       o.o_orderdate + to_hours(CAST(((7 * l.l_orderkey + l.l_partkey) % 24) AS INTEGER)) AS time_hour
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "known_brands": """
SELECT DISTINCT p_brand AS dest FROM part WHERE p_brand NOT IN ('Brand#3', 'Brand#7')""",
    "known_suppliers": """
SELECT s_suppkey AS tailnum FROM supplier WHERE s_suppkey % 7 <> 0""",
    "daily_events": """
SELECT CASE event_type WHEN 'click' THEN '1-URGENT' WHEN 'view' THEN '2-HIGH' WHEN 'purchase' THEN '3-MEDIUM'
                       WHEN 'signup' THEN '4-NOT SPECIFIED' WHEN 'error' THEN '5-LOW' END AS origin,
       CAST(day(ts) AS BIGINT) AS day,
       count(*) AS n_events, avg(value) AS mean_value, max(value) AS max_value
FROM events GROUP BY 1, 2""",
    "gems": """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber,
       l.l_quantity / 10 AS carat, p.p_type AS cut, l.l_returnflag AS color,
       CAST(l.l_linenumber AS BIGINT) AS clarity, CAST(p.p_size AS DOUBLE) AS x,
       l.l_discount * 100 AS y, l.l_tax * 100 AS z,
       l.l_quantity * l.l_quantity * (10 + CASE p.p_type WHEN 'ECONOMY' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'MEDIUM' THEN 3
            WHEN 'STANDARD' THEN 4 WHEN 'LARGE' THEN 5 WHEN 'PROMO' THEN 6 END) + l.l_extendedprice / 100 AS price
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "survey": """
SELECT o.o_orderkey AS id, CAST(year(o.o_orderdate) AS BIGINT) AS year,
       CASE WHEN c.c_custkey % 41 <> 0 THEN c.c_custkey % 70 + 18 END AS age,
       'M' || CAST(c.c_nationkey % 5 AS VARCHAR) AS marital,
       o.o_orderstatus AS race, c.c_mktsegment AS rincome, o.o_orderpriority AS partyid,
       CASE WHEN (c.c_custkey % 100) * (c.c_custkey % 100) * (c.c_custkey % 100) // 130000 = 7 THEN 'Other'
            ELSE 'R' || CAST((c.c_custkey % 100) * (c.c_custkey % 100) * (c.c_custkey % 100) // 130000 AS VARCHAR) END AS relig,
       'D' || CAST(c.c_nationkey % 6 AS VARCHAR) AS denom,
       c.c_acctbal AS tvhours
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "stocks_q": """
SELECT cust, year, qtr, CASE WHEN (cust + year * 4 + qtr) % 13 <> 0 THEN price END AS price FROM (
  SELECT o_custkey AS cust, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(quarter(o_orderdate) AS BIGINT) AS qtr,
         round(sum(o_totalprice), 2) AS price
  FROM orders GROUP BY 1, 2, 3)""",
    "doc_quality": """
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'good' ELSE 'poor' END AS label, d.lang, d.source,
       CAST(d.n_chars AS DOUBLE) AS n_chars, CAST(l.toxic AS BIGINT) AS toxic,
       CAST(DATE '2017-01-01' + CAST(d.doc_id % 365 AS INTEGER) AS DATE) AS arrival_date
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "sessions_in": """
SELECT user_id, ts, event_id, event_type, value FROM events""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every derived view it mentions."""
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEW_SQL[v]}\n)" for v in used)
    body = sql.lstrip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"
