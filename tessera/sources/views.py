"""Derived views that give the driver tables the shapes the analyses expect.

Each view is a plain projection / join of base tables, so its size grows with
the data and Catalyst can push filters and prune columns through it.  The
same definitions in DuckDB SQL live in ``tessera.sources.view_sql`` and back
the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Part types ordered as the levels of the `cut` factor.
CUT_LEVELS = ["ECONOMY", "SMALL", "MEDIUM", "STANDARD", "LARGE", "PROMO"]
# Event type -> order priority, the join key of `daily_events`.
EVENT_ORIGIN = {
    "click": "1-URGENT",
    "view": "2-HIGH",
    "purchase": "3-MEDIUM",
    "signup": "4-NOT SPECIFIED",
    "error": "5-LOW",
}
# Brands and supplier residue left out of the lookup tables (absent keys).
MISSING_BRANDS = ["Brand#3", "Brand#7"]
SUPPLIER_GAP_MOD = 7


def _level_of(col, levels):
    """1-based position of ``col`` in a fixed level list (NULL if absent)."""
    expr = None
    for i, lv in enumerate(levels, start=1):
        expr = (F.when(col == lv, F.lit(i)) if expr is None else expr.when(col == lv, F.lit(i)))
    return expr


def deliveries(t) -> DataFrame:
    """Flights-shaped view: one row per line item, with delays in days."""
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
    p = t.part.select("p_partkey", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    dd = F.datediff(F.col("l_shipdate"), F.col("o_orderdate")).cast("double")
    dep_missing = ((F.col("l_orderkey") + F.col("l_linenumber")) % 37) == 0
    arr_missing = dep_missing | ((F.col("l_partkey") % 53) == 0)
    sched = ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 24) * 100 + (
        (F.col("l_orderkey") + F.col("l_linenumber") * 11) % 60)
    return j.select(
        F.to_date("o_orderdate").alias("date"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.month("o_orderdate").cast("bigint").alias("month"),
        F.dayofmonth("o_orderdate").cast("bigint").alias("day"),
        "l_orderkey", "l_partkey", "l_suppkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        "l_extendedprice", "l_shipdate",
        F.concat(F.lit("C"), (F.col("l_suppkey") % 16).cast("string")).alias("carrier"),
        F.col("l_orderkey").alias("flight"),
        F.col("o_orderpriority").alias("origin"),
        F.col("p_brand").alias("dest"),
        F.col("l_suppkey").alias("tailnum"),
        sched.cast("bigint").alias("sched_dep_time"),
        F.when(~dep_missing, sched).cast("bigint").alias("dep_time"),
        F.when(~dep_missing, dd).alias("dep_delay"),
        F.when(~arr_missing, dd + F.col("l_linenumber") - 4).alias("arr_delay"),
        F.when(~arr_missing, F.col("l_quantity")).alias("air_time"),
        F.col("l_extendedprice").alias("distance"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(sched / 100).cast("int"))).alias("time_hour"),
    )


def known_brands(t) -> DataFrame:
    """Lookup of destinations (airports-shaped); some brands are left out."""
    return (t.part.select(F.col("p_brand").alias("dest")).distinct()
            .filter(~F.col("dest").isin(MISSING_BRANDS)))


def known_suppliers(t) -> DataFrame:
    """Lookup of tail numbers (planes-shaped); every 7th supplier is left out."""
    return (t.supplier.filter((F.col("s_suppkey") % SUPPLIER_GAP_MOD) != 0)
            .select(F.col("s_suppkey").alias("tailnum")))


def daily_events(t) -> DataFrame:
    """Weather-shaped view: events by (origin, day of month), joinable to deliveries."""
    origin = F.create_map(*[F.lit(x) for kv in EVENT_ORIGIN.items() for x in kv])
    return (t.events
            .groupBy(origin[F.col("event_type")].alias("origin"),
                     F.dayofmonth("ts").cast("bigint").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.avg("value").alias("mean_value"),
                 F.max("value").alias("max_value")))


def gems(t) -> DataFrame:
    """Diamonds-shaped view: lineitem x part with a planted price relation."""
    li = t.lineitem
    p = t.part.select("p_partkey", "p_type", "p_size")
    j = li.join(p, li.l_partkey == p.p_partkey)
    lvl = _level_of(F.col("p_type"), CUT_LEVELS)
    return j.select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        (F.col("l_quantity") / 10).alias("carat"),
        F.col("p_type").alias("cut"),
        F.col("l_returnflag").alias("color"),
        F.col("l_linenumber").cast("bigint").alias("clarity"),
        F.col("p_size").cast("double").alias("x"),
        (F.col("l_discount") * 100).alias("y"),
        (F.col("l_tax") * 100).alias("z"),
        (F.col("l_quantity") * F.col("l_quantity") * (lvl + 10)
         + F.col("l_extendedprice") / 100).alias("price"),
    )


def survey(t) -> DataFrame:
    """Survey-shaped view (gss_cat): orders x customer with factor-like columns."""
    o = t.orders
    c = t.customer
    j = o.join(c, o.o_custkey == c.c_custkey)
    m = F.col("c_custkey") % 100
    r = F.floor((m * m * m) / 130000).cast("bigint")
    relig = F.when(r == 7, F.lit("Other")).otherwise(F.concat(F.lit("R"), r.cast("string")))
    return j.select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.when((F.col("c_custkey") % 41) != 0, F.col("c_custkey") % 70 + 18).alias("age"),
        F.concat(F.lit("M"), (F.col("c_nationkey") % 5).cast("string")).alias("marital"),
        F.col("o_orderstatus").alias("race"),
        F.col("c_mktsegment").alias("rincome"),
        F.col("o_orderpriority").alias("partyid"),
        relig.alias("relig"),
        F.concat(F.lit("D"), (F.col("c_nationkey") % 6).cast("string")).alias("denom"),
        F.col("c_acctbal").alias("tvhours"),
    )


def stocks_q(t) -> DataFrame:
    """Revenue by (customer, year, quarter) with some cells set missing."""
    o = t.orders
    g = (o.groupBy(F.col("o_custkey").alias("cust"),
                   F.year("o_orderdate").cast("bigint").alias("year"),
                   F.quarter("o_orderdate").cast("bigint").alias("qtr"))
         .agg(F.round(F.sum("o_totalprice"), 2).alias("price")))
    hole = ((F.col("cust") + F.col("year") * 4 + F.col("qtr")) % 13) == 0
    return g.withColumn("price", F.when(~hole, F.col("price")))


def doc_quality(t) -> DataFrame:
    """Hotels-shaped view: documents x labels, an imbalanced binary label."""
    d = t.documents.select("doc_id", "lang", "source", "n_chars")
    lab = t.labels
    return d.join(lab, "doc_id").select(
        "doc_id",
        F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("poor")).alias("label"),
        "lang", "source",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.col("toxic").cast("bigint").alias("toxic"),
        F.date_add(F.lit("2017-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).alias("arrival_date"),
    )


def sessions_in(t) -> DataFrame:
    """Event stream for gap-based sessions."""
    return t.events.select("user_id", "ts", "event_id", "event_type", "value")
