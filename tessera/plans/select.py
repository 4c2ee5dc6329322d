"""Exact order statistics without ordering the rows: sketch, then select.

A median or a letter value is one value at a known position.  Sorting all rows to
find it shuffles them; a sketch tells, for kilobytes, between which values it must
lie:

1. One pass makes a KLL sketch of every group (merged before the shuffle).  From
   its quantiles every wanted position gets a bracket of values, wide enough for
   four times the sketch's error at 99 %.
2. One pass counts the rows: each value inside a bracket by itself, everything
   between two brackets as one number.  Running sums over these few rows give the
   exact position of each value in a bracket.  Groups of at most ``SMALL`` rows
   have no bracket; all their values count.
3. Where a bracket may still hold more than ``LIMIT`` rows, it is sketched in turn
   before step 2; every such pass makes it about fifty times smaller.  The values at
   its two ends are counted apart: common values, which no sketch splits, end up
   there, so the rest shrinks whatever the ties.

Rows are never shuffled, sorted or stored, and one hot group costs what many small
ones do.  A position that falls outside its bracket is found out by the counts and
raises; at ten standard deviations that is no event to plan for.

Brackets are fixed before step 2 reads them (a sketch that is taken anew after a
loss differs): up to ``FEW`` groups as a local table that is broadcast, more of
them as a stored table that the planner joins.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tessera.session import ensure_checkpoint_dir

SKETCH = 2048
GRID = 400
#: on either side of a position, as a share of the group: four times the error of a sketch at 99 %, and a step of the grid
MARGIN = 4 * 2.296 / SKETCH ** 0.9021 + 1 / GRID
SMALL = 4096
LIMIT = 100_000
FEW = 10_000
#: more brackets than this are compared in an array, fewer in generated code
UNROLL = 24


def few_rows(df: DataFrame, most: int = FEW) -> list | None:
    """The rows if there are at most ``most`` of them, else nothing."""
    rows = df.limit(most + 1).collect()
    return rows if len(rows) <= most else None


def _local(df: DataFrame, rows: list) -> DataFrame:
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def settled(df: DataFrame, most: int = FEW) -> DataFrame:
    """The result of an aggregation for a join with rows: computed and broadcast if it has few rows, else left to the planner."""
    rows = few_rows(df, most)
    return df if rows is None else _local(df, rows)


def _fixed(df: DataFrame, most: int) -> tuple[DataFrame, int, int]:
    """Brackets that no longer change, rows in the fullest one (-1: no brackets), and the most brackets of a group."""
    rows = few_rows(df, most)
    if rows is not None:
        return _local(df, rows), max((r["widest"] for r in rows), default=-1), max((len(r["los"]) for r in rows), default=0)
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    return df, *df.agg(F.max("widest"), F.max(F.size("los"))).first()


def _known(df: DataFrame, x: str) -> Column:
    """The value, NA for NaN."""
    return F.when(~F.isnan(x), F.col(x)) if isinstance(df.schema[x].dataType, (T.DoubleType, T.FloatType)) else F.col(x)


def _quantiles(sketch: str) -> Column:
    steps = ",".join(str(i / GRID) for i in range(GRID + 1))
    return F.kll_sketch_get_quantile_double(sketch, F.split(F.lit(steps), ",").cast("array<double>"))


def _brackets(cells: DataFrame, keys: list[str], wanted: Callable[[Column], Column], limit: int) -> DataFrame:
    """From counted and sketched cells (``lo``, ``hi``, ``cnt``, ``grid``; after the first pass ``c``, ``gap``, ``edge``) the next brackets of each group.

    ``keys, los, his, widest``: bounds in rising order, and the rows that the fullest bracket may hold.
    """
    if "c" in cells.columns:
        w = Window.partitionBy(*keys)
        t = cells.withColumn("below", F.sum("cnt").over(w.orderBy("c", "gap", "edge")) - F.col("cnt")).withColumn("total", F.sum("cnt").over(w))
    else:  # one cell a group
        t = cells.withColumns({"below": F.lit(0), "total": F.col("cnt"), "gap": F.lit(0), "edge": F.lit(0)})
    here = F.filter(wanted(F.col("total")), lambda p: (p > F.col("below")) & (p <= F.col("below") + F.col("cnt")))
    share = (F.col("cnt") * F.lit(2 * MARGIN)).cast("bigint") + 1
    narrow = (F.col("cnt") > F.lit(limit)) & (F.col("edge") == 0)  # an end of a bracket is a single value

    def bracket(p: Column) -> Column:
        low = F.greatest(F.floor(((p - 1 - F.col("below")) / F.col("cnt") - MARGIN) * GRID), F.lit(0))
        high = F.least(F.ceil(((p - F.col("below")) / F.col("cnt") + MARGIN) * GRID), F.lit(GRID))
        return F.struct(F.when(narrow, F.get("grid", low)).otherwise(F.col("lo")).alias("lo"),
                        F.when(narrow, F.get("grid", high)).otherwise(F.col("hi")).alias("hi"))

    missed = F.raise_error(F.lit("an order statistic lies outside its bracket; run again or widen MARGIN"))
    t = t.withColumn("ps", here).withColumn("ps", F.when((F.col("gap") == 1) & (F.size("ps") > 0), missed.cast("array<bigint>")).otherwise(F.col("ps")))
    t = t.where(F.size("ps") > 0).select(*keys, F.array_distinct(F.transform("ps", bracket)).alias("b"), F.when(narrow, share).otherwise(0).alias("share"))
    g = t.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("b"))).alias("b"), F.max("share").alias("widest"))
    return g.where(F.col("widest").isNotNull()).select(*keys, F.col("b.lo").alias("los"), F.col("b.hi").alias("his"), "widest")


def _placed(d: DataFrame, brackets: DataFrame, keys: list[str], most: int) -> DataFrame:
    """Each row with its cell: ``c`` brackets begin at or below its value, ``gap`` is 1 beyond the last of them."""
    b = brackets.select(*[F.col(k).alias(f"_r{k}") for k in keys], "los", "his")
    on = F.lit(True)
    for k in keys:
        on = on & d[k].eqNullSafe(b[f"_r{k}"])
    j = (d.join(b, on, "left") if keys else d.crossJoin(b)).drop(*[f"_r{k}" for k in keys])  # without keys: one row
    x = F.col("_d")
    if most <= UNROLL:
        c = sum((F.coalesce((F.get("los", i) <= x).cast("int"), F.lit(0)) for i in range(most)), F.lit(0))
    else:
        c = F.size(F.filter("los", lambda v: v <= x))
    j = j.withColumn("c", F.when(F.col("los").isNull(), 1).otherwise(c))
    gap = F.when(F.col("los").isNull(), 0).when(F.col("c") == 0, 1).otherwise((x > F.get("his", F.col("c") - 1)).cast("int"))
    return j.withColumn("gap", gap)


def thin_scan(df: DataFrame, by: Sequence[str], x: str, wanted: Callable[[Column], Column], *, small: int = SMALL, limit: int = LIMIT,
              few: int = FEW) -> DataFrame:
    """Counts along the distinct values of ``x`` in each group, exact at the wanted positions: ``by..., x, _n, _cum, _total``.

    ``wanted(n)`` is an array of positions (1 to n) in a group of n values that are not NA.  ``_n`` rows have the value, ``_cum`` have it
    or a smaller one, ``_total`` have any.  Values between brackets are one row without a value.  A group whose values are all NA has
    one row with NA in ``x``, ``_n`` and ``_cum`` and 0 in ``_total``.  Equal to ``value_scan`` wherever a wanted position is.
    """
    by = list(by)
    keys = [f"_k{i}" for i in range(len(by))]
    d = df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], _known(df, x).alias("_x"))
    d = d.withColumn("_d", F.col("_x").cast("double"))
    sketched = d.where(F.col("_d").isNotNull()).groupBy(*keys).agg(F.count("_d").alias("cnt"), F.kll_sketch_agg_double("_d", F.lit(SKETCH)).alias("_sk"))
    cells = sketched.where(F.col("cnt") > small).select(
        *keys, "cnt", F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), _quantiles("_sk").alias("grid"))
    brackets, widest, most = _fixed(_brackets(cells, keys, wanted, small), few)
    while widest > limit:
        placed = _placed(d.where(F.col("_d").isNotNull()), brackets, keys, most).where(F.col("los").isNotNull())
        lo, hi = F.get("los", F.col("c") - 1), F.get("his", F.col("c") - 1)
        edge = F.when(F.col("gap") == 1, 0).when(F.col("_d") == lo, -1).when(F.col("_d") == hi, 1).otherwise(0)
        placed = placed.withColumn("edge", edge)
        between = (F.col("gap") == 0) & (F.col("edge") == 0)
        counted = placed.groupBy(*keys, "c", "gap", "edge").agg(
            F.count(F.lit(1)).alias("cnt"), F.kll_sketch_agg_double(F.when(between, F.col("_d")), F.lit(SKETCH)).alias("_sk"),
            F.first(F.when(F.col("edge") > 0, hi).otherwise(lo)).alias("lo"), F.first(F.when(F.col("edge") < 0, lo).otherwise(hi)).alias("hi"))
        cells = counted.select(*keys, "c", "gap", "edge", "cnt", "lo", "hi", F.when(between, _quantiles("_sk")).alias("grid"))
        brackets, widest, most = _fixed(_brackets(cells, keys, wanted, limit), few)
    if widest >= 0:
        placed = _placed(d, brackets, keys, most)
    else:
        placed = d.withColumn("c", F.lit(1)).withColumn("gap", F.lit(0))
    na = F.col("_x").isNull()
    rows = placed.groupBy(*keys, na.alias("na"), F.when(~na, F.col("c")).alias("c"), F.when(~na, F.col("gap")).alias("gap"),
                          F.when(F.col("gap") == 0, F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    # at most a few brackets' values a group
    w = Window.partitionBy(*keys)
    n = F.when(~F.col("na"), F.col("_n"))
    out = rows.select(*keys, "na", "gap", "_x", n.alias("_n"), F.sum(n).over(w.orderBy("na", "c", "gap", "_x")).alias("_cum"),
                      F.coalesce(F.sum(n).over(w), F.lit(0)).alias("_total"))
    hit = F.exists(wanted(F.col("_total")), lambda p: (p > F.col("_cum") - F.col("_n")) & (p <= F.col("_cum")))
    missed = F.raise_error(F.lit("an order statistic lies outside its bracket; run again or widen MARGIN"))
    value = F.when((F.col("gap") == 1) & hit, missed.cast(d.schema["_x"].dataType)).otherwise(F.col("_x"))
    out = out.where(~F.col("na") | (F.col("_total") == 0))
    return out.select(*[F.col(k).alias(b) for k, b in zip(keys, by)], value.alias(x), "_n", F.when(~F.col("na"), F.col("_cum")).alias("_cum"), "_total")


def quantile_positions(probs: Sequence[float]) -> Callable[[Column], Column]:
    """The two order statistics that a type-7 quantile lies between, for every probability."""
    def wanted(n: Column) -> Column:
        at = []
        for p in probs:
            h = F.floor((n - 1) * F.lit(float(p)) + 1)
            at += [h, F.least(h + 1, n)]
        return F.array_distinct(F.array(*at).cast("array<bigint>"))
    return wanted
