"""Ordered computations that never hold a whole group in one task.

A ``row_number``, running sum, lag or exact quantile written as a window would
put every row of a group into one task: a key that holds a third of the data
would make one task read a third of the data.  :func:`scan` does it in one
range shuffle:

1. Rows are range-partitioned on ``(group..., order..., tie-break)`` and sorted,
   so a hot group, and a hot run of equal values, spreads over partitions.
2. One Arrow pass over each sorted partition computes positions, running sums,
   offsets and last-seen values inside the partition, in bounded batches.
3. The rows are checkpointed to the shared checkpoint folder: that fixes the
   partitions for what follows and cuts the lineage.
4. Only a partition's *first* group can have rows in earlier partitions.  So
   what each partition must add to it is one row per partition (``n`` rows for an
   offset by ``n``); these are combined in partition order and broadcast, bounded
   by the number of partitions.

Ranks come from the same pass: a row's position less its place in its run of equal
values.  Tables of distinct values with their counts are scanned by
:func:`value_scan`.  Quantiles are selected
between the brackets of a sketch (``tessera.plans.select``).
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessera.plans.select import quantile_positions, thin_scan
from tessera.session import ensure_checkpoint_dir

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
#: rows of columnar files take about this many times their size in a shuffle
EXPANSION = 4


def n_partitions(df: DataFrame) -> int:
    """Range partitions for ``df``: by the bytes of the files below it, at least the shuffle setting.

    AQE does not resize an explicit ``repartitionByRange(n)``.  Sizes come from the
    plan's file listing; a leaf without files (checkpointed rows) counts by its
    partitions.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size, parts = 0, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind == "LogicalRelation":
            size += int(str(leaf.stats().sizeInBytes()))
        elif kind == "LogicalRDD":
            parts = max(parts, leaf.rdd().getNumPartitions())
    return max(parts, -(-EXPANSION * size // TARGET_PARTITION_BYTES))


def _order_cols(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]


def _pass(by, sums, lags, fills, names, ties=()):
    """The pass over one partition; all it needs is inside, so that it travels to executors by value."""
    def differs(before, col) -> np.ndarray:
        """Where a key is not that of the row before; NA equals NA and NaN equals NaN, as in a grouping."""
        kind = col.type
        both = pa.concat_arrays([before, col])
        n = len(col)
        if pa.types.is_nested(kind):
            v = both.to_pylist()
            return np.array([v[i] != v[i + 1] for i in range(n)], bool)
        if pa.types.is_dictionary(kind):
            both = both.dictionary_decode()
        a, b = both.slice(0, n), both.slice(1, n)
        out = pc.not_equal(a, b)
        if pa.types.is_floating(kind):
            out = pc.and_(out, pc.invert(pc.and_(pc.is_nan(a), pc.is_nan(b))))
        return pc.if_else(pc.and_(a.is_valid(), b.is_valid()), out, pc.xor(a.is_valid(), b.is_valid())).to_numpy(zero_copy_only=False)

    class _Local:
        """The state of one partition's pass: what the next batch needs from those before."""

        def __init__(self, sums, lags, fills):
            self.sums, self.lags, self.fills = sums, lags, fills
            self.back = max([n for _, n, _ in lags if n > 0], default=0)
            self.ahead = max([-n for _, n, _ in lags if n < 0], default=0)
            self.at = 0  # rows of the partition before the batch
            self.keys = None  # key values of the last row seen
            self.groups = 0  # groups that have begun before the batch, less one
            self.pos = 0
            self.tie_keys, self.runs, self.tie_pos = None, 0, 0  # the same for runs of equal ordered values
            self.total = [0 for _ in sums]
            self.nulls = [0 for _ in sums]
            self.seen = [None for _ in fills]

        def columns(self, t: pa.RecordBatch) -> list[pa.Array]:
            """Index, number of the group in the partition, position, sums with null counts, last-seen values."""
            n = t.num_rows
            keys = [t.column(c) for c in by]
            new = np.zeros(n, bool)
            for k, col in enumerate(keys):
                new |= differs(self.keys[k] if self.keys else col.slice(0, 1), col)
            g = self.groups + np.cumsum(new)
            i = np.arange(n)
            if ties:
                values = [t.column(c) for c in ties]
                turn = new.copy()
                for k, col in enumerate(values):
                    turn |= differs(self.tie_keys[k] if self.tie_keys else col.slice(0, 1), col)
                run = self.runs + np.cumsum(turn)
                turn[0] |= self.at == 0
                begin = np.maximum.accumulate(np.where(turn, i, -1))
                in_run = np.where(begin >= 0, i - begin + 1, self.tie_pos + i + 1)
                self.tie_keys, self.runs, self.tie_pos = [col.slice(n - 1, 1) for col in values], int(run[-1]), int(in_run[-1])
            new[0] |= self.at == 0
            start = np.maximum.accumulate(np.where(new, i, -1))  # -1: the group began before
            pos = np.where(start >= 0, i - start + 1, self.pos + i + 1)
            out = [pa.array(self.at + i), pa.array(g.astype(np.int64)), pa.array(pos)]
            if ties:
                out += [pa.array(run.astype(np.int64)), pa.array(in_run)]
            for k, (col, _) in enumerate(self.sums):
                v = t.column(col)
                null = v.is_null().to_numpy(zero_copy_only=False)
                v = pc.fill_null(v, 0).to_numpy()
                for values, kept in ((v, self.total), (null.astype(np.int64), self.nulls)):
                    c = np.cumsum(values)
                    base = np.where(start > 0, c[np.maximum(start, 1) - 1], 0)
                    r = np.where(start >= 0, c - base, c + kept[k])
                    kept[k] = r[-1]
                    out.append(pa.array(r))
            for k, (col, _) in enumerate(self.fills):
                v = t.column(col)
                last = np.maximum.accumulate(np.where(v.is_valid().to_numpy(zero_copy_only=False), i, -1))
                own = last >= np.maximum(start, 0)
                old = self.seen[k] if self.seen[k] is not None else pa.nulls(1, v.type)
                both = pa.concat_arrays([old, v])
                take = np.where(own, last + 1, np.where(start < 0, 0, -1))
                got = both.take(pa.array(np.maximum(take, 0), mask=take < 0))
                self.seen[k] = got.slice(n - 1, 1)
                out.append(got)
            self.at, self.groups, self.pos = self.at + n, int(g[-1]), int(pos[-1])
            self.keys = [col.slice(n - 1, 1) for col in keys]
            return out

        def offsets(self, t: pa.RecordBatch, lo: int, hi: int) -> list[pa.Array]:
            """Values ``n`` rows back (ahead, where negative) of rows lo..hi; null outside the batch or the group."""
            g = t.column("_gid").to_numpy()
            i = np.arange(lo, hi)
            out = []
            for col, n, _ in self.lags:
                j = i - n
                ok = (j >= 0) & (j < len(g))
                ok[ok] = g[j[ok]] == g[i[ok]]
                out.append(t.column(col).take(pa.array(np.where(ok, j, 0), mask=~ok)) if len(g) else t.column(col))
            return out

    def run(batches):
        s = _Local(sums, lags, fills)
        held = None  # rows before the next ones to emit (context), then rows not emitted yet
        done = 0  # how many of the held rows are context
        for b in batches:
            if not b.num_rows:
                continue
            b = pa.RecordBatch.from_arrays([*b.columns, *s.columns(b)], [*b.schema.names, *names])
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            hi = max(done, b.num_rows - s.ahead)
            if hi > done:
                out = b.slice(done, hi - done)
                yield pa.RecordBatch.from_arrays([*out.columns, *s.offsets(b, done, hi)], [*b.schema.names, *[x for *_, x in lags]])
            keep = max(0, hi - s.back)
            held, done = b.slice(keep), hi - keep
        if held is not None and held.num_rows > done:
            out = held.slice(done)
            yield pa.RecordBatch.from_arrays([*out.columns, *s.offsets(held, done, held.num_rows)],
                                             [*held.schema.names, *[x for *_, x in lags]])

    return run


def scan(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], *, pos: str | None = None, rank: tuple[str, Sequence[str]] | None = None,
         sums: Sequence[tuple[str, str]] = (), lags: Sequence[tuple[str, int, str]] = (),
         fills: Sequence[tuple[str, str]] = (), num_partitions: int | None = None) -> DataFrame:
    """Add, along ``order`` inside each group of ``by``:

    * ``pos``: the row's number from 1;
    * ``rank`` ``(name, columns)``: the number of the first row with the same values of the ordering columns;
    * ``sums`` ``(column, name)``: the running sum, NA from the first NA on;
    * ``lags`` ``(column, n, name)``: the value ``n`` rows before (after, if negative);
    * ``fills`` ``(column, name)``: the last value that is not NA, up to this row.

    Rows that ``order`` does not tell apart come in any order.
    """
    ensure_checkpoint_dir(df.sparkSession)
    spark = df.sparkSession
    # sums: whole numbers and decimals exactly, as long; anything else as double
    prep, undo, plan = df, {}, []
    for k, (col, name) in enumerate(sums):
        kind = df.schema[col].dataType
        if isinstance(kind, T.DecimalType):
            prep = prep.withColumn(f"_v{k}", (F.col(col) * F.lit(10 ** kind.scale)).cast("bigint"))
            undo[name] = lambda c, kind=kind: (c / F.lit(10 ** kind.scale)).cast(T.DecimalType(38, kind.scale))
        elif isinstance(kind, T.IntegralType):
            prep = prep.withColumn(f"_v{k}", F.col(col).cast("bigint"))
        else:
            prep = prep.withColumn(f"_v{k}", F.col(col).cast("double"))
        plan.append((f"_v{k}", name))
    prep = prep.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(b).asc_nulls_last() for b in by] + _order_cols(order) + [F.col("_tie")]
    rows = prep.repartitionByRange(num_partitions or n_partitions(df), *keys).sortWithinPartitions(*keys).drop("_tie")

    ties = list(rank[1]) if rank else []
    extra = [("_rid", T.LongType()), ("_gid", T.LongType()), ("_pos", T.LongType())]
    extra += [("_run", T.LongType()), ("_in_run", T.LongType())] if rank else []
    for k, (col, _) in enumerate(plan):
        extra += [(f"_s{k}", prep.schema[col].dataType), (f"_z{k}", T.LongType())]
    extra += [(f"_f{k}", df.schema[col].dataType) for k, (col, _) in enumerate(fills)]
    offset = [(f"_l{k}", df.schema[col].dataType) for k, (col, *_) in enumerate(lags)]
    inner = [(col, n, f"_l{k}") for k, (col, n, _) in enumerate(lags)]
    schema = T.StructType([*rows.schema.fields, *[T.StructField(a, b) for a, b in extra + offset]])
    local = rows.mapInArrow(_pass(list(by), plan, inner, fills, [a for a, _ in extra], ties), schema)
    local = local.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)

    out = _add_carries(local, by, plan, fills) if pos or rank or sums or fills else local
    if rank:
        out = _add_run_carries(local, out, [*by, *ties])
    if lags:
        out = _add_offsets(local, out, by, inner)
    new = [F.col("_pos").alias(pos)] if pos else []
    new += [(F.col("_pos") - F.col("_in_run") + 1).alias(rank[0])] if rank else []
    for k, (_, name) in enumerate(sums):
        value = F.when(F.col(f"_z{k}") == 0, F.col(f"_s{k}"))
        new.append((undo[name](value) if name in undo else value).alias(name))
    new += [F.col(f"_l{k}").alias(name) for k, (*_, name) in enumerate(lags)]
    new += [F.col(f"_f{k}").alias(name) for k, (_, name) in enumerate(fills)]
    made = {*([pos] if pos else []), *([rank[0]] if rank else []), *[x[-1] for x in (*sums, *lags, *fills)]}
    return out.select(*[c for c in df.columns if c not in made], *new)


def _key(by) -> Column:
    return F.struct(F.lit(0).alias("_none"), *by).alias("_key")


def _values(key) -> tuple:
    """The key of a group, comparable by value: NaN equals NaN."""
    return tuple("NaN" if isinstance(v, float) and v != v else v for v in key)


def _add_carries(local: DataFrame, by, sums, fills) -> DataFrame:
    """Add to each partition's first group what it has in earlier partitions (one row per partition)."""
    names = ["_pos", *[f"_s{k}" for k in range(len(sums))], *[f"_z{k}" for k in range(len(sums))],
             *[f"_f{k}" for k in range(len(fills))]]
    ends = (local.groupBy("_pid").agg(F.min_by(_key(by), "_rid").alias("first"), F.max_by(F.struct(_key(by), "_gid", *names), "_rid").alias("last"))
            .orderBy("_pid").collect())
    n_add = 1 + 2 * len(sums)
    carry, group, held = [], None, None
    for r in ends:
        end, number, *last = r["last"]
        if group is not None and _values(r["first"]) == group:
            carry.append((r["_pid"], *held))
            if number == 0:  # the whole partition is this group: the carry goes on
                last[:n_add] = [a + b for a, b in zip(last[:n_add], held[:n_add])]
                last[n_add:] = [a if a is not None else b for a, b in zip(last[n_add:], held[n_add:])]
        group, held = _values(end), last
    if not carry:
        return local
    fields = [T.StructField("_cp", T.IntegerType())] + [T.StructField("_c" + c, local.schema[c].dataType) for c in names]
    table = F.broadcast(local.sparkSession.createDataFrame(carry, T.StructType(fields)))
    out = local.join(table, (local["_pid"] == table["_cp"]) & (local["_gid"] == 0), "left")
    values = {c: F.col(c) + F.coalesce(F.col("_c" + c), F.lit(0)) for c in names[:n_add]}
    values |= {c: F.coalesce(c, "_c" + c) for c in names[n_add:]}
    return out.withColumns(values).drop("_cp", *["_c" + c for c in names])


def _add_run_carries(local: DataFrame, out: DataFrame, keys) -> DataFrame:
    """Add to each partition's first run of equal values what the run has in earlier partitions (one row per partition)."""
    ends = (local.groupBy("_pid").agg(F.min_by(_key(keys), "_rid").alias("first"), F.max_by(F.struct(_key(keys), "_run", "_in_run"), "_rid").alias("last"))
            .orderBy("_pid").collect())
    carry, before, held = [], None, 0
    for r in ends:
        end, run, size = r["last"]
        goes_on = before is not None and _values(r["first"]) == before
        if goes_on:
            carry.append((r["_pid"], held))
        held = size + (held if goes_on and run == 0 else 0)
        before = _values(end)
    if not carry:
        return out
    table = F.broadcast(local.sparkSession.createDataFrame(carry, "_rp int, _rc bigint"))
    joined = out.join(table, (out["_pid"] == table["_rp"]) & (out["_run"] == 0), "left")
    return joined.withColumn("_in_run", F.col("_in_run") + F.coalesce("_rc", F.lit(0))).drop("_rp", "_rc")


def _add_offsets(local: DataFrame, out: DataFrame, by, lags) -> DataFrame:
    """Fill offsets that reach into neighbouring partitions (n rows at each end of a partition)."""
    most = max(abs(n) for _, n, _ in lags)
    size = F.broadcast(local.groupBy("_pid").agg(F.count("*").alias("_size")).withColumnRenamed("_pid", "_sp"))
    cols = list(dict.fromkeys(c for c, *_ in lags))
    edge = (local.join(size, local["_pid"] == F.col("_sp"))
            .where((F.col("_rid") < most) | (F.col("_rid") >= F.col("_size") - most))
            .select("_pid", "_rid", _key(by), "_size", *[F.col(c).alias(f"_v{k}") for k, c in enumerate(cols)]).orderBy("_pid", "_rid").collect())
    # edges in order; between the two edges of a larger partition lie rows that no offset across can reach
    line: list = []
    for k, r in enumerate(edge):
        if line and r["_pid"] == edge[k - 1]["_pid"] and r["_rid"] != edge[k - 1]["_rid"] + 1:
            line += [None] * most
        line.append(r)
    found = []
    for i, r in enumerate(line):
        if r is None:
            continue
        values = []
        for col, n, _ in lags:
            j = i - n
            other = line[j] if 0 <= j < len(line) else None
            near = other is not None and other["_pid"] != r["_pid"] and _values(other["_key"]) == _values(r["_key"])
            values.append(other[f"_v{cols.index(col)}"] if near else None)
        if any(v is not None for v in values):
            found.append((r["_pid"], r["_rid"], *values))
    if not found:
        return out
    fields = [T.StructField("_ep", T.IntegerType()), T.StructField("_er", T.LongType())]
    fields += [T.StructField("_e" + name, local.schema[col].dataType) for col, _, name in lags]
    table = F.broadcast(local.sparkSession.createDataFrame(found, T.StructType(fields)))
    joined = out.join(table, (out["_pid"] == table["_ep"]) & (out["_rid"] == table["_er"]), "left")
    return joined.withColumns({name: F.coalesce(name, "_e" + name) for *_, name in lags}).drop("_ep", "_er", *["_e" + x for *_, x in lags])


def group_positions(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
                    name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` within each group along ``order``, without a per-group task."""
    return scan(df, by, order, pos=name, num_partitions=num_partitions)


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], value: str,
                name: str = "cum", num_partitions: int | None = None) -> DataFrame:
    """``cumsum(value)`` within each group along ``order``; an NA poisons the rest."""
    return scan(df, by, order, sums=[(value, name)], num_partitions=num_partitions)


def match_groups(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of key columns: an NA key is a group like any other."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


def value_scan(df: DataFrame, by: Sequence[str], x: str, num_partitions: int | None = None) -> DataFrame:
    """One row per group and distinct value that is not NA: ``by..., x, _n, _cum, _total``.

    ``_n`` rows have the value, ``_cum`` have it or a smaller one, ``_total`` have any.
    A group whose values are all NA has one row with NA in ``x``, ``_n`` and ``_cum`` and
    0 in ``_total``.
    """
    by = list(by)
    value = F.when(~F.isnan(x), F.col(x)) if isinstance(df.schema[x].dataType, (T.DoubleType, T.FloatType)) else F.col(x)
    counts = df.select(*by, value.alias(x)).groupBy(*by, x).agg(F.count(F.lit(1)).alias("_n"))
    known = scan(counts.where(F.col(x).isNotNull()), by, [F.col(x).asc()], sums=[("_n", "_cum")], num_partitions=num_partitions)
    totals = counts.groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col(x).isNotNull(), F.col("_n"))), F.lit(0)).alias("_total"))
    t = totals.select(*[F.col(b).alias(f"_t_{b}") for b in by], "_total")
    if not by:
        total = t.first()["_total"]
        return known.withColumn("_total", F.lit(total).cast("bigint"))
    joined = t.join(known, match_groups(known, t, [(b, f"_t_{b}") for b in by]), "left")
    return joined.select(*[F.col(f"_t_{b}").alias(b) for b in by], x, "_n", "_cum", "_total")


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                    prefix: str = "q", with_n: bool = False) -> DataFrame:
    """Exact type-7 quantiles of ``value`` per group (NA and NaN dropped).

    Returns ``by..., q0, q1, ...`` (one column per probability, in order),
    plus ``n`` with ``with_n``.  Matches R ``quantile(type = 7)``, Spark
    ``percentile`` and DuckDB ``quantile_cont``; a group of NA only has NA.
    """
    by = list(by)
    v = df.select(*by, F.col(value).cast("double").alias("_v"))
    return quantiles_of(thin_scan(v, by, "_v", quantile_positions(probs)), "_v", probs, by, prefix, with_n)


def quantiles_of(scanned: DataFrame, x: str, probs: Sequence[float], by: Sequence[str], prefix: str = "q",
                 with_n: bool = False) -> DataFrame:
    """Type-7 quantiles from the result of :func:`value_scan` or ``thin_scan``: one aggregate, a pair of order statistics a probability."""
    def at(p: Column) -> Column:
        return F.max(F.when((F.col("_cum") - F.col("_n") < p) & (p <= F.col("_cum")), F.col(x).cast("double")))

    aggs = [F.max("_total").alias("_total")]
    for k, p in enumerate(probs):
        h = (F.col("_total") - 1) * F.lit(float(p)) + 1
        aggs += [at(F.floor(h)).alias(f"_lo{k}"), at(F.least(F.floor(h) + 1, F.col("_total"))).alias(f"_hi{k}")]
    g = scanned.groupBy(*by).agg(*aggs)
    out = []
    for k, p in enumerate(probs):
        h = (F.col("_total") - 1) * F.lit(float(p)) + 1
        out.append((F.col(f"_lo{k}") + (F.col(f"_hi{k}") - F.col(f"_lo{k}")) * (h - F.floor(h))).alias(f"{prefix}{k}"))
    return g.select(*by, *out, *([F.col("_total").alias("n")] if with_n else []))
