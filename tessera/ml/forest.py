"""Probability forests of any size and depth, with factors of any number of levels.

* A factor's levels are ordered by their event rate in the training rows, once
  (for two classes a best split of a factor is one along that order), so every
  feature is a number and there is no limit of bins or levels.
* Where all rows fit one task (``LOCAL_BYTES``), the trees are dealt out in blocks:
  every block's task gets the rows and grows its trees whole, all nodes of a level
  at once, until nodes are pure or hold ``min_n`` rows.  All candidates of a tuning
  grid are grown by one job.
* Larger data first grow the tops of the trees over the cluster, level by level,
  from histograms that every partition sums for its rows; a node that is small
  enough is handed, with its rows, to one task that grows the rest of its subtree
  in the same way.

Bootstrap draws depend on the seed and the rows alone: a task that runs again grows
the same trees.  Split thresholds inside a task are exact; those of the tops lie on
a grid of ``TOP_BINS`` quantiles.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.session import ensure_checkpoint_dir

#: bytes of feature values of a node that one task may hold
LOCAL_BYTES = 128 << 20
#: trees of one task's block (fewer if there would be under ``TASKS`` tasks), and of those the ones that grow side by side,
#: as long as they have no more than ``GROWN_ROWS`` rows
BLOCK_TREES = 50
TASKS = 48
TOGETHER = 10
GROWN_ROWS = 4_000_000
#: features of at most this many different values are split by histograms, others by sorting
NARROW = 48
TOP_BINS = 256
#: bytes of histograms that a partition holds at once while tops grow
TOP_BYTES = 256 << 20
SCORE_ROWS = 20_000
#: cells of the tables that the search for splits holds at once, and the rows whose nodes it goes through together
CELLS = 1 << 19
LEVEL_ROWS = 1 << 20
#: a feature of few values, one of which so many rows have, is searched from the rows that have another
USUAL = 0.95
#: rows of nodes that do not try a feature are left out of its search if it is tried by less than this share
SHARE = 0.8
#: the sum of a block's shares is rounded to this part of one, so that sums over blocks do not depend on their order
POINT = float(1 << 40)
#: sums of weights and of events in one number: weights stay below it
PACK = float(1 << 26)


@dataclass(frozen=True)
class Spec:
    """One forest: features tried at a node, the largest node that is not split, trees, seed."""

    mtry: int
    min_n: int
    trees: int = 1000
    seed: int = 345


def _improvement(le, ln, e, n):
    """Sum of (class count)^2 / rows over the two children of a split; -inf where a child is empty."""
    re, rn = e - le, n - ln
    with np.errstate(divide="ignore", invalid="ignore"):
        out = (le * le + (ln - le) ** 2) / ln + (re * re + (rn - re) ** 2) / rn
    return np.where((ln > 0) & (rn > 0), out, -np.inf)


class Rows:
    """Rows of a node as a task holds them: in the order of the first wide feature, as codes of their values, and which features are split how."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.p = x.shape[1]
        self.values, codes = [], []
        for f in range(self.p):
            v, c = np.unique(x[:, f], return_inverse=True)
            self.values.append(v)
            codes.append(c.astype(np.int32))
        size = [len(v) for v in self.values]
        self.narrow = [f for f in range(self.p) if 1 < size[f] <= NARROW]
        self.wide = [f for f in range(self.p) if size[f] > NARROW]
        # nodes keep the order of the first wide feature: it is never sorted again
        self.lead = self.wide[0] if self.wide else None
        self.sorted = (np.argsort(codes[self.lead], kind="stable") if self.wide else np.arange(len(y))).astype(np.int32)
        self.place = np.empty(len(y), np.int32)
        self.place[self.sorted] = np.arange(len(y), dtype=np.int32)
        self.y = y[self.sorted]
        # all codes of a row side by side, to send it down; those of a feature by themselves, to search it
        self.flat = np.empty((len(y), self.p), np.uint8 if max(size) <= 256 else np.uint16 if max(size) <= 1 << 16 else np.int32)
        self.codes = []
        for f, c in enumerate(codes):
            c = c[self.sorted]
            self.flat[:, f] = c
            self.codes.append(c.astype(np.uint8) if f in self.narrow else c)
        self.flat = self.flat.ravel()
        # a feature that nearly always has one value is searched from the other rows, and from what they leave of a node's total
        counts = {f: np.bincount(self.codes[f]) for f in self.narrow}
        self.usual = {f: int(n.argmax()) for f, n in counts.items() if n.max() >= USUAL * len(y)}
        self.unusual = np.zeros(len(y), bool)
        for f, v in self.usual.items():
            self.unusual |= self.codes[f] != v


def _best_cuts(node, at_end, n, e, before):
    """Best split of each node along a feature, from its cells: a node's rows of one value, in the order of node and value.

    ``at_end`` has the packed sums of all rows up to each cell's end, ``before`` those up to each node's begin.  A split between two
    cells that hold nothing but the same class is never best (the score is convex along a run of one class), so those are not looked at.
    Returns nodes that can be split, their scores, the cells after which to split, and the packed sums to the left.
    """
    own = np.diff(at_end, prepend=0.0)
    hits = np.floor(own * (1 / PACK))
    none, all_ = own < PACK, own == hits * (PACK + 1)
    at = np.flatnonzero((node[1:] == node[:-1]) & ~(none[1:] & none[:-1] | all_[1:] & all_[:-1]))
    if not len(at):
        return at, np.zeros(0), at, np.zeros(0)
    g = node[at]
    left = at_end[at] - before[g]
    le = np.floor(left * (1 / PACK))
    score = _improvement(le, left - le * PACK, e[g], n[g])
    begins = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    best = np.maximum.reduceat(score, begins)
    # the first position of each node that has its best score
    is_top = np.flatnonzero(score == np.repeat(best, np.diff(begins, append=len(g))))
    chosen = is_top[np.concatenate([[True], g[is_top[1:]] != g[is_top[:-1]]])]
    return g[chosen], best, at[chosen], left[chosen]


class _Level:
    """Best splits of some open nodes whose rows (``row``, packed ``sums``) lie one node after the other, in the order of the lead feature."""

    def __init__(self, rows: Rows, row, sums, size, n, e, tried):
        self.rows, self.row, self.sums, self.size, self.n, self.e, self.tried = rows, row, sums, size, n, e, tried
        k = len(size)
        self.score, self.feature = np.full(k, -np.inf), np.full(k, -1, np.int64)
        self.code, self.threshold, self.left = np.zeros(k, np.int64), np.zeros(k), np.zeros(k)
        if rows.usual:
            self.some = np.flatnonzero(rows.unusual.take(row))
            self.some_row, self.some_node = row[self.some], np.searchsorted(np.cumsum(size), self.some, "right")
        for f in [*rows.narrow, *rows.wide]:  # only rows of nodes that try the feature
            nodes = np.flatnonzero(tried[:, f])
            if not len(nodes):
                continue
            if f in rows.usual:
                self._mostly_one_value(f, tried[:, f])
                continue
            r, w, count = row, sums, size
            if len(nodes) < SHARE * k:
                mask = np.repeat(tried[:, f], size)
                r, w, count = row[mask], sums[mask], size[nodes]
            else:  # cheaper than to leave the others' rows out
                nodes = np.arange(k)
            (self._narrow if f in rows.narrow else self._wide)(f, nodes, r, w, count)

    def _take(self, f, nodes, score, code, after, left):
        """Note the splits that are better than what their nodes have."""
        better = (score > self.score[nodes]) & self.tried[nodes, f]
        to, code, after = nodes[better], code[better], after[better]
        low, high = self.rows.values[f][code], self.rows.values[f][after]
        middle = (low + high) / 2
        self.score[to], self.feature[to], self.code[to], self.left[to] = score[better], f, code, left[better]
        self.threshold[to] = np.where(middle < high, middle, low)

    def _from_table(self, f, nodes, table):
        """From the sums of every value of a feature of few values."""
        size = len(self.rows.values[f])
        cells = np.flatnonzero(table > 0)
        n, e = self.n[nodes], self.e[nodes]
        total = n + e * PACK
        g, score, at, left = _best_cuts(cells // size, np.cumsum(table[cells]), n, e, np.cumsum(total) - total)
        code = cells[at] - g * size
        self._take(f, nodes[g], score, code, np.minimum(code + 1, size - 1), left)

    def _mostly_one_value(self, f, tried):
        code = self.rows.codes[f].take(self.some_row)
        here = np.flatnonzero((code != self.rows.usual[f]) & tried[self.some_node])
        if not len(here):
            return  # no node has a second value
        nodes, at = np.unique(self.some_node[here], return_inverse=True)
        size = len(self.rows.values[f])
        table = np.bincount(at * size + code[here], self.sums[self.some[here]], len(nodes) * size).reshape(-1, size)
        table[:, self.rows.usual[f]] = self.n[nodes] + self.e[nodes] * PACK - table.sum(1)
        self._from_table(f, nodes, table.ravel())

    def _narrow(self, f, nodes, row, sums, count):
        size = len(self.rows.values[f])
        step, ends = max(1, CELLS // size), np.cumsum(count)
        for lo in range(0, len(nodes), step):
            hi = min(len(nodes), lo + step)
            a, b = (ends[lo - 1] if lo else 0), ends[hi - 1]
            key = np.repeat(np.arange(hi - lo) * size, count[lo:hi])
            key += self.rows.codes[f].take(row[a:b])
            self._from_table(f, nodes[lo:hi], np.bincount(key, sums[a:b], (hi - lo) * size))

    def _wide(self, f, nodes, row, sums, count):
        g, c = np.repeat(np.arange(len(nodes), dtype=np.int32), count), self.rows.codes[f].take(row)
        if f != self.rows.lead:
            order = np.argsort(g.astype(np.int64) * len(self.rows.values[f]) + c, kind="stable")
            g, c, sums = g[order], c[order], sums[order]
        cells = np.flatnonzero(np.concatenate([(g[1:] != g[:-1]) | (c[1:] != c[:-1]), [True]]))
        n, e = self.n[nodes], self.e[nodes]
        total = n + e * PACK
        h, score, at, left = _best_cuts(g[cells], np.cumsum(sums)[cells], n, e, np.cumsum(total) - total)
        self._take(f, nodes[h], score, c[cells[at]], c[cells[at + 1]], left)

    def children(self, open_):
        """Rows of the open children, in their order: ``row, sums, size``; ``open_`` has a pair for each node, false where it is not split."""
        row, sums, size, ends = self.row, self.sums, self.size, np.cumsum(self.size)
        key = row * self.rows.p
        key += np.repeat(np.maximum(self.feature, 0), size)
        right = self.rows.flat.take(key) > np.repeat(self.code.astype(self.rows.flat.dtype), size)
        del key
        sides = [np.flatnonzero(side & np.repeat(open_[:, i], size)) for i, side in enumerate((~right, right))]
        upto = [np.searchsorted(at, ends) for at in sides]
        pair = np.stack([np.diff(n, prepend=0) for n in upto], 1)
        begin = (np.cumsum(pair) - pair.ravel()).reshape(-1, 2)
        # left ones close up, right ones follow behind them
        moved = np.empty(pair.sum(), row.dtype), np.empty(pair.sum())
        for i, at in enumerate(sides):
            place = np.arange(len(at)) + np.repeat(begin[:, i] - upto[i] + pair[:, i], pair[:, i])
            moved[0][place], moved[1][place] = row.take(at), sums.take(at)
        return (*moved, pair[open_])


def _open(n, e, min_n):
    return (n > min_n) & (e > 0) & (e < n)


def grow(rows: Rows, row: np.ndarray, weight: np.ndarray, node: np.ndarray, roots: int, mtry: int, min_n: int, rng) -> dict:
    """Trees with roots ``0 .. roots - 1``, grown level by level from rows with whole weights; about ``LEVEL_ROWS`` rows are split at a time.

    Returns flat arrays: ``feature`` (-1 for a leaf), ``threshold`` (left if not above), ``left``, ``right``, ``value`` (event share)
    and the impurity decrease of each feature.
    """
    p = rows.p
    if weight.sum(dtype=float) >= PACK:
        raise ValueError("too many rows to grow together")
    out = {c: [] for c in ("feature", "threshold", "left", "right", "value")}
    importance = np.zeros(p)
    row, node = rows.place[row].astype(np.intp), node.astype(np.int32, copy=False)
    # rows stay in the order of their nodes, those of a node in that of the first wide feature
    key = node * np.int64(len(rows.y)) + row
    if (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        row, weight, node = row[order], weight[order], node[order]
    del key
    # a row's weight, and PACK times its weight if it is an event: one number that sums carry exactly
    sums = weight * (1.0 + rows.y[row] * PACK)
    total = np.bincount(node, sums, roots)
    e = np.floor(total * (1 / PACK))
    n = total - e * PACK
    open_, size = _open(n, e, min_n), np.bincount(node, minlength=roots)
    if not open_.all():
        keep = open_[node]
        row, sums, size = row[keep], sums[keep], size[open_]
    del node, weight
    first, m = 0, roots
    while m:
        here = np.flatnonzero(open_)
        k = len(here)
        feature, threshold = np.full(m, -1, np.int32), np.zeros(m)
        left = np.full(m, -1, np.int32)
        made, parts, opened = 0, [], []
        if k:
            draw = rng.random((k, p))
            tried = draw <= np.partition(draw, min(mtry, p) - 1, axis=1)[:, min(mtry, p) - 1:min(mtry, p)]
            del draw
            # whole nodes, about LEVEL_ROWS rows at a time
            ends = np.cumsum(size)
            cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(LEVEL_ROWS, ends[-1], LEVEL_ROWS), "right"), [k]]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                lo, hi, these = (ends[a - 1] if a else 0), ends[b - 1], here[a:b]
                nn, ee = n[these], e[these]
                level = _Level(rows, row[lo:hi], sums[lo:hi], size[a:b], nn, ee, tried[a:b])
                parent = (ee ** 2 + (nn - ee) ** 2) / nn
                split = level.score > parent * (1 + 1e-12)
                np.add.at(importance, level.feature[split], (level.score - parent)[split])
                to, got = these[split], level.left[split]
                if not len(to):
                    continue
                feature[to], threshold[to] = level.feature[split], level.threshold[split]
                left[to] = first + m + 2 * (made + np.arange(len(to)))
                made += len(to)
                le = np.floor(got * (1 / PACK))
                ln = got - le * PACK
                pair = np.stack([ln, nn[split] - ln, le, ee[split] - le]).reshape(2, 2, -1).transpose(0, 2, 1)
                opened.append(pair)
                kept = np.zeros((b - a, 2), bool)
                kept[split] = _open(pair[0], pair[1], min_n)
                parts.append(level.children(kept))
                del level
        value = np.divide(e, n, out=np.zeros(m), where=n > 0)
        for c, v in zip(out, (feature, threshold, left, np.where(left < 0, -1, left + 1).astype(np.int32), value)):
            out[c].append(v)
        first, m = first + m, 2 * made
        if made:
            n, e = (np.concatenate([v[i] for v in opened]).ravel() for i in (0, 1))
            open_ = _open(n, e, min_n)
            row, sums, size = (np.concatenate([v[i] for v in parts]) for i in range(3))
    return {c: np.concatenate(v) for c, v in out.items()} | {"importance": importance}


def walk(tree: dict, x: np.ndarray, roots: int) -> np.ndarray:
    """Sum over the trees of the event share in the leaf that each row falls into."""
    return np.concatenate([np.zeros(0), *[_walk(tree, x[i:i + SCORE_ROWS], roots) for i in range(0, len(x), SCORE_ROWS)]])


def _walk(tree: dict, x: np.ndarray, roots: int) -> np.ndarray:
    n = len(x)
    at = np.tile(np.arange(roots), n)
    row = np.repeat(np.arange(n), roots)
    total = np.zeros(n)
    while len(at):
        f = tree["feature"][at]
        leaf = f < 0
        if leaf.any():
            total += np.bincount(row[leaf], tree["value"][at[leaf]], n)
            at, row, f = at[~leaf], row[~leaf], f[~leaf]
        at = np.where(x[row, f] > tree["threshold"][at], tree["right"][at], tree["left"][at])
    return total


#: a split has a threshold, a leaf its event share; a right child follows the left one
_PARTS = (("feature", "<i4"), ("number", "<f8"), ("left", "<i4"), ("importance", "<f8"))
_TREES = "candidate int, first_tree int, trees int, " + ", ".join(f"{c} binary" for c, _ in _PARTS)
_TOTALS = "candidate int, row bigint, total double"


def _tree_row(candidate: int, first: int, trees: int, tree: dict) -> dict:
    tree = tree | {"number": np.where(tree["feature"] < 0, tree["value"], tree["threshold"])}
    return {"candidate": candidate, "first_tree": first, "trees": trees} | {c: tree[c].astype(t).tobytes() for c, t in _PARTS}


def _tree_of(r: dict) -> dict:
    t = {c: np.frombuffer(r[c], k) for c, k in _PARTS}
    leaf = t["feature"] < 0
    return t | {"threshold": np.where(leaf, 0.0, t["number"]), "value": np.where(leaf, t["number"], 0.0), "right": np.where(leaf, -1, t["left"] + 1)}


def _arrow(schema: str, spark: SparkSession) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def _matrix(t: pa.Table, column: str) -> np.ndarray:
    return t.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)


def _in_order(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """An order of the rows that does not depend on how they arrived (equal rows are interchangeable)."""
    return np.lexsort((*x.T, y))


class FactorOrder:
    """Each factor's levels by rising event rate in the training rows; a level not seen there stands at the mean rate."""

    def __init__(self, train: DataFrame, label: str, features: str):
        self.label, self.features = label, features
        attrs = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
        self.levels = {a["idx"]: len(a["vals"]) for a in attrs.get("nominal", [])}
        self.ranks: dict[int, list[float]] = {}
        if self.levels:
            x = vector_to_array(F.col(features))
            each = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.get(x, F.lit(i)).cast("int").alias("level")) for i in self.levels]))
            # one row a level: the levels are part of the model
            rate = (train.select(F.col(label).alias("y"), each.alias("v")).groupBy("v.f", "v.level")
                    .agg(F.avg("y").alias("rate"), F.count("y").alias("n")).collect())
            events, n = sum(r["rate"] * r["n"] for r in rate), sum(r["n"] for r in rate)
            mean = events / n if n else 0.0
            for f, size in self.levels.items():
                known = {r["level"]: r["rate"] for r in rate if r["f"] == f}
                order = sorted(range(size), key=lambda v: (known.get(v, mean), v))
                rank = [0.0] * size
                for k, v in enumerate(order):
                    rank[v] = float(k)
                self.ranks[f] = rank

    def coded(self, df: DataFrame, *keep: str) -> DataFrame:
        """``keep..., label, x``: features as an array of numbers, factors as places in their order."""
        x = vector_to_array(F.col(self.features))
        if self.ranks:
            tables = F.array(*[F.array(*[F.lit(v) for v in self.ranks[f]]) if f in self.ranks else F.lit(None).cast("array<double>")
                               for f in range(max(self.ranks) + 1)])
            x = F.transform(x, lambda v, i: F.coalesce(F.get(F.get(tables, i), v.cast("int")), v))
        return df.select(*keep, F.col(self.label).cast("double").alias(self.label), x.alias("x"))


def _local(train: DataFrame, specs: Sequence[Spec], label: str, scored: DataFrame | None = None) -> DataFrame:
    """All trees of all forests from rows that one task can hold: a task for every block of trees, which leave it as they are grown.

    With ``scored`` (``row, x``) no tree leaves its task, only the sums of the shares that its block gives each of these rows.
    """
    spark = train.sparkSession
    scoring, specs = scored is not None, list(specs)
    size = min(BLOCK_TREES, max(1, sum(s.trees for s in specs) // (TASKS * TOGETHER)) * TOGETHER)
    # the largest ones first: a task each, by its number
    order = sorted(range(len(specs)), key=lambda c: (-specs[c].mtry, specs[c].min_n))
    jobs = [(c, first, min(size, specs[c].trees - first)) for c in order for first in range(0, specs[c].trees, size)]
    kind = _TOTALS if scoring else _TREES
    arrow = _arrow(kind, spark)

    def block(job, held: list):
        t = pa.Table.from_batches(held)
        held.clear()
        number = t.column("row").combine_chunks()
        mine = number.is_null()
        known = t.filter(mine)
        x, y = _matrix(known, "x"), known.column(label).to_numpy()
        order = _in_order(x, y)
        rows, spec = Rows(x[order], y[order]), specs[job[0]]
        del known, x, y, order
        if scoring:
            number = number.filter(number.is_valid())
            seen = _matrix(t.filter(pc.invert(mine)), "x") if len(number) else np.zeros((0, 1))
            total = np.zeros(len(number))
        del t
        n = len(rows.y)
        together = max(1, min(TOGETHER, GROWN_ROWS // n))
        for first in range(job[1], job[1] + job[2], together):
            count = min(together, job[1] + job[2] - first)
            rng = np.random.default_rng([spec.seed, first, 1])
            drawn = np.stack([np.bincount(rng.integers(0, n, n), minlength=n)[rows.sorted].astype(np.float32) for _ in range(count)])
            tree, at = (v.astype(np.int32) for v in drawn.nonzero())
            weight = drawn[tree, at]
            del drawn
            grown = grow(rows, rows.sorted[at], weight, tree, count, spec.mtry, spec.min_n, rng)
            if not scoring:
                yield pa.RecordBatch.from_pylist([_tree_row(job[0], first, count, grown)], arrow)
            else:
                total += walk(grown, seen, count)
        if scoring:
            total = np.round(total * POINT) / POINT
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(number), job[0], np.int32)), number, pa.array(total)], schema=arrow)

    def run(batches):
        job, held = None, []
        for b in batches:
            if b.num_rows:
                job = b.column(0)[0].as_py()
                held.append(b)
        if held:
            yield from block(jobs[job], held)

    all_rows = train.select(F.lit(None).cast("bigint").alias("row"), label, "x")
    if scored is not None:
        all_rows = all_rows.unionByName(scored.select("row", F.lit(None).cast("double").alias(label), "x"))
    dealt = all_rows.select(F.explode(F.sequence(F.lit(0), F.lit(len(jobs) - 1))).alias("job"), "row", label, "x")
    return dealt.repartitionById(len(jobs), F.col("job")).mapInArrow(run, kind)


def _draws(spec: Spec, tree: int, uid: np.ndarray) -> np.ndarray:
    """How often each row is in a tree's sample: Poisson(1) by a hash of seed, tree and row number."""
    z = uid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((spec.seed * 1_000_003 + tree) * 0x632BE59BD9B4E019 % 2 ** 64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)
    steps = np.cumsum(np.exp(-1.0) / np.cumprod(np.concatenate([[1.0], np.arange(1, 16)])))
    return np.searchsorted(steps, u, "right").astype(float)


class _Top:
    """The top of one tree: splits so far, and the nodes that still wait for a split."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.value = [-1], [0.0], [-1], [-1], [0.0]
        self.open, self.handed, self.importance = [0], [], {}

    def split(self, node: int, f: int, t: float) -> None:
        self.feature[node], self.threshold[node] = f, t
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for part, v in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            part += [v, v]

    def places(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        f, t, lo, hi = np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right)
        while True:
            go = np.flatnonzero(f[at] >= 0)
            if not len(go):
                return at
            here = at[go]
            at[go] = np.where(x[go, f[here]] > t[here], hi[here], lo[here])


def _spread(train: DataFrame, candidate: int, spec: Spec, label: str, p: int, local_rows: int) -> DataFrame:
    """One forest on rows that no task can hold: tops by summed histograms, then subtrees in tasks."""
    spark = train.sparkSession
    cut_points = [F.percentile_approx(F.get("x", F.lit(f)), [i / TOP_BINS for i in range(1, TOP_BINS)], 10 * TOP_BINS).alias(f"c{f}") for f in range(p)]
    cuts = [np.unique(np.array(c, float)) for c in train.agg(*cut_points).first()]  # values above a cut go right
    begin = np.concatenate([[0], np.cumsum([len(c) + 1 for c in cuts])]).astype(np.int64)
    bins = int(begin[-1])
    out = []
    per_pass = max(1, TOP_BYTES // (16 * bins))
    pending = list(range(spec.trees))
    while pending:
        group, pending = pending[:min(per_pass, BLOCK_TREES)], pending[min(per_pass, BLOCK_TREES):]
        tops = {t: _Top() for t in group}
        while any(top.open for top in tops.values()):
            # as many open nodes as a partition's histograms may hold
            work = [(t, v) for t, top in tops.items() for v in top.open][:per_pass]
            for r in _histogram_pass(train, tops, work, spec, label, cuts, begin):
                top, node = tops[r["tree"]], r["node"]
                top.open.remove(node)
                top.value[node] = r["events"] / r["n"] if r["n"] else 0.0
                if r["rows"] <= local_rows:
                    top.handed.append(node)
                elif r["feature"] >= 0:
                    top.split(node, r["feature"], r["threshold"])
                    top.importance[r["feature"]] = top.importance.get(r["feature"], 0.0) + r["gain"]
                    top.open += [top.left[node], top.right[node]]
        out.append(_subtrees(train, tops, candidate, spec, label, p))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def _histogram_pass(train: DataFrame, tops: dict, work: list, spec: Spec, label: str, cuts: list, begin: np.ndarray):
    """For every node of ``work``: its rows, events and best split on the quantile grid."""
    bins, p = int(begin[-1]), len(cuts)
    trees = sorted({t for t, _ in work})
    slot = {key: i for i, key in enumerate(work)}

    def count(batches):
        total = np.zeros((len(work), 2, bins))
        held = np.zeros(len(work))
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            y, uid = b.column(0).to_numpy(), b.column(2).to_numpy()
            code = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1) + begin[:-1]
            for t in trees:
                node, w = tops[t].places(x), _draws(spec, t, uid)
                table = np.full(len(tops[t].feature), -1)
                for v in tops[t].open:
                    table[v] = slot.get((t, v), -1)
                at = table[node]
                use = np.flatnonzero((at >= 0) & (w > 0))
                key = (code[use] + (at[use] * bins)[:, None]).ravel()
                wide = np.repeat(w[use], p)
                total[:, 0] += np.bincount(key, wide, len(work) * bins).reshape(-1, bins)
                total[:, 1] += np.bincount(key, wide * np.repeat(y[use], p), len(work) * bins).reshape(-1, bins)
                held += np.bincount(at[use], minlength=len(work))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(work)), pa.int32()), pa.array(held),
                                          pa.array([v.tobytes() for v in total], pa.binary())], ["slot", "rows", "sums"])

    def best(t: pa.Table) -> pa.Table:
        i = t.column("slot")[0].as_py()
        n_h, e_h = sum(np.frombuffer(s, np.float64) for s in t.column("sums").to_pylist()).reshape(2, bins)
        size = begin[1] - begin[0]
        n, e = n_h[:size].sum(), e_h[:size].sum()
        row = {"tree": work[i][0], "node": work[i][1], "rows": int(sum(t.column("rows").to_pylist())), "n": float(n), "events": float(e),
               "feature": -1, "threshold": 0.0, "gain": 0.0}
        if n > spec.min_n and 0 < e < n:
            rng = np.random.default_rng([spec.seed, *work[i], 2])
            parent = (e * e + (n - e) ** 2) / n
            for f in rng.permutation(p)[:spec.mtry].tolist():
                lo, hi = begin[f], begin[f + 1] - 1
                score = _improvement(np.cumsum(e_h[lo:hi]), np.cumsum(n_h[lo:hi]), e, n)
                if len(score) and score.max() > max(parent * (1 + 1e-12), row["gain"] + parent):
                    k = int(score.argmax())
                    row |= {"feature": f, "threshold": float(cuts[f][k]), "gain": float(score[k] - parent)}
        return pa.Table.from_pylist([row], schema)

    text = "tree int, node int, rows bigint, n double, events double, feature int, threshold double, gain double"
    schema = _arrow(text, train.sparkSession)
    return train.mapInArrow(count, "slot int, rows double, sums binary").groupBy("slot").applyInArrow(best, text).collect()


def _subtrees(train: DataFrame, tops: dict, candidate: int, spec: Spec, label: str, p: int) -> DataFrame:
    """Hand the rows of every small node to a task that grows its subtree, then put each tree together."""
    spark, kind = train.sparkSession, "tree int, node int, weight double, label double, x array<double>"
    arrow = _arrow(_TREES + ", node int", spark)

    def deal(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            uid = b.column(2).to_numpy()
            for t, top in tops.items():
                node, w = top.places(x), _draws(spec, t, uid)
                use = np.flatnonzero(np.isin(node, top.handed) & (w > 0))
                take = pa.array(use)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(use), t, np.int32)), pa.array(node[use].astype(np.int32)), pa.array(w[use]),
                                                  b.column(0).take(take), b.column(1).take(take)], ["tree", "node", "weight", "label", "x"])

    def local(t: pa.Table) -> pa.Table:
        tree, node = t.column("tree")[0].as_py(), t.column("node")[0].as_py()
        x, y, w = _matrix(t, "x"), t.column("label").to_numpy(), t.column("weight").to_numpy()
        order = np.lexsort((*x.T, y, w))
        rng = np.random.default_rng([spec.seed, tree, node, 3])
        grown = grow(Rows(x[order], y[order]), np.arange(len(y)), w[order], np.zeros(len(y), np.int64), 1, spec.mtry, spec.min_n, rng)
        return pa.Table.from_pylist([_tree_row(candidate, tree, 1, grown) | {"node": node}], arrow)

    def join(t: pa.Table) -> pa.Table:
        parts = sorted(t.to_pylist(), key=lambda r: -1 if r["node"] is None else r["node"])
        top = tops[parts[0]["first_tree"]]
        whole = {"feature": [np.array(top.feature)], "threshold": [np.array(top.threshold)], "left": [np.array(top.left)],
                 "right": [np.array(top.right)], "value": [np.array(top.value)]}
        size, importance = len(top.feature), np.zeros(p)
        for f, g in top.importance.items():
            importance[f] += g
        for r in parts:
            if r["node"] is None:
                continue
            sub, node = _tree_of(r), r["node"]
            # the subtree's root takes the node's place, its other nodes follow at the end
            move = lambda v: np.where(v > 0, v + size - 1, v)
            for c in whole:
                v = move(sub[c]) if c in ("left", "right") else sub[c]
                whole[c][0][node] = v[0]
                whole[c].append(v[1:])
            size += len(sub["feature"]) - 1
            importance += sub["importance"]
        tree = {c: np.concatenate(v) for c, v in whole.items()} | {"importance": importance}
        return pa.Table.from_pylist([_tree_row(candidate, parts[0]["first_tree"], 1, tree)], _arrow_trees)

    _arrow_trees = _arrow(_TREES, spark)
    dealt = train.mapInArrow(deal, kind)
    grown = dealt.groupBy("tree", "node").applyInArrow(local, _TREES + ", node int")
    none = spark.createDataFrame([(candidate, t, 1) for t in tops], "candidate int, first_tree int, trees int")  # a tree without handed nodes
    grown = grown.unionByName(none, allowMissingColumns=True)
    return grown.groupBy("first_tree").applyInArrow(join, _TREES).checkpoint(eager=True)


class Forests:
    """Fitted forests, one for each spec: a stored table of trees."""

    def __init__(self, trees: DataFrame, order: FactorOrder, specs: Sequence[Spec], p: int):
        self.trees, self.order, self.specs, self.p = trees, order, list(specs), p

    def importance(self, candidate: int = 0) -> list[float]:
        """Impurity decrease of each feature, as shares that add up to 1."""
        total = np.zeros(self.p)
        for r in self.trees.where(F.col("candidate") == candidate).select("importance").toLocalIterator():
            total += np.frombuffer(r["importance"], "<f8")
        return (total / (total.sum() or 1.0)).tolist()

    def score(self, df: DataFrame, event_col: str = "pred_event") -> DataFrame:
        """``candidate, row, label, pred_event`` for every row of ``df`` under every forest; rows are numbered.

        Blocks of rows meet blocks of trees in tasks of bounded size; the shares are summed by row.
        """
        spark, label = df.sparkSession, self.order.label
        ensure_checkpoint_dir(spark)
        rows = self.order.coded(df).withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True)
        # rows are sent to the trees, which are the larger part: in few blocks, each of what a task holds
        blocks = max(1, -(-8 * self.p * rows.count() // LOCAL_BYTES))
        keyed = self.trees.select("candidate", F.floor(F.col("first_tree") / BLOCK_TREES).alias("part")).distinct()
        part = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
        # every block of trees is sent every block of rows: the numbers of blocks are small, the rows are dealt by an explicit list
        jobs = [(r["candidate"], r["part"]) for r in keyed.collect()]
        each = F.explode(F.array(*[F.struct(F.lit(c).cast("int").alias("candidate"), F.lit(b).cast("bigint").alias("part")) for c, b in jobs]))
        left = rows.select("row", "x", part.alias("block"), each.alias("j")).select("row", "x", "block", "j.candidate", "j.part")
        right = self.trees.withColumn("part", F.floor(F.col("first_tree") / BLOCK_TREES)).withColumn(
            "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

        def run(rows_: pa.Table, trees: pa.Table) -> pa.Table:
            x = _matrix(rows_, "x") if rows_.num_rows else np.zeros((0, 1))
            total = np.zeros(len(x))
            for r in sorted(trees.to_pylist(), key=lambda r: r["first_tree"]):
                total += walk(_tree_of(r), x, r["trees"])
            total = np.round(total * POINT) / POINT
            return rows_.select(["candidate", "row"]).append_column("total", pa.array(total))

        on = ["candidate", "part", "block"]
        summed = (left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(run, "candidate int, row bigint, total double")
                  .groupBy("candidate", "row").agg(F.sum("total").alias("total")))
        return _shares(summed, rows, self.specs, label, event_col)


def _shares(summed: DataFrame, rows: DataFrame, specs: Sequence[Spec], label: str, event_col: str) -> DataFrame:
    """The mean over a forest's trees of what they give each row, beside its label."""
    sizes = F.array(*[F.lit(float(s.trees)) for s in specs])
    return (summed.join(rows.select(F.col("row").alias("_row"), label), F.col("row") == F.col("_row"))
            .select("candidate", "row", label, (F.col("total") / F.get(sizes, F.col("candidate"))).alias(event_col)))


def _prepared(train: DataFrame, label: str, features: str, local_bytes: int | None):
    """Factor order, stored coded rows, features, rows that a task may hold, and whether all fit one."""
    ensure_checkpoint_dir(train.sparkSession)
    train = train.select(label, features)
    order = FactorOrder(train, label, features)
    rows = order.coded(train).withColumn("uid", F.monotonically_increasing_id()).checkpoint(eager=True)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("p")).first()
    if not size["n"]:
        raise ValueError("a forest needs rows")
    p = size["p"]
    local_rows = max(1, (LOCAL_BYTES if local_bytes is None else local_bytes) // (8 * p))
    return order, rows, p, local_rows, size["n"] <= local_rows


def _fitted(prepared, specs: Sequence[Spec], label: str) -> Forests:
    order, rows, p, local_rows, fits = prepared
    if fits:
        trees = _local(rows.drop("uid"), specs, label).checkpoint(eager=True)
    else:
        trees = None
        for c, spec in enumerate(specs):
            one = _spread(rows, c, spec, label, p, local_rows)
            trees = one if trees is None else trees.unionByName(one)
    return Forests(trees, order, specs, p)


def fit(train: DataFrame, specs: Sequence[Spec], label: str = "label", features: str = "features", local_bytes: int | None = None) -> Forests:
    """Fit one forest for each spec on rows of ``label`` (0 or 1) and a vector of features, whose factors are marked in its metadata."""
    return _fitted(_prepared(train, label, features, local_bytes), specs, label)


def fit_score(train: DataFrame, specs: Sequence[Spec], df: DataFrame, label: str = "label", features: str = "features",
              event_col: str = "pred_event", local_bytes: int | None = None) -> DataFrame:
    """``fit(train, specs).score(df)`` where the forests themselves are not wanted: trees that tasks grow whole score there and are not stored."""
    prepared = _prepared(train, label, features, local_bytes)
    order, stored, p, local_rows, fits = prepared
    if not fits or 8 * p * df.count() > LOCAL_BYTES:
        return _fitted(prepared, specs, label).score(df, event_col)
    rows = order.coded(df).withColumn("row", F.monotonically_increasing_id()).checkpoint(eager=True)
    totals = _local(stored.drop("uid"), specs, label, rows.select("row", "x"))
    return _shares(totals.groupBy("candidate", "row").agg(F.sum("total").alias("total")), rows, specs, label, event_col)
