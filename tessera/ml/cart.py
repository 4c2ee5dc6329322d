"""Classification trees with cost-complexity pruning and cross-validation, for two classes.

Rows are counted by their coded features, class and fold once; the tree and the
trees of all folds then grow side by side, one pass over the counts a level.  Every
partition sums the histograms of the open nodes, a task a node picks its split, and
only splits reach the driver.

A split must pay: with ``cp`` the final tree keeps node t only if pruning it would cost
more than ``cp`` times the root's errors for each split below it.  A node with no more
errors than that can never be kept, so it is closed at once, which leaves no other
tree and bounds the open nodes of a level by 1 / cp.

Rules: a node of fewer than ``min_split`` rows is not split and no child holds fewer than
``min_bucket`` = round(``min_split`` / 3); the split is the one of largest Gini improvement,
the first feature and lowest cut among equals; a factor is split along the event rates
of its levels in the node, which holds the best of all its splits; a tie of classes
is the first class's.  Rows with a missing feature are left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.functions.random import hash_uniform
from tessera.ml.forest import _arrow, _improvement
from tessera.session import ensure_checkpoint_dir

#: a number with more different values is coded by quantiles
EXACT_VALUES = 1024


@dataclass
class Node:
    number: int
    depth: int
    n: float = 0.0
    events: float = 0.0
    feature: int = -1
    threshold: float = 0.0
    mask: np.ndarray | None = None  # codes of the feature that go left
    gain: float = 0.0
    left: int = -1
    right: int = -1
    complexity: float = 0.0

    @property
    def risk(self) -> float:
        return min(self.events, self.n - self.events)


@dataclass
class Coding:
    """How features become codes: sorted values or levels, or the upper ends of quantile ranges."""

    names: list[str]
    factor: list[bool]
    values: list[list]

    @property
    def begin(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum([len(v) for v in self.values])]).astype(np.int64)


@dataclass
class Tree:
    """A fitted tree: all grown nodes, the coding, and the table of prunings."""

    nodes: list[Node]
    coding: Coding
    alpha: float
    cp_rows: list[tuple] = field(default_factory=list)

    def kept(self) -> list[Node]:
        """Nodes of the pruned tree from the root on."""
        out, stack = [], [0]
        while stack:
            node = self.nodes[stack.pop()]
            out.append(node)
            if node.complexity > self.alpha and node.left >= 0:
                stack += [node.right, node.left]
        return out

    def is_leaf(self, node: Node) -> bool:
        return not (node.complexity > self.alpha and node.left >= 0)

    def rule(self, node: Node) -> str | None:
        """The condition under which a row goes left."""
        if self.is_leaf(node):
            return None
        name, values = self.coding.names[node.feature], self.coding.values[node.feature]
        if self.coding.factor[node.feature]:
            return f"{name} in " + ",".join(str(v) for v, m in zip(values, node.mask) if m)
        return f"{name} <= {node.threshold:.12g}"

    def frame(self, spark: SparkSession) -> DataFrame:
        """``node, rule, n, loss, class, n0, n1, complexity, leaf`` (children of node k are 2k and 2k + 1; complexity as a share of the root's errors)."""
        root = self.nodes[0].risk or 1.0
        rows = [(x.number, self.rule(x), int(x.n), int(x.risk), int(x.events > x.n - x.events), int(x.n - x.events), int(x.events),
                 float(x.complexity / root), self.is_leaf(x)) for x in self.kept()]
        return spark.createDataFrame(rows, "node bigint, rule string, n bigint, loss bigint, class int, n0 bigint, n1 bigint, complexity double, leaf boolean")

    def importance(self) -> list[float]:
        """Gini improvement by feature."""
        total = [0.0] * len(self.coding.names)
        for x in self.kept():
            if not self.is_leaf(x):
                total[x.feature] += x.gain
        return total

    def cp_table(self, spark: SparkSession) -> DataFrame:
        """``cp, n_split, rel_error, x_error, x_std``: every pruning with its cross-validated error, as shares of the root's errors."""
        return spark.createDataFrame(self.cp_rows, "cp double, n_split bigint, rel_error double, x_error double, x_std double")


def weakest_links(nodes: list[Node]) -> None:
    """Set every inner node's complexity: the price of a split at which the node becomes a leaf."""
    inner = {i for i, x in enumerate(nodes) if x.left >= 0}
    alpha = 0.0
    while inner:
        risk, leaves = {}, {}
        for i in range(len(nodes) - 1, -1, -1):  # children come after their parents
            x = nodes[i]
            if i in inner:
                risk[i], leaves[i] = risk[x.left] + risk[x.right], leaves[x.left] + leaves[x.right]
            else:
                risk[i], leaves[i] = x.risk, 1
        link = {i: (nodes[i].risk - risk[i]) / (leaves[i] - 1) for i in inner}
        alpha = max(alpha, min(link.values()))
        gone = [i for i in inner if link[i] <= alpha * (1 + 1e-12)]
        while gone:
            i = gone.pop()
            if i in inner:
                inner.discard(i)
                nodes[i].complexity = alpha
                gone += [nodes[i].left, nodes[i].right]


def _coding(df: DataFrame, features: Sequence[str]) -> Coding:
    names, factor, values = list(features), [], []
    for f in features:
        kind = df.schema[f].dataType
        factor.append(isinstance(kind, (T.StringType, T.BooleanType)))
        seen = df.select(f).where(F.col(f).isNotNull()).distinct()
        if not factor[-1]:
            few = seen.limit(EXACT_VALUES + 1).collect()
            if len(few) > EXACT_VALUES:
                cuts = df.agg(F.percentile_approx(F.col(f).cast("double"), [i / EXACT_VALUES for i in range(1, EXACT_VALUES + 1)], 10 * EXACT_VALUES)).first()[0]
                values.append(sorted({float(v) for v in cuts}))
                continue
        else:
            few = seen.collect()  # the levels of a factor are part of the model
        values.append(sorted(r[0] if factor[-1] else float(r[0]) for r in few))
    return Coding(names, factor, values)


def _counted(df: DataFrame, coding: Coding, label: str, keys: Sequence[str], folds: int, seed: int) -> DataFrame:
    """Stored ``codes, y, fold, n``: how many rows have the codes, class and fold."""
    fold = F.floor(hash_uniform(seed, *keys) * folds).cast("int") if folds else F.lit(0)
    src = df.select(*[F.col(f).cast("string" if c else "double").alias(f"f{i}") for i, (f, c) in enumerate(zip(coding.names, coding.factor))],
                    F.col(label).cast("int").alias("y"), fold.alias("fold")).na.drop()
    values, factor = coding.values, coding.factor

    def run(batches):
        index = [{str(v).lower() if isinstance(v, bool) else v: k for k, v in enumerate(vs)} if c else None for vs, c in zip(values, factor)]
        for b in batches:
            codes = np.empty((b.num_rows, len(values)), np.int32)
            for i, (vs, c) in enumerate(zip(values, factor)):
                if c:
                    codes[:, i] = [index[i][v] for v in b.column(i).to_pylist()]
                else:
                    codes[:, i] = np.minimum(np.searchsorted(np.array(vs), b.column(i).to_numpy(), "left"), len(vs) - 1)
            rows, n = np.unique(np.concatenate([codes, b.column(len(values)).to_numpy()[:, None], b.column(len(values) + 1).to_numpy()[:, None]], 1),
                                axis=0, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows[:, :-2].astype(np.int32)), pa.list_(pa.int32())), pa.array(rows[:, -2].astype(np.int32)),
                 pa.array(rows[:, -1].astype(np.int32)), pa.array(n)], ["codes", "y", "fold", "n"])

    ensure_checkpoint_dir(df.sparkSession)
    return (src.mapInArrow(run, "codes array<int>, y int, fold int, n bigint").groupBy("codes", "y", "fold").agg(F.sum("n").alias("n"))
            .checkpoint(eager=True))


def _arrays(b: pa.RecordBatch, p: int):
    codes = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
    return codes, b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy().astype(float)


def _places(nodes: list[Node], codes: np.ndarray) -> np.ndarray:
    at = np.zeros(len(codes), np.int64)
    for i, x in enumerate(nodes):  # children come after their parents
        if x.left >= 0:
            here = np.flatnonzero(at == i)
            if len(here):
                at[here] = np.where(x.mask[codes[here, x.feature]], x.left, x.right)
    return at


def best_split(n_h: np.ndarray, e_h: np.ndarray, coding: Coding, min_bucket: int):
    """``(gain, feature, mask, threshold)`` of the best split of a node from its histograms over all codes; nothing without one."""
    begin, best = coding.begin, None
    n, e = n_h[:begin[1]].sum(), e_h[:begin[1]].sum()
    parent = (e * e + (n - e) ** 2) / n
    for f in range(len(coding.names)):
        nf, ef = n_h[begin[f]:begin[f + 1]], e_h[begin[f]:begin[f + 1]]
        here = np.flatnonzero(nf > 0)
        if len(here) < 2:
            continue
        order = here[np.lexsort((here, ef[here] / nf[here]))] if coding.factor[f] else here
        ln, le = np.cumsum(nf[order])[:-1], np.cumsum(ef[order])[:-1]
        score = np.where((ln >= min_bucket) & (n - ln >= min_bucket), _improvement(le, ln, e, n), -np.inf)
        k = int(np.argmax(score > score.max() - 1e-9 * max(1.0, abs(parent)))) if np.isfinite(score.max()) else -1
        if k < 0 or score[k] <= parent * (1 + 1e-12) or (best is not None and score[k] - parent <= best[0] * (1 + 1e-9)):
            continue
        threshold = 0.0
        if coding.factor[f]:
            mask = np.zeros(len(nf), bool)
            mask[order[:k + 1]] = True
            if ln[k] * 2 >= n:  # levels that the node lacks go with the larger child
                mask[nf == 0] = True
        else:
            v = coding.values[f]
            threshold = (v[order[k]] + v[order[k + 1]]) / 2
            mask = np.array(v) <= threshold
        best = float(score[k] - parent), f, mask, float(threshold)
    return best


def fit(df: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], min_split: int = 20, min_bucket: int | None = None,
        cp: float = 0.01, folds: int = 10, max_depth: int = 30, seed: int = 1) -> Tree:
    """Grow, prune and cross-validate a tree on ``features`` (numbers, or text as factors) for a 0 / 1 ``label``.

    ``keys`` identify a row: its fold is a hash of them, so the result does not depend on how rows are dealt.
    """
    if cp <= 0:
        raise ValueError("cp must be positive: it bounds the tree")
    min_bucket = round(min_split / 3) if min_bucket is None else min_bucket
    spark, coding = df.sparkSession, _coding(df, features)
    counts = _counted(df, coding, label, keys, folds, seed)
    p, begin = len(features), coding.begin
    bins = int(begin[-1])
    total = counts.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("e")).first()
    if not total["n"]:
        raise ValueError("a tree needs rows")
    alpha = cp * min(total["e"], total["n"] - total["e"])
    trees = [[Node(1, 0)] for _ in range(folds + 1)]  # the tree itself, then one without each fold
    open_ = [(t, 0) for t in range(folds + 1)]
    text = "slot int, n double, events double, feature int, threshold double, gain double, mask binary"
    schema = _arrow(text, spark)
    while open_:
        slots = {key: i for i, key in enumerate(open_)}

        def count(batches, slots=slots):
            sums = np.zeros((len(slots), 2, bins))
            for b in batches:
                codes, y, fold, n = _arrays(b, p)
                key = codes + begin[:-1]
                for t, nodes in enumerate(trees):
                    slot_of = np.array([slots.get((t, i), -1) for i in range(len(nodes))])
                    if (slot_of < 0).all():
                        continue
                    at = slot_of[_places(nodes, codes)]
                    use = np.flatnonzero((at >= 0) & (fold != t - 1))
                    flat = (key[use] + (at[use] * bins)[:, None]).ravel()
                    for i, w in ((0, n[use]), (1, n[use] * y[use])):
                        sums[:, i] += np.bincount(flat, np.repeat(w, p), len(slots) * bins).reshape(-1, bins)
            yield pa.RecordBatch.from_arrays([pa.array(range(len(slots)), pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], ["slot", "sums"])

        def pick(t: pa.Table) -> pa.Table:
            slot = t.column("slot")[0].as_py()
            n_h, e_h = sum(np.frombuffer(s, np.float64) for s in t.column("sums").to_pylist()).reshape(2, bins)
            n, e = float(n_h[:begin[1]].sum()), float(e_h[:begin[1]].sum())
            split = best_split(n_h, e_h, coding, min_bucket) if n >= min_split and 0 < e < n else None
            gain, f, mask, threshold = split or (0.0, -1, np.zeros(0, bool), 0.0)
            return pa.Table.from_pylist([{"slot": slot, "n": n, "events": e, "feature": f, "threshold": threshold, "gain": gain, "mask": mask.tobytes()}], schema)

        found = counts.mapInArrow(count, "slot int, sums binary").groupBy("slot").applyInArrow(pick, text).collect()
        following = []
        for r in sorted(found, key=lambda r: r["slot"]):
            t, i = open_[r["slot"]]
            node = trees[t][i]
            node.n, node.events = r["n"], r["events"]
            # a training part has its share of the errors that a split must save
            bound = alpha * (trees[t][0].n / total["n"])
            if r["feature"] < 0 or node.risk <= bound or node.depth >= max_depth:
                continue
            node.feature, node.threshold, node.gain, node.mask = r["feature"], r["threshold"], r["gain"], np.frombuffer(r["mask"], bool)
            node.left, node.right = len(trees[t]), len(trees[t]) + 1
            trees[t] += [Node(2 * node.number, node.depth + 1), Node(2 * node.number + 1, node.depth + 1)]
            following += [(t, node.left), (t, node.right)]
        open_ = following
    for nodes in trees:
        weakest_links(nodes)
    tree = Tree(trees[0], coding, alpha)
    tree.cp_rows = _cross_validated(counts, trees, alpha, cp, p, total["n"])
    return tree


def _cross_validated(counts: DataFrame, trees: list[list[Node]], alpha: float, cp: float, p: int, n: int) -> list[tuple]:
    nodes, folds = trees[0], len(trees) - 1
    root = nodes[0].risk or 1.0
    levels = sorted({x.complexity for x in nodes if x.left >= 0 and x.complexity > alpha}, reverse=True) + [alpha]
    between = [float("inf")] + [(a * b) ** 0.5 for a, b in zip(levels, levels[1:])]

    def errors(batches):
        wrong = np.zeros(len(between))
        for b in batches:
            codes, y, fold, w = _arrays(b, p)
            for t in range(1, folds + 1):
                use = fold == t - 1
                if use.any():
                    share = trees[t][0].n / n
                    for k, beta in enumerate(between):
                        wrong[k] += (w[use] * (_classes(trees[t], codes[use], beta * share) != y[use])).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(between)), pa.int32()), pa.array(wrong)], ["k", "wrong"])

    wrong = {r["k"]: r["wrong"] for r in counts.mapInArrow(errors, "k int, wrong double").groupBy("k").agg(F.sum("wrong").alias("wrong")).collect()}
    rows = []
    for k, level in enumerate(levels):
        inner = [x for x in nodes if x.left >= 0 and x.complexity > level]
        risk = _pruned_risk(nodes, level)
        x = wrong[k] if folds else float("nan")
        rows.append((level / root if k < len(levels) - 1 else cp, len(inner), risk / root, x / root, (x * (1 - x / n)) ** 0.5 / root if folds else float("nan")))
    return rows


def _pruned_risk(nodes: list[Node], level: float) -> float:
    total, stack = 0.0, [0]
    while stack:
        x = nodes[stack.pop()]
        if x.left >= 0 and x.complexity > level:
            stack += [x.left, x.right]
        else:
            total += x.risk
    return total


def _classes(nodes: list[Node], codes: np.ndarray, level: float) -> np.ndarray:
    """The class of each row under the tree pruned at a complexity."""
    at, out = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    for i, x in enumerate(nodes):
        here = np.flatnonzero(at == i)
        if not len(here):
            continue
        if x.left >= 0 and x.complexity > level:
            at[here] = np.where(x.mask[codes[here, x.feature]], x.left, x.right)
        else:
            out[here] = x.events > x.n - x.events
            at[here] = -1
    return out
