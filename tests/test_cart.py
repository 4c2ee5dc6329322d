"""Trees against a plain recursive CART with pruning, over planted tables."""

import random

import pytest

from tessera.ml import cart


def grow(rows, kinds, min_split, min_bucket):
    """Plain recursive growth: rows are (features..., y)."""
    n, e = len(rows), sum(r[-1] for r in rows)
    node = {"n": n, "e": e, "risk": min(e, n - e), "kids": None}
    if n < min_split or e in (0, n):
        return node
    parent, best = (e * e + (n - e) ** 2) / n, None
    for f, factor in enumerate(kinds):
        values = sorted({r[f] for r in rows})
        if factor:
            rate = {v: sum(r[-1] for r in rows if r[f] == v) / sum(r[f] == v for r in rows) for v in values}
            values = sorted(values, key=lambda v: (rate[v], v))
        for k in range(1, len(values)):
            left = set(values[:k])
            a, b = [r for r in rows if r[f] in left], [r for r in rows if r[f] not in left]
            if min(len(a), len(b)) < min_bucket:
                continue
            gain = sum((c * c + (m - c) ** 2) / m for m, c in ((len(x), sum(r[-1] for r in x)) for x in (a, b))) - parent
            if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-9)):
                best = gain, a, b
    if best:
        node["kids"] = [grow(x, kinds, min_split, min_bucket) for x in best[1:]]
    return node


def leaves(t):
    return [t] if t["kids"] is None else [x for k in t["kids"] for x in leaves(k)]


def inner(t):
    return [] if t["kids"] is None else [t] + [x for k in t["kids"] for x in inner(k)]


def prune(t, alpha):
    """Cut weakest links until the next one costs more than alpha a split."""
    while True:
        links = [((x["risk"] - sum(v["risk"] for v in leaves(x))) / (len(leaves(x)) - 1), x) for x in inner(t)]
        if not links or min(v for v, _ in links) > alpha:
            return t
        min(links, key=lambda v: v[0])[1]["kids"] = None


def table(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x, g, z = rng.choice([1.0, 2.0, 3.5, 4.0, 7.0]), rng.choice("abcdef"), round(rng.random(), 2)
        p = 0.15 + 0.6 * (g in "bdf") * (x > 2) + 0.2 * (z > 0.6)
        out.append((i, x, g, z, int(rng.random() < p)))
    return out


@pytest.mark.parametrize("seed, min_split, cp", [(1, 5, 0.01), (2, 20, 0.02), (3, 60, 0.001)])
def test_leaves_equal_a_plain_cart(spark, seed, min_split, cp):
    rows = table(seed, 400)
    df = spark.createDataFrame(rows, "id int, x double, g string, z double, y int").repartition(5)
    tree = cart.fit(df, ["x", "g", "z"], "y", ["id"], min_split=min_split, cp=cp, folds=3)
    want = prune(grow([r[1:] for r in rows], [False, True, False], min_split, round(min_split / 3)), cp * min(sum(r[-1] for r in rows), sum(1 - r[-1] for r in rows)))
    got = [(int(x.n), int(x.events)) for x in tree.kept() if tree.is_leaf(x)]
    assert sorted(got) == sorted((x["n"], x["e"]) for x in leaves(want)) and len(got) >= 3
    frame = tree.frame(spark).collect()
    assert sum(r.n for r in frame if r.leaf) == 400 and all((r.rule is None) == r.leaf for r in frame)
    by = {r.node: r for r in frame}
    assert all(by[2 * r.node].n + by[2 * r.node + 1].n == r.n for r in frame if not r.leaf)


def test_prunings_are_nested_and_cross_validated(spark):
    rows = table(7, 600)
    df = spark.createDataFrame(rows, "id int, x double, g string, z double, y int")
    tree = cart.fit(df.repartition(3), ["x", "g", "z"], "y", ["id"], min_split=10)
    cp = tree.cp_table(spark).collect()
    assert cp[0].n_split == 0 and cp[0].rel_error == 1.0 and cp[0].x_error == pytest.approx(1.0, abs=0.1) and cp[-1].cp == 0.01
    assert all(a.cp >= b.cp and a.n_split < b.n_split and a.rel_error > b.rel_error for a, b in zip(cp, cp[1:]))
    assert min(r.x_error for r in cp) < 0.8 and all(0 < r.x_std < 0.2 for r in cp)
    again = cart.fit(df.repartition(8), ["x", "g", "z"], "y", ["id"], min_split=10)
    assert again.cp_rows == tree.cp_rows
    assert tree.importance()[1] > 0 and min(tree.importance()) >= 0


def test_numbers_with_many_values_missing_values_and_limits(spark):
    rng = random.Random(5)
    rows = [(i, rng.random() if i % 50 else None, None) for i in range(5000)]
    df = spark.createDataFrame([(i, x, int((x or 0) > 0.37)) for i, x, _ in rows], "id int, x double, y int")
    tree = cart.fit(df, ["x"], "y", ["id"], folds=0)
    assert tree.nodes[0].n == 4900 and tree.nodes[0].threshold == pytest.approx(0.37, abs=0.003)
    assert sum(tree.is_leaf(x) for x in tree.kept()) == 2
    assert round(5 / 3) == 2  # the smallest leaf where a node of five may be split
    with pytest.raises(ValueError, match="cp must be positive"):
        cart.fit(df, ["x"], "y", ["id"], cp=0)
    with pytest.raises(ValueError, match="needs rows"):
        cart.fit(df.limit(0), ["x"], "y", ["id"])
