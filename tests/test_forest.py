"""Forests: exact splits, factors of many levels, tops grown over partitions, determinism."""

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tessera.functions.random import hash_uniform
from tessera.ml import forest, metrics


def brute_split(x, y, w, features):
    """Best (improvement, feature, left rows) of one node over all thresholds."""
    best = (-1.0, None, None)
    for f in features:
        for v in np.unique(x[:, f])[:-1]:
            le = x[:, f] <= v
            s = 0.0
            for part in (le, ~le):
                n, e = w[part].sum(), (w * y)[part].sum()
                s += (e * e + (n - e) ** 2) / n
            if s > best[0] + 1e-9:
                best = (s, f, frozenset(np.flatnonzero(le)))
    return best


@pytest.mark.parametrize("narrow", [48, 0])
def test_a_tree_takes_the_best_split_of_every_node(monkeypatch, narrow):
    monkeypatch.setattr(forest, "NARROW", narrow)
    rng = np.random.default_rng(3)
    x = np.stack([rng.integers(0, 6, 300), rng.normal(size=300).round(2), rng.integers(0, 2, 300)], 1).astype(float)
    y = (rng.random(300) < 0.2 + 0.1 * x[:, 0]).astype(float)
    w = rng.integers(1, 4, 300).astype(float)
    tree = forest.grow(forest.Rows(x, y), np.arange(300), w, np.zeros(300, np.int64), 1, 3, 10, np.random.default_rng(1))
    stack, checked = [(0, np.arange(300))], 0
    while stack:
        node, rows = stack.pop()
        n, e = w[rows].sum(), (w * y)[rows].sum()
        assert tree["value"][node] == pytest.approx(e / n)
        f = tree["feature"][node]
        if f < 0:
            if n > 10 and 0 < e < n:
                assert brute_split(x[rows], y[rows], w[rows], range(3))[0] <= (e * e + (n - e) ** 2) / n * (1 + 1e-9)
            continue
        le = x[rows, f] <= tree["threshold"][node]
        got = sum((lambda a, b: (b * b + (a - b) ** 2) / a)(w[r].sum(), (w * y)[r].sum()) for r in (rows[le], rows[~le]))
        assert n > 10 and got == pytest.approx(brute_split(x[rows], y[rows], w[rows], range(3))[0])
        checked += 1
        stack += [(tree["left"][node], rows[le]), (tree["right"][node], rows[~le])]
    assert checked > 15
    assert forest.walk(tree, x, 1)[0] == pytest.approx(tree["value"][_leaf(tree, x[0])])


def _leaf(tree, row):
    at = 0
    while tree["feature"][at] >= 0:
        at = tree["right"][at] if row[tree["feature"][at]] > tree["threshold"][at] else tree["left"][at]
    return at


@pytest.fixture(scope="module")
def rows(spark):
    """A factor of 500 levels that decides the class, a number that helps, and noise."""
    d = spark.range(8000).select("id", F.concat(F.lit("v"), F.pmod(F.xxhash64("id"), F.lit(500)).cast("string")).alias("g"), hash_uniform(2, "id").alias("x"),
                                 hash_uniform(3, "id").alias("z"))
    d = d.withColumn("p", F.pmod(F.xxhash64("g", F.lit(9)), F.lit(2)) * 0.5 + 0.4 * F.col("x"))
    d = d.withColumn("label", (hash_uniform(5, "id") < F.col("p")).cast("double"))
    ix = StringIndexer(inputCols=["g"], outputCols=["g_ix"], handleInvalid="keep").fit(d).transform(d)
    return VectorAssembler(inputCols=["g_ix", "x", "z"], outputCol="features").transform(ix).select("id", "label", "features")


def auc(scored):
    return metrics.roc_auc(scored.withColumn("t", F.when(F.col("label") == 1, "event").otherwise("other")), "t", "pred_event", "event").first()[0]


def test_a_factor_of_500_levels(rows):
    train, test = rows.where("id % 4 <> 0"), rows.where("id % 4 = 0")
    model = forest.fit(train, [forest.Spec(2, 5, 60), forest.Spec(3, 200, 25)])
    scored = model.score(test).cache()
    assert scored.groupBy("candidate").count().count() == 2 and scored.where("candidate = 0").count() == test.count()
    assert auc(scored.where("candidate = 0")) > 0.76
    g, x, z = model.importance(0)
    assert g > x > 0 and g > z and g + x + z == pytest.approx(1)
    assert model.trees.where("candidate = 1").agg(F.sum("trees")).first()[0] == 25


def test_same_trees_however_the_rows_are_dealt(rows):
    small = rows.limit(400).cache()
    a = forest.fit(small.repartition(7), [forest.Spec(2, 3, 12)]).score(small).select("label", F.round("pred_event", 9)).collect()
    b = forest.fit(small.coalesce(1), [forest.Spec(2, 3, 12)]).score(small).select("label", F.round("pred_event", 9)).collect()
    assert sorted(a) == sorted(b)


def test_tops_over_partitions_then_subtrees(rows):
    train, test = rows.where("id % 4 <> 0"), rows.where("id % 4 = 0")
    whole = forest.fit(train, [forest.Spec(2, 5, 30)])
    split = forest.fit(train, [forest.Spec(2, 5, 30)], local_bytes=400 * 3 * 8)  # at most 400 rows in a task
    assert split.trees.agg(F.sum("trees")).first()[0] == 30
    a, b = auc(whole.score(test)), auc(split.score(test))
    assert b > 0.75 and abs(a - b) < 0.04
    assert split.importance()[0] > split.importance()[2] > 0
    # every tree predicts each training row's leaf: shares are averages of labels
    tree = forest._tree_of(split.trees.first().asDict())
    inner = tree["feature"] >= 0
    assert (tree["left"][inner] > 0).all() and (tree["right"][inner] > 0).all() and tree["right"].max() == len(tree["feature"]) - 1
    assert ((tree["value"] >= 0) & (tree["value"] <= 1)).all()


def test_depth_has_no_bound(spark):
    d = spark.range(200).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    d = VectorAssembler(inputCols=["x"], outputCol="features").transform(d)
    model = forest.fit(d, [forest.Spec(1, 1, 3)])
    tree = forest._tree_of(model.trees.first().asDict())
    depth, level = 0, list(range(3))
    while level:
        level = [c for v in level if tree["feature"][v] >= 0 for c in (tree["left"][v], tree["right"][v])]
        depth += 1
    assert depth > 20 or len(tree["feature"]) > 150
    with pytest.raises(ValueError, match="needs rows"):
        forest.fit(d.limit(0), [forest.Spec(1, 1, 3)])


def test_scores_of_forests_that_are_not_kept(rows, monkeypatch):
    train, test = rows.where("id % 4 <> 0").limit(900), rows.where("id % 4 = 0").limit(300).cache()
    train = train.cache()
    specs = [forest.Spec(2, 5, 60), forest.Spec(3, 40, 12)]
    want = forest.fit(train, specs).score(test).select("candidate", "label", F.round("pred_event", 9)).collect()
    with monkeypatch.context() as m:
        m.setattr(forest.Forests, "score", lambda *a, **k: pytest.fail("the trees were stored"))
        got = forest.fit_score(train, specs, test).select("candidate", "label", F.round("pred_event", 9)).collect()
    assert sorted(got) == sorted(want) and len(got) == 600
    large = forest.fit_score(train, specs, test, local_bytes=400 * 3 * 8)  # tops over partitions
    assert large.count() == 600 and auc(large.where("candidate = 0")) > 0.6


def test_growth_holds_a_bounded_table(monkeypatch):
    # 20 features of 40 values each: small nodes must not each hold a histogram of all of them
    import tracemalloc
    rng = np.random.default_rng(8)
    n = 20_000
    rows = forest.Rows(rng.integers(0, 40, (n, 20)).astype(float), (rng.random(n) < 0.5).astype(float))
    monkeypatch.setattr(forest, "CELLS", 1 << 16, raising=False)
    tracemalloc.start()
    forest.grow(rows, np.arange(n), np.ones(n), np.zeros(n, np.int64), 1, 3, 2, np.random.default_rng(1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * 20 * 8 * n / 10


def mixed(n, seed=2):
    """Two numbers, a factor, and flags that few rows have."""
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 7, n), rng.random(n) < 0.02, rng.integers(0, 900, n), np.where(rng.random(n) < 0.03, rng.integers(1, 5, n), 0)], 1)
    return x.astype(float), (rng.random(n) < 0.85 - 0.2 * x[:, 2]).astype(float)


@pytest.mark.parametrize("name, value", [("USUAL", 2.0), ("SHARE", 2.0), ("SHARE", 0.0), ("LEVEL_ROWS", 50), ("CELLS", 40)])
def test_the_same_trees_however_splits_are_searched(monkeypatch, name, value):
    x, y = mixed(3000)
    w = np.random.default_rng(5).integers(1, 4, 6000).astype(float)

    def trees():
        rows = forest.Rows(x, y)
        return forest.grow(rows, np.tile(np.arange(3000), 2), w, np.repeat([0, 1], 3000), 2, 3, 4, np.random.default_rng(1))

    want = trees()
    monkeypatch.setattr(forest, name, value)
    got = trees()
    assert len(want["feature"]) > 200 and set(want["feature"]) >= {-1, 0, 1, 2, 3, 4}
    for k, v in want.items():
        assert np.array_equal(got[k], v) if k != "importance" else got[k] == pytest.approx(v), k


def test_children_hold_the_rows_that_go_there():
    x, y = mixed(2000)
    tree = forest.grow(forest.Rows(x, y), np.arange(2000), np.ones(2000), np.zeros(2000, np.int64), 1, 2, 5, np.random.default_rng(1))
    leaf = np.array([_leaf(tree, r) for r in x])
    share = np.bincount(leaf, y, len(tree["value"])) / np.maximum(np.bincount(leaf, minlength=len(tree["value"])), 1)
    assert (tree["feature"][leaf] == -1).all() and share[leaf] == pytest.approx(tree["value"][leaf])


def test_only_borders_between_classes_are_scored(monkeypatch):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(4000, 1)), (rng.random(4000) < 0.85).astype(float)
    scored, plain = [], forest._improvement
    monkeypatch.setattr(forest, "_improvement", lambda le, *a: (scored.append(np.size(le)), plain(le, *a))[1])
    tree = forest.grow(forest.Rows(x, y), np.arange(4000), np.ones(4000), np.zeros(4000, np.int64), 1, 1, 3999, rng)
    assert len(tree["feature"]) == 3 and sum(scored) < 0.3 * 4000
    order = np.argsort(x[:, 0])
    n, e = np.arange(1, 4000), np.cumsum(y[order])[:-1]
    best = int(plain(e, n, y.sum(), 4000).argmax())
    assert x[order[best], 0] <= tree["threshold"][0] < x[order[best + 1], 0]


def test_a_task_for_every_block_of_trees(rows, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_TREES", 10)
    coded = forest.FactorOrder(rows, "label", "features").coded(rows.limit(300))
    trees = forest._local(coded, [forest.Spec(1, 5, 45), forest.Spec(3, 5, 40)], "label").withColumn("task", F.spark_partition_id()).cache()
    per = trees.groupBy("task").agg(F.sum("trees").alias("n"), F.first("candidate").alias("candidate")).orderBy("task").collect()
    assert [r["n"] for r in per] == [10, 10, 10, 10, 10, 10, 10, 10, 5] and [r["candidate"] for r in per] == [1] * 4 + [0] * 5
    monkeypatch.setattr(forest, "GROWN_ROWS", 700)  # two trees of 300 rows at a time
    assert forest._local(coded, [forest.Spec(1, 5, 7)], "label").agg(F.max("trees")).first()[0] == 2


def test_scores_do_not_depend_on_the_order_of_the_sums(rows):
    train, test = rows.where("id % 4 <> 0").limit(500).cache(), rows.where("id % 4 = 0").limit(200).cache()
    scored = forest.fit_score(train, [forest.Spec(2, 5, 64)], test).collect()  # 64 trees: the mean is exact too
    assert len(scored) == 200 and all((r["pred_event"] * 2 ** 46).is_integer() for r in scored)


def test_a_million_rows_of_fifteen_features_are_grown_whole():
    # their splits are exact; tops over the cluster, on a grid of quantiles, are for more
    assert 1_000_000 * 15 * 8 <= forest.LOCAL_BYTES
    assert forest.GROWN_ROWS < forest.PACK / 16  # sums of a group of trees stay exact
    with pytest.raises(ValueError, match="too many rows"):
        forest.grow(forest.Rows(np.zeros((2, 1)), np.array([0.0, 1.0])), np.arange(2), np.full(2, forest.PACK), np.zeros(2, np.int64), 1, 1, 1, np.random.default_rng(1))
