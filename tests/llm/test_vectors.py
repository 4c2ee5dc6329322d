import numpy as np

from tessera.llm.cross_polytope import buckets, hadamard, hashes_for, near_duplicates, tables_for


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = hadamard(x)
    assert np.allclose((x * x).sum(1), (y * y).sum(1)) and np.allclose(hadamard(y), x)


def test_tables_reach_the_recall():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    b = 0.95 * a + np.sqrt(1 - 0.95 ** 2) * o
    for k in (1, 2, 3):
        t = tables_for(64, k, 3, 0.95, 0.9999)
        x, y = buckets(a, t, k, 3), buckets(b, t, k, 3)
        assert (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean() >= 0.998
    assert hashes_for(10, 64) == 1 and hashes_for(10 ** 6, 64) == 3


def test_against_brute_force(spark, monkeypatch):
    import tessera.llm.cross_polytope as m
    monkeypatch.setattr(m, "BLOCK", 16)  # large buckets are cut
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 20))
    x[200:260] = x[5] + 0.1 * rng.normal(size=(60, 20))
    x[260:270] = x[6]
    x[270:280] = x[7] * 3
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]
    bad = [(400, None, 0), (401, [0.0] * 20, 0), (402, [None] + [1.0] * 19, 0), (403, [float("nan")] * 20, 0), (404, [float("inf")] * 20, 0), (405, [], 0)]
    rows += bad + [(500, [1.0, 2.0], 1), (501, [2.0, 4.0], 2), (None, rows[6][1], 0), (6, rows[6][1], 0)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows], "vec_id bigint, embedding array<float>, label int, node string, dim int")
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    good = [i for i, r in enumerate(rows) if r not in bad]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in good}
    links = {i: {j for j in good if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.95} for i in good}
    want = []
    for i, (vid, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        low = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        want.append((vid is None, vid or 0, len(links.get(i, ())), low, vid == low))
    assert sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in got) == sorted(want)
    assert near_duplicates(df.limit(0)).count() == 0


def test_very_long_and_very_short_vectors(spark):
    from tessera.llm.cross_polytope import near_duplicates
    rows = [(0, [1e200, 1e200]), (1, [2e200, 2e200]), (2, [1e-200, 1e-200]), (3, [0.1, 0.2]), (4, [1e-310, 2e-310])]
    got = {r.vec_id: (r.component_id, r.n_links) for r in near_duplicates(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).collect()}
    assert got == {0: (0, 2), 1: (0, 2), 2: (0, 2), 3: (3, 1), 4: (3, 1)}
