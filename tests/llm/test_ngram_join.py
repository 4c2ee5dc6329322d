import re

import numpy as np
import pytest

from tessera.llm import ngram_join as J


def plain_sets(texts):
    out = []
    for t in texts:
        w = [x for x in re.split(rb"[\x00-\x20]+", (t or "").encode()) if x]
        out.append(frozenset(b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def plain_links(texts, threshold=0.8):
    sets = plain_sets(texts)
    links = [set() for _ in sets]
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= threshold * len(a | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    return links


def reach(links, ids):
    out = []
    for i in range(len(ids)):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        named = [ids[k] for k in seen if ids[k] is not None]
        out.append(min(named) if named else None)
    return out


def test_bands_reach_the_recall():
    for threshold in (0.5, 0.7, 0.8, 0.9):
        bands, rows = J.banding(threshold, 0.999)
        assert bands * rows <= 128 and 1 - (1 - threshold ** rows) ** bands >= 0.999


@pytest.mark.parametrize("block", [200_000, 60])
def test_documents(docs, rows, nothing, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK_GRAMS", block)  # the small one cuts every family into blocks
    got = J.link_counts(docs).collect()
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    links = plain_links(texts)
    comp = reach(links, ids)
    want = sorted((i is None, i or 0, len(k), c if c is not None else -1) for i, k, c in zip(ids, links, comp))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_links, r.class_id if r.class_id is not None else -1) for r in got) == want
    assert J.link_counts(nothing).count() == 0


def test_a_large_family_of_different_texts(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_GRAMS", 3000)
    import random
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(120)]
    texts = []
    for k in range(150):
        w = list(base)
        w[rng.randrange(120)] = f"new{k}"
        texts.append(" ".join(w))
    links = plain_links(texts)
    got = sorted(J.link_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect())
    assert [r.n_links for r in got] == [len(k) for k in links]
    assert [r.class_id for r in got] == reach(links, list(range(150)))


def test_intersections():
    rng = np.random.default_rng(0)
    a = [np.unique(rng.integers(0, 50, 20)).astype(np.uint64) for _ in range(7)]
    b = [np.unique(rng.integers(0, 50, 30)).astype(np.uint64) for _ in range(5)] + [np.zeros(0, np.uint64)]
    assert J._common(a, b).tolist() == [[len(np.intersect1d(x, y)) for y in b] for x in a]


def test_components(spark):
    from tessera.llm.common import components
    import random
    rng = random.Random(1)
    edges = [(str(1000 + rng.randrange(400)), str(1000 + rng.randrange(400))) for _ in range(330)] + [(str(2000 + i), str(2001 + i)) for i in range(60)]
    links = {}
    for a, b in edges:
        links.setdefault(a, set()).add(b)
        links.setdefault(b, set()).add(a)
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    for n in links:
        if links[n] == {n}:
            continue
        seen, todo = {n}, [n]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert got[n] == min(seen)
