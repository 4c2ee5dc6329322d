import math
import random
import zlib
from collections import Counter

import pytest

from tessera.llm import kneser_ney as K

N = K.ORDER


def grams(text):
    b = b"\0" * (N - 1) + text.replace(b"\0", b"\1")
    return [b[i:i + N] for i in range(len(b) - N + 1)]


class Plain:
    """The same model, written as the textbook formula over dictionaries."""

    def __init__(self, texts):
        self.c = {N: Counter(g for t in texts for g in grams(t))}
        for k in range(N - 1, 0, -1):
            self.c[k] = Counter(g[1:] for g in self.c[k + 1])
        self.d, self.tot, self.by = {}, {}, {}
        for k, c in self.c.items():
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
            self.d[k] = [min(i, max(0.05, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] else 0.5 * i for i in (1, 2, 3)]
            self.tot[k], self.by[k] = Counter(), Counter()
            for g, x in c.items():
                self.tot[k][g[:-1]] += x
                self.by[k][g[:-1]] += self.d[k][min(x, 3) - 1]

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / 256
        h = g[:-1]
        low = self.p(g[1:])
        if not self.tot[k][h]:
            return low
        x = self.c[k][g]
        own = max(x - self.d[k][min(x, 3) - 1], 0) if x else 0
        return own / self.tot[k][h] + self.by[k][h] / self.tot[k][h] * low

    def perplexity(self, text):
        gs = grams(text)
        return math.exp(-sum(math.log(self.p(g)) for g in gs) / len(gs))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1 if i % 3 else 0, 1 if i == 4 else 0) for i in range(0, 24)] + [(None, 1, 0), (2, 1, None)],
                                 "doc_id bigint, quality int, toxic int")


def test_perplexity_equals_the_plain_formula(docs, rows, labels):
    trusted = {i for i in range(24) if i % 3 and i != 4}
    texts = [(r[1] or "").encode() for r in rows if r[0] in trusted]
    model = Plain([t for t in texts if not K._apart(t)])
    assert sum(model.p(b"axbc" + bytes([x])) for x in range(256)) == pytest.approx(1)
    got = K.perplexities(docs, labels).collect()
    assert len(got) == len(rows)
    want = {r[0]: r[1] for r in rows}
    for r in got:
        t = (want[r.doc_id] or "").encode()
        assert r.n_bytes == len(t) and r.trusted == (r.doc_id in trusted)
        assert (r.perplexity is None) if not t else r.perplexity == pytest.approx(model.perplexity(t), rel=1e-5)


def test_decisions(docs, rows, labels, nothing):
    got = K.classify(docs, labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.keep == (r.n_bytes > 0 and (r.perplexity is None or r.threshold is None or r.perplexity <= r.threshold))
    assert K.classify(nothing, labels).count() == 0
    blind = K.classify(docs, labels.limit(0)).collect()  # nobody to trust: nothing can be judged
    assert all(r.keep == (r.n_bytes > 0) and r.perplexity is None for r in blind)


def test_scoring_in_many_steps_and_shards(docs, labels, monkeypatch):
    a = {(r.doc_id, r.n_bytes): r.perplexity for r in K.perplexities(docs, labels).collect()}
    monkeypatch.setattr(K, "STEP", 100)
    monkeypatch.setattr(K, "SHARD_GRAMS", 10)
    _, texts = None, [b"abcabc", b"", b"xyz" * 50]
    assert [list(x) for x in (K._distinct(texts),)] == [sorted({int.from_bytes(g, "big") for t in texts for g in grams(t)})]
    b = {(r.doc_id, r.n_bytes): r.perplexity for r in K.perplexities(docs, labels).collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a if a[k] is not None)


def test_junk_goes_and_clean_text_stays(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in K.classify(docs, labels).collect()}
    truth = [(r.quality, got[r.doc_id]) for r in labels.where("toxic = 0").collect() if r.doc_id in got]
    good = [r.keep for q, r in truth if q == 1]
    bad = [r.keep for q, r in truth if q == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_copies_of_a_text_are_on_one_side():
    assert K._apart(b"abc") == (zlib.crc32(b"abc") % K.FOLDS == 0)
    assert 100 < sum(K._apart(bytes([random.Random(i).randrange(256) for _ in range(8)])) for i in range(1000)) < 300


def test_threshold_is_the_quantile_alone(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    held = {r.doc_id for r in labels.collect() if zlib.crc32(f"h{r.doc_id}".encode()) % 5 == 0}
    rest = labels.where(~labels["doc_id"].isin(held))
    apart, cut = {}, {}
    for r in K.perplexities(docs, rest).where("apart and perplexity is not null").collect():
        apart.setdefault(r.lang, []).append(r.perplexity)
    got = {r.doc_id: r for r in K.classify(docs, rest).collect()}
    for r in got.values():
        cut[r.lang] = r.threshold
    assert all(cut[x] <= max(v) + 1e-9 for x, v in apart.items())
    truth = [(r.quality, got[r.doc_id].keep) for r in labels.where("toxic = 0").collect() if r.doc_id in got and r.doc_id in held]
    good, bad = [k for q, k in truth if q == 1], [k for q, k in truth if q == 0]
    assert good and bad and sum(good) >= 0.95 * len(good) and sum(bad) <= 0.25 * len(bad)
