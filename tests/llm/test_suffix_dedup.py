import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import suffix_dedup as S


def plain(texts, length=200):
    seen = Counter(b[i:i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((len(b), len(b) - len(kept), sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return out


def test_deep_shallow_sort_finds_equal_starts():
    rng = random.Random(1)
    for _ in range(60):
        unit = bytes(rng.choices(b"ab", k=rng.choice([1, 3, 30])))
        buf = b"".join(rng.choice([unit, bytes(rng.choices(b"abc", k=rng.randint(1, 60)))]) for _ in range(40))
        length = rng.choice([8, 40, 64])
        if len(buf) <= length:
            continue
        pos = np.arange(len(buf) - length + 1)
        count = Counter(buf[i:i + length] for i in pos)
        assert S.sort_equal(np.frombuffer(buf, np.uint8), pos, length, 16).tolist() == [count[buf[i:i + length]] > 1 for i in pos]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    part = bytes(rng.choices(b"abcdefgh ", k=400))
    a = bytes(rng.choices(b"abcdefgh ", k=150)) + part + bytes(rng.choices(b"abcdefgh ", k=90))
    b = part + bytes(rng.choices(b"abcdefgh ", k=30))
    buf, off = np.frombuffer(a + b, np.uint8), np.array([0, len(a), len(a) + len(b)])
    start, windows, h, _ = S.find_runs(buf, off)
    by = {}
    for s, n, x in zip(start.tolist(), windows.tolist(), h.tolist()):
        for i in range(s, s + n):
            by[i] = x
    assert set(by) == {*range(len(a) - 199), *range(len(a), len(a) + len(b) - 199)}
    for i in range(201):
        assert by[150 + i] == by[len(a) + i]


@pytest.mark.parametrize("hot", [20_000, 1])
def test_documents(docs, rows, nothing, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_RUNS", hot)  # 1: windows of shared anchors are counted by digest
    want = plain([(r[1] or "").encode() for r in rows])
    got = S.deduplicate(docs).collect()
    key = lambda i: (i is None, i or 0)
    have = sorted((*key(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got)
    assert have == sorted((*key(r[0]), *w) for r, w in zip(rows, want))
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        left, at = b"", 0
        for s in r.spans:
            left, at = left + raw[at:s.start], s.stop
        assert hashlib.sha256(left + raw[at:]).hexdigest() == r.kept_sha256
        assert r.text == (None if texts[r.doc_id] is None else (left + raw[at:]).decode("utf-8", "ignore"))
    assert set(got[0].asDict()) >= {"lang", "source", "key", "h", "slice"}
    assert S.deduplicate(nothing).count() == 0


def test_small_tables_against_brute_force(spark):
    rng = random.Random(7)
    for round_ in range(2):
        parts = ["".join(rng.choices("abcdef ", k=rng.choice([30, 150, 199, 200, 201, 260, 700]))) for _ in range(8)]
        texts = ["".join(rng.choice([*parts, "".join(rng.choices("xyz ", k=rng.randint(1, 300)))]) for _ in range(rng.randint(1, 5))) for _ in range(40)]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
        got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.deduplicate(df, digests_only=True).orderBy("doc_id").collect()]
        assert got == plain([t.encode() for t in texts])


def test_a_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 500)
    monkeypatch.setattr(S, "RUN_BYTES", 300)
    rng = random.Random(8)
    part = "".join(rng.choices("abcdef ", k=900))
    texts = ["".join(rng.choices("xyz ", k=700)) + part + "".join(rng.choices("xyz ", k=800)) + part[100:], part[50:400], "q" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.deduplicate(df, digests_only=True).orderBy("doc_id").collect()]
    assert got == plain([t.encode() for t in texts])
