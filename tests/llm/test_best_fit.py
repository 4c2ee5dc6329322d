import bisect
import random
import zlib
from collections import Counter

import numpy as np

from tessera.llm.best_fit_pack import CapacityTree, cuts, pack, pack_documents, plan
from tessera.llm.queries import tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.json")


def brute(lengths, capacity):
    open_ = []
    n = 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(open_, x)
        if i == len(open_):
            n += 1
            bisect.insort(open_, capacity - x)
        else:
            bisect.insort(open_, open_.pop(i) - x)
    return n


def test_plan_equals_sequential_best_fit_decreasing():
    rng = random.Random(4)
    for _ in range(300):
        cap = rng.choice([10, 64, 2048])
        lengths = [rng.choice([rng.randint(1, cap), rng.randint(1, max(1, cap // 20)), cap // 2, cap]) for _ in range(rng.randint(0, 200))]
        runs = plan(dict(Counter(lengths)), cap)
        assert max((r[4] + -(-r[2] // r[3]) for r in runs), default=0) == brute(lengths, cap)
        placed = {}
        for length, first, n, each, seq, base in runs:
            for k in range(n):
                placed.setdefault(seq + k // each, []).append((base + k % each * length, length))
        for items in placed.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= cap
        assert Counter(length for items in placed.values() for _, length in items) == Counter(lengths)


def test_the_tree_finds_the_tightest():
    rng = random.Random(5)
    tree, have = CapacityTree(100), Counter()
    for _ in range(500):
        r = rng.randint(0, 100)
        if rng.random() < 0.6 or not have[r]:
            tree.add(r, 1)
            have[r] += 1
        else:
            tree.add(r, -1)
            have[r] -= 1
        need = rng.randint(1, 100)
        assert tree.tightest(need) == min((k for k, v in have.items() if v and k >= need), default=None)


def test_cuts():
    assert cuts(1, 4) == [(0, 1)]
    assert cuts(4, 4) == [(0, 4)]
    assert cuts(9, 4) == [(0, 1), (1, 5), (5, 9)]


def test_documents(docs, rows, nothing):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    got = pack_documents(docs, PATH).collect()
    want = Counter()
    for i, text, *_ in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k, (lo, hi) in enumerate(cuts(len(ids), 2048)):
            want[(i, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in by.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) == brute([r.length for r in got], 2048)
    assert pack_documents(nothing, PATH).count() == 0


def test_special_token_text_is_as_the_library_has_it(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    text = "a<|endoftext|>b"
    r = pack_documents(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), PATH).first()
    ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], "<u4")
    assert r.ids_crc32 == zlib.crc32(ids.tobytes())


def test_a_common_length_is_ranked_in_parts(spark, monkeypatch):
    import tessera.llm.best_fit_pack as m
    monkeypatch.setattr(m, "RANK_GROUP", 7)
    items = spark.createDataFrame([(i, 0, 0, 5, i) for i in range(100)], "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    got = pack(items, 16).collect()
    assert len(got) == 100 and len({r.sequence_id for r in got}) == 34
    assert len({(r.sequence_id, r.offset) for r in got}) == 100
