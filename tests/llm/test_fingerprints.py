import hashlib

from tessera.llm.multiset_hash import Fingerprint, compare_edited, fingerprint_documents


def test_paragraph_order_does_not_matter_and_paragraphs_come_and_go():
    a, b, c = "first paragraph of some words here", "second one", "the third paragraph has more words than five"
    full = Fingerprint("\n".join([a, b, c]))
    assert str(full) == str(Fingerprint("\n".join([c, a, b])))
    assert str(full) != str(Fingerprint("\n".join([a, b])))
    assert str(Fingerprint("\n".join([a, b])).insert(c)) == str(full)
    assert str(full.delete(b).delete(a)) == str(Fingerprint(c))
    assert str(full) != str(full.insert(a))  # a multiset, not a set


def test_likeness_follows_shared_words():
    import random
    rng = random.Random(9)
    w = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(2000)]
    x = Fingerprint(" ".join(w))
    assert x.likeness(Fingerprint(" ".join(w))) == 1
    assert x.likeness(Fingerprint(" ".join(w[:1900] + w[:100]))) > 0.75
    assert 0.15 < x.likeness(Fingerprint(" ".join(w[:1000] + ["".join(rng.choices("abc", k=9)) for _ in range(1000)]))) < 0.55
    assert x.likeness(Fingerprint(" ".join(reversed(w)))) < 0.15


def test_documents(docs, rows, nothing):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [r[1] or "" for r in order]
    for slices in (1, 3, 40):
        got = compare_edited(docs, slices).collect()
        assert len(got) == len(rows)
        got.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0))
        for i, r in enumerate(got):
            t, n = texts[i], texts[(i + 1) % len(texts)]
            k = len(t) // 2
            edited = t[:len(t) - k] + n[:k]
            assert r.doc_id == order[i][0] and r.n_chars == len(t)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.fingerprint == str(Fingerprint(t)) and r.edited_fingerprint == str(Fingerprint(edited))
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            assert (r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint)
    assert compare_edited(nothing).count() == 0
    assert fingerprint_documents(docs).count() == len(rows)


def test_one_row_is_its_own_successor(spark):
    r = compare_edited(spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1
