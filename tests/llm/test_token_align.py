import hashlib
import random
from collections import Counter, defaultdict

import numpy as np

from tessera.llm.queries import tokenizer_file
from tessera.llm.token_align import ByteLevel, alignments, lockstep, summaries

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def encoded(texts):
    """Per text: ids of A and B with their byte ends, from the libraries alone; None without tokens."""
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = {}
    extra = 0
    for byte in range(256):  # the byte-level alphabet
        if 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255:
            letters[chr(byte)] = byte
        else:
            letters[chr(256 + extra)] = byte
            extra += 1
    for t in texts:
        if not t:
            yield None
            continue
        x = a.encode(" " + t, add_special_tokens=False).ids
        y = b.encode(t)
        xs = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        ys = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        raw = (" " + t).encode()
        yield (x, y, np.cumsum([len(v) for v in xs]), np.cumsum([len(v) for v in ys])) if b"".join(xs) == raw == b"".join(ys) else None


def brute(ids, texts):
    docs, counts = [], Counter()
    for e in encoded(texts):
        if e is None:
            docs.append(None)
            continue
        x, y, ex, ey = e
        links = [(x[i], y[j]) for i in range(len(x)) for j in np.flatnonzero(ey == ex[i])]
        counts.update(links)
        groups, lo_a, lo_b = [], 0, 0
        for i, at in enumerate(ex):
            for j in np.flatnonzero(ey == at):
                groups.append(",".join(map(str, x[lo_a:i + 1])) + "|" + ",".join(map(str, y[lo_b:j + 1])))
                lo_a, lo_b = i + 1, j + 1
        docs.append((len(x), len(y), groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, d in zip(ids, docs):
        if d is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, d[0], d[1], len(d[2]), len(d[3]), sum(counts[p] == best[p[1]] for p in d[3]), sum(counts[p] for p in d[3]),
                        hashlib.sha256(";".join(d[2]).encode()).hexdigest()))
    return Counter(out)


def result(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def odd_texts():
    rng = random.Random(9)
    parts = [" ", "  ", "a", "the ", "é", "漢字", "😀", "123", "\n", "\t", "<s>", "<|endoftext|>", "<0x0A>", "▁", "...", "'s", "\0", "　", "tion"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(300)]


def test_equal_to_brute_force(spark, rows, docs):
    assert result(summaries(docs, A, B)) == brute([r[0] for r in rows], [r[1] for r in rows])


def test_odd_texts(spark):
    texts = odd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(4)
    got = result(summaries(df, A, B))
    assert got == brute(range(len(texts)), texts)
    assert any(r[1] == 0 for r in got) and any(r[3] != r[1] for r in got)


def test_lockstep_on_lanes_of_any_size():
    rng = random.Random(1)
    sizes = [rng.randint(1, 400) for _ in range(20)]
    offsets = np.concatenate([[0], np.cumsum(sizes)])

    def cuts():
        return np.array(sorted({x for lo, hi in zip(offsets[:-1], offsets[1:]) for x in [hi, *(rng.randint(lo + 1, hi) for _ in range(hi - lo))]}))

    a, b = cuts(), cuts()
    both = sorted(set(a) & set(b))
    for lane in (1, 3, 64, 10_000):
        x, y = lockstep(a, b, offsets, lane)
        assert a[x].tolist() == b[y].tolist() == both
    assert len(lockstep(a[:0], b[:0], offsets[:1])[0]) == 0


def test_links_and_groups_of_a_text(spark):
    r = alignments(spark.createDataFrame([(1, "tokenizers disagree"), (2, None)], "doc_id int, text string"), A, B).orderBy("doc_id").collect()
    x, y, ex, ey = next(encoded(["tokenizers disagree"]))
    assert (r[0].a_ids, r[0].b_ids) == (x, y)
    assert [(int(ex[i]), int(ey[j])) for i, j in zip(r[0].a_linked, r[0].b_linked)] == [(v, v) for v in sorted(set(ex.tolist()) & set(ey.tolist()))]
    assert r[1].a_ids == [] and r[1].b_linked == []


def test_special_strings_are_text_and_fast_equals_library():
    t = ByteLevel(A)
    for s in [*odd_texts(), "a <|endoftext|> b", "x" * 300]:
        assert t.fast.encode_to_numpy(" " + s).tolist() == t.library.encode(" " + s, add_special_tokens=False).ids


def test_empty_table(nothing):
    assert summaries(nothing, A, B).count() == 0 and alignments(nothing, A, B).count() == 0
