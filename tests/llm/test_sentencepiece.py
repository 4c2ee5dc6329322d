import hashlib
import random

import numpy as np
import pytest

from tessera.llm.queries import tokenizer_file
from tessera.llm.sentencepiece_codec import codec, digests, encode_decode

PATH = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_encoding_equals_the_library_on_odd_strings(library):
    rng = random.Random(1)
    parts = ["▁", " ", "  ", "a", "b", "th", "e", "\n", "\t", "é", "漢", "😀", "0", "<s>", "<0x0A>", "</s>", "​", "...", "    ", "ing", "\0"]
    for _ in range(3000):
        s = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        ids = library.encode(s, add_bos=True, add_eos=True)
        assert codec(PATH).encode(s) == ids
        assert codec(PATH).decode(ids) == library.decode(ids)


def test_decoding_equals_the_library_on_any_ids(library):
    rng = random.Random(2)
    for _ in range(3000):
        ids = rng.choices([*range(262), 306, 29871, 400], k=rng.randint(0, 12))
        assert codec(PATH).decode(ids) == library.decode(ids)


def test_a_word_that_needs_backtracking(library):
    c = codec(PATH)
    rng = random.Random(3)
    back = 0
    for _ in range(2000):
        s = "▁" + "".join(rng.choices("abcdeinorst", k=30))
        greedy, pos = [], 0
        while pos < len(s):
            t = next(s[pos:pos + k] for k in range(16, 0, -1) if s[pos:pos + k] in c.reachable)
            greedy.append(t)
            pos += len(t)
        back += greedy != c.tokens(s)
        assert [c.id[t] for t in c.tokens(s)] == library.encode(s[1:])
    assert back > 100


def test_documents(spark, docs, rows, nothing, library):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(docs, PATH).collect())
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i is None, i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    assert digests(nothing, PATH).count() == 0
    full = encode_decode(docs, PATH).where("doc_id = 0").first()
    assert full.decoded == rows[0][1] and len(full.ids) == 4 * full.n_tokens
