import random
import zlib

import numpy as np
import pytest

from tessera.llm import cross_parsing
from tessera.llm.cross_parsing import SEPARATOR, Automata, _letters_only, identify, learn, predict


def test_phrases_equal_a_plain_greedy_parse():
    rng = random.Random(1)
    for _ in range(60):
        sample = "".join(rng.choices("ab c", k=rng.randint(1, 40))) + SEPARATOR + "".join(rng.choices("abd", k=10))
        model = Automata((("x", sample),))
        parts = [_one_space(p) for p in sample.split(SEPARATOR)]
        text = _one_space("".join(rng.choices("abcd ", k=rng.randint(1, 60))))
        if not any(c.isalpha() for c in text):
            continue
        phrases, at = 0, 0
        while at < len(text):
            k = 1
            while at + k < len(text) and any(text[at:at + k + 1] in p for p in parts):
                k += 1
            phrases, at = phrases + 1, at + k
        _, _, _, rate = model.classify([text])
        assert round(rate[0] * len(text)) == phrases, (sample, text)


def _one_space(t):
    out = ""
    for c in t:
        if c != " " or not out.endswith(" "):
            out += c
    return out


def _plain(text, sample):
    """Phrases of a greedy parse, by search."""
    parts = [_one_space(p) for p in sample.split(SEPARATOR)]
    phrases, at = 0, 0
    while at < len(text):
        k = 1
        while at + k < len(text) and any(text[at:at + k + 1] in p for p in parts):
            k += 1
        phrases, at = phrases + 1, at + k
    return phrases


def test_long_texts_are_parsed_whole():
    model = Automata((("x", "abc"), ("y", "xyz")))
    labels, cost, other, rate = model.classify(["abc" * 5000, "xyz", "", "...", "abcxyz"])
    assert labels[:2] == ["x", "y"] and labels[2:4] == ["und", "und"]
    score = cross_parsing._score(labels, cost, other)
    assert score[0] > 0 and score[2] == score[3] == 0
    assert labels[4] == "x"  # a tie goes to the first label
    assert rate[0] == 5000 / 15000


@pytest.mark.parametrize("segment", [1, 3, 16, 2048])
def test_segments_hand_their_state_on(monkeypatch, segment):
    # runs of one letter never bring a walk from the segment's start and the parse of the whole text together
    monkeypatch.setattr(cross_parsing, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(40):
        samples = [(label, rng.choice(["a" * rng.randint(1, 9), "".join(rng.choices("ab ", k=30)) + "x"])) for label in "pq"]
        model = Automata(tuple(samples))
        texts = [_one_space("".join(rng.choices("abx ", weights=[6, 2, 1, 1], k=rng.randint(0, 80)))) for _ in range(5)] + ["a" * 70]
        classes = [np.array([model.letter.get(c, model.width - 1) for c in t], np.int64) for t in texts]
        size = np.array([len(c) for c in classes])
        got = model.phrases(np.concatenate(classes), np.cumsum(size) - size, size)
        assert got.tolist() == [[_plain(t, _letters_only(s)) for t in texts] for _, s in samples]


def test_transitions_take_a_slot_each():
    # an alphabet of thousands of letters: a row of all letters for each state would be some 900 MB
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 3500)]
    text = "".join(rng.choices(letters, k=32_000))
    model = Automata((("zh", text), ("ja", text[::-1])))
    assert model.slots.nbytes + model.offset.nbytes < 8 << 20
    probe = text[100:140] + "".join(rng.choices(letters, k=60))
    assert model.classify([probe])[3][0] * len(probe) == min(_plain(probe, text), _plain(probe, text[::-1]))


def test_any_number_of_labels(spark, monkeypatch):
    rng = random.Random(4)
    sample = tuple((f"l{k:02d}", "".join(rng.choices("abcdefgh", k=60))) for k in range(7))
    rows = [(i, sample[i % 7][1][5:40] if i % 3 else "".join(rng.choices("abcdefgh ", k=50)), i, 1.0) for i in range(30)] + [(30, None, 0, 0.0), (31, "..", 0, 0.0)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, next_cost int, score double")
    whole = {r.doc_id: r for r in predict(docs, sample).collect()}
    monkeypatch.setattr(cross_parsing, "LABELS_AT_ONCE", 2)
    parts = predict(docs, sample)
    assert parts.columns == ["doc_id", "text", "next_cost", "lang_pred", "score", "phrase_rate"]
    got = {r.doc_id: r for r in parts.collect()}
    assert {i: r.lang_pred for i, r in got.items()} == {i: r.lang_pred for i, r in whole.items()}
    assert all(abs(got[i].phrase_rate - r.phrase_rate) < 1e-12 for i, r in whole.items())
    assert all(abs(got[i].score - r.score) < 1e-12 for i, r in whole.items())
    assert got[30].lang_pred == got[31].lang_pred == "und" and got[30].score == 0


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert out and all(got[i].held_out == (i in set(out)) for i in truth)
    assert sum(got[i].lang_pred == truth[i] for i in out) >= 0.97 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edges(docs, rows, nothing):
    got = identify(docs).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is not None and not any(c.isalpha() for c in texts[r.doc_id] or ""):
            assert r.lang_pred == "und" and r.score == 0
        else:
            assert r.lang_pred in ("de", "en")
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    assert identify(nothing).count() == 0 and learn(nothing) == ()
    assert {r.lang_pred for r in identify(docs.where("lang is null")).collect()} == {"und"}


def test_held_out_rows_teach_nothing(docs):
    from pyspark.sql import functions as F

    from tessera.llm.cross_parsing import held_out
    changed = docs.withColumn("lang", F.when(F.coalesce(held_out(), F.lit(True)), F.lit("zz")).otherwise(F.col("lang")))
    assert learn(changed) == learn(docs)


def test_copies_do_not_thin_the_sample(spark):
    from pyspark.sql import functions as F
    n, m = 40_000, 200
    text = F.concat_ws(" ", *[F.md5((F.col("id") % m * 100 + k).cast("string").cast("binary")) for k in range(4)])
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))
    (label, parts), = learn(docs)
    assert label == "en" and len(parts.split(SEPARATOR)) == 80
