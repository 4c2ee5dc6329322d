import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P


def test_stages_and_contract():
    assert [n for n, _ in P.STAGES] == ["language ID", "quality classifier", "n-gram Jaccard join", "suffix-array dedup", "best-fit packing"]
    import __spark_entry__ as e
    assert "pipeline" in e.queries() and {k.split("_")[0] for k in e.queries() if k.startswith("op")} == {f"op{i}" for i in range(1, 14)}


@pytest.fixture(scope="module")
def steps(spark, docs, tmp_path_factory):
    """Every stage's input and output on the small documents."""
    folder = tmp_path_factory.mktemp("stages")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 14)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    out, now = [], docs
    for k, (_, stage) in enumerate(P.STAGES):
        made = stage(spark, now, str(folder))
        made.write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out.append((now, after))
        now = after
    return out


def test_columns_stay(steps, docs):
    for before, after in steps[:-1]:
        assert after.columns == docs.columns and after.count() <= before.count()


def test_texts_without_letters_go(steps):
    before, after = (x.collect() for x in steps[0])
    kept = [r.text for r in after]
    assert all(any(c.isalpha() for c in t or "") for t in kept)
    assert {r.doc_id for r in before if r.text and r.text.isascii() and len(r.text) > 400 and " " in r.text} <= {r.doc_id for r in after}


def test_one_of_each_group_stays(steps):
    from test_ngram_join import plain_links
    before, after = (x.collect() for x in steps[2])
    texts = [r.text for r in after if r.doc_id is not None]
    assert not any(plain_links(texts))
    assert len({r.doc_id for r in after}) == len(after)
    links = plain_links([r.text for r in before])
    alone = {r.doc_id for r, k in zip(before, links) if not k}
    assert alone <= {r.doc_id for r in after}


def test_repeated_passages_go(steps):
    from test_suffix_dedup import plain
    before, after = (x.collect() for x in steps[3])
    want = {r.doc_id: w[3] for r, w in zip(before, plain([(r.text or "").encode() for r in before]))}
    for r in after:
        if "�" not in r.text and hashlib.sha256(r.text.encode()).hexdigest() != want[r.doc_id]:
            assert not r.text.isascii()  # a character was cut: its rest is dropped


def test_all_that_is_left_is_packed(steps):
    before, after = (x.collect() for x in steps[4])
    assert {r.doc_id for r in before} == {r.doc_id for r in after}
    assert all(0 <= r.offset and r.offset + r.length <= 2048 for r in after)


def test_empty_table(spark, nothing, tmp_path):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = nothing
    for k, (_, stage) in enumerate(P.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
    assert now.count() == 0


def test_rows_are_judged_by_text_and_not_by_id(spark, tmp_path):
    import random

    from conftest import words
    rng = random.Random(8)
    t = [words(rng, 80) for _ in range(8)]
    near = t[0].replace(t[0].split(" ")[40], "changed", 1)
    kept = [(None, t[1]), (None, t[2]), (5, t[3]), (6, t[4]), (6, t[5]), (7, t[0])]
    gone = [(None, ""), (None, None), (5, ""), (8, near), (None, near), (None, t[0]), (None, t[1]), (5, t[3])]
    docs = spark.createDataFrame([(i, x, "en", k) for k, (i, x) in enumerate(kept + gone)], "doc_id bigint, text string, lang string, k int")
    spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    usual = P.keep_usual_text(spark, docs, str(tmp_path))
    # without a trusted text kept apart nothing but empty texts goes for certain
    assert {(None, ""), (None, None), (5, "")}.isdisjoint({(r.doc_id, r.text) for r in usual.collect()})
    full = docs.where("length(text) > 0")
    single = [(r.doc_id, r.text) for r in P.keep_one_of_each_group(spark, full, str(tmp_path)).collect()]
    assert sorted(single, key=str) == sorted(kept, key=str)
    one = spark.createDataFrame([(None, t[1], "en"), (None, "", "en"), (5, t[3], "en"), (5, "", "en")], "doc_id bigint, text string, lang string")
    assert sorted([(r.doc_id, r.text) for r in P.keep_usual_text(spark, one.unionByName(one.limit(0)), str(tmp_path)).collect()], key=str) == sorted(
        [(None, t[1]), (5, t[3])], key=str)


STRANGE = ("Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Quanto a dir qual era e cosa dura "
           "questa selva selvaggia e aspra e forte che nel pensier rinova la paura",
           "Kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu jarki ja omatunto, ja heidan on toimittava "
           "toisiaan kohtaan veljeyden hengessa.",
           "Wszyscy ludzie rodza sie wolni i rowni w swojej godnosci i prawach. Sa oni obdarzeni rozumem i sumieniem i powinni postepowac wobec innych "
           "w duchu braterstwa.",
           " ".join(hashlib.sha256(str(k).encode()).hexdigest() for k in range(8)))


def test_unlearned_languages_go_and_clean_held_out_texts_stay(spark, sf_dir):
    from pyspark.sql import functions as F

    from tessera.llm.cross_parsing import held_out
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    strange = spark.createDataFrame([(-1 - k, t) for k, t in enumerate(STRANGE)], "doc_id bigint, text string")
    got = {r.doc_id for r in P.keep_known_languages(spark, docs.unionByName(strange, allowMissingColumns=True), folder).collect()}
    assert not {i for i in got if i < 0}
    clean = docs.join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi").where(held_out() & (F.length("text") > 0))
    assert {r.doc_id for r in clean.collect()} <= got


CLASHING = ["n_bytes", "n_removed", "spans", "kept_sha256", "_key", "_z", "_block", "_null", "_first", "_id", "_digest", "_text", "_k", "_score", "_lang_pred",
            "_phrase_rate", "comp", "digest", "h", "key", "a.b"]


def test_columns_of_any_name_come_back(spark, docs, tmp_path):
    import corpus_pipeline
    spark.createDataFrame([(i, 1, 0) for i in range(14)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    d = base.select("*", *[F.lit(f"v{i}").alias(c) for i, c in enumerate(CLASHING)])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, str(tmp_path))
        assert out.columns == d.columns
        rows = out.select(*[f"`{c}`" for c in CLASHING]).distinct().collect()
        assert [tuple(r) for r in rows] == [tuple(f"v{i}" for i in range(len(CLASHING)))]
        assert out.count() == stage(spark, base, str(tmp_path)).count()
    assert corpus_pipeline.STAGES[-1][1](spark, d, str(tmp_path)).count()


def test_deduplicate_takes_any_column_name(spark, docs):
    from tessera.llm.suffix_dedup import deduplicate
    d = docs.select("doc_id", "text").select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])
    out = deduplicate(d)
    made = {"n_bytes", "n_removed", "spans", "kept_sha256"}
    assert set(out.columns) == set(d.columns) and out.count() == d.count()
    others = [c for c in CLASHING if c not in made]
    assert {tuple(r) for r in out.select(*[f"`{c}`" for c in others]).collect()} == {tuple(CLASHING.index(c) for c in others)}
    plain = {(r.doc_id, r.n_bytes, r.kept_sha256) for r in deduplicate(docs.select("doc_id", "text")).collect()}
    assert {(r.doc_id, r.n_bytes, r.kept_sha256) for r in out.collect()} == plain


def test_run_applies_all_stages(spark, sf_dir):
    import corpus_pipeline
    got = corpus_pipeline.run(spark, sf_dir).collect()
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, sf_dir)
    kept = {r.doc_id: r.text for r in d.collect()}
    assert {r.doc_id for r in got} == set(kept) and 0 < len(kept) < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    from tokenizers import Tokenizer

    from tessera.llm.queries import tokenizer_file
    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    length, places = {}, {}
    for r in got:
        length[r.doc_id] = length.get(r.doc_id, 0) + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert length == {i: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for i, x in kept.items()}
    for pieces in places.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
