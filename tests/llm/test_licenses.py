import textwrap

from tessera.llm import license_digest as L


def test_entire_texts_in_many_dresses(spark, nothing):
    rows, want = [], {}
    for i, (name, t) in enumerate(L.KNOWN):
        dressed = "Copyright (c) 2020 Somebody\n(C) Other\n\n   " + t.upper().replace("LICENSE", "LICENCE").replace(" ", "  ") + "\n\n"
        rows += [(2 * i, dressed), (2 * i + 1, t + " and more")]
        want[2 * i], want[2 * i + 1] = name, None
    rows += [(900, None), (901, ""), (902, " \n"), (903, "x" * 100_000), (None, L.KNOWN[0][1]), (0, rows[0][1])]
    got = L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.license == "MIT"
        elif r.doc_id >= 900:
            assert r.license is None and r.notices == ""
        else:
            assert r.license == want[r.doc_id]
    assert L.scan(nothing).count() == 0


def test_notices_in_lines(spark):
    text = "Some prose here.\n  * licensed under CC BY-NC 4.0! \nReleased under the MIT Licence\nlicensed under cc by nc 4.0"
    r = L.scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert r.license is None and r.notices == "CC-BY-NC-4.0,MIT"


def test_spark_and_driver_have_one_canonical_form(spark):
    from pyspark.sql import functions as F
    texts = [t for _, t in L.KNOWN] + ["The Licence, whilst sub-licence\n© 2001 x\nper cent  Über_all", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(F.translate(L.canonical_lines(F.col("text")), "\n", " ")).collect()]
    assert got == [L.canonical_text(t) for t in texts]


def test_given_table_is_joined_and_clashing_columns_are_ignored(spark, docs, rows):
    known = spark.createDataFrame([(L.hashlib.sha256(L.canonical_text("one").encode()).hexdigest(), "X")], "digest string, license string")
    got = L.scan(docs.withColumnsRenamed({"key": "license", "node": "digest"}), known).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if r.license == "X"} == {r[0] for r in rows if r[1] == "one"}


NOTICES = ("Copyright (c) 2020 Somebody", "  * COPYRIGHT 1999-2021, Other", "© 2020 X", "Copyright © X", "Copyright by Y", "Copyright The Foo Authors",
           "Copyright [yyyy] [name of copyright owner]", "(C) Other", "All rights reserved.")


def test_line_breaks_and_notices_do_not_matter(spark):
    rows, want = [], {}
    for name, t in L.KNOWN:
        for width in (60, 72, 78, 80, 1 << 20):
            wrapped = textwrap.fill(t, width, break_long_words=False)
            for text in (wrapped, "\n".join(NOTICES) + "\n\n" + wrapped):
                want[len(rows)] = name
                rows.append((len(rows), text))
    # every word at a line start
    for name, t in L.KNOWN:
        want[len(rows)] = name
        rows.append((len(rows), "\n".join(t.split())))
    got = L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [(rows[r.doc_id][1], r.license) for r in got if r.license != want[r.doc_id]] == []
    assert all(L.canonical_text(t) == L.canonical_text(textwrap.fill(t, 1 << 20)) for _, t in L.KNOWN)


def test_built_in_table_moves_no_rows(spark, docs):
    """Digests are looked up where a text is read: no shuffle, no Python; the rows are those of the join with the same table."""
    notice = "prose\nReleased under the MIT License.\nLicensed under CC BY 4.0.\nReleased under the MIT Licence!"
    extra = spark.createDataFrame([(70, notice), (70, notice), (None, notice), (71, L.KNOWN[0][1]), (72, "")], "doc_id bigint, text string")
    every = docs.select("doc_id", "text").union(extra)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(L.scan(every)) == key(L.scan(every, L.known_licenses(spark)))
    plan = L.scan(spark.range(100).selectExpr("id AS doc_id", "string(id) AS text"))._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Exchange", "Aggregate", "Join", "Generate", "Python", "ExistingRDD") if x in plan]
