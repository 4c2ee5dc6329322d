import random
import re
from collections import Counter, defaultdict

from tessera.llm.line_rules import SALTS, Limits, judged, measured

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LIMITS = Limits(min_words=8, line_documents=2, line_share=0.1, min_left=0.8)


def norm(line):
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", re.sub("[1-9]", "0", line.lower())).strip(" ")


def brute(rows, limits):
    """rows: (doc_id, host, text); the same verdicts from plain Python."""
    texts, holders = defaultdict(set), defaultdict(set)
    for _, host, t in rows:
        t = t or ""
        texts[host].add(t)
        for line in t.split("\n"):
            holders[host, norm(line)].add(t)
    out = []
    for i, host, t in rows:
        t = t or ""
        words = WORD.findall(t)
        seen = defaultdict(list)
        for k in range(len(words) - limits.window + 1):
            seen[tuple(words[k:k + limits.window])].append(k)
        covered = {k + j for at in seen.values() if len(at) > 1 for k in at for j in range(limits.window)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        gone = [x for x in lines if len(holders[host, norm(x)]) > max(limits.line_documents, limits.line_share * len(texts[host]))]
        lost = sum(len(norm(x).split(" ")) for x in gone)
        failed = len(words) < limits.min_words or 100 * len(covered) > limits.max_repeated * len(words)
        out.append((i, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
                    failed, len(gone), lost, not failed and len(words) - lost >= limits.min_left * len(words)))
    return Counter(out)


def columns(df):
    return Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
                    r.n_removed_lines, r.n_removed_words, r.kept) for r in df.collect())


def planted():
    rng = random.Random(5)

    def line(n):
        return " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n))

    common = ["Home | About  | Contact 2024", "share this page <now>", "x"]
    rows = []
    for i in range(120):
        lines = [line(rng.randint(3, 30)) for _ in range(rng.randint(0, 4))] + rng.sample(common, rng.randint(0, 3))
        rng.shuffle(lines)
        rows.append((i, rng.choice(["hot", "hot", "a", None]), "\n".join(lines).replace("2024", str(rng.randint(1000, 9999)))))
    page = line(25)
    rows += [(200 + i, "hot", page) for i in range(30)]  # exact copies: no line becomes common
    rows += [(300, "a", " ".join(["one two three four five six seven eight nine"] * 6)), (301, "a", "a b c\n \n\na b c\r\na  b c\t")]
    return rows


def test_equal_to_brute_force(spark, rows):
    mixed = planted() + [(r[0], r[3], r[1]) for r in rows]
    df = spark.createDataFrame(mixed, "doc_id bigint, source string, text string").repartition(5)
    want = brute(mixed, LIMITS)
    assert columns(judged(df, limits=LIMITS)) == want
    assert any(r[7] for r in want) and any(not r[6] and not r[9] for r in want)


def test_kept_text_loses_the_common_lines_alone(spark):
    mixed = planted()
    df = spark.createDataFrame(mixed, "doc_id bigint, source string, text string").repartition(3)
    holders, texts = defaultdict(set), defaultdict(set)
    for _, host, t in mixed:
        texts[host].add(t)
        for x in t.split("\n"):
            holders[host, norm(x)].add(t)
    for r in judged(df, limits=LIMITS, texts=True).select("doc_id", "kept_text").collect():
        _, host, t = next(x for x in mixed if x[0] == r.doc_id)
        lines = [x for x in t.split("\n") if not norm(x)
                 or len(holders[host, norm(x)]) <= max(LIMITS.line_documents, LIMITS.line_share * len(texts[host]))]
        assert r.kept_text == "\n".join(lines)


def test_copies_are_one_document(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(i, "s", text) for i in range(100)], "doc_id bigint, source string, text string")
    assert judged(df, limits=LIMITS).where("kept").count() == 100


def test_empty_table_and_clashing_columns(spark, nothing):
    assert judged(nothing).count() == 0
    df = spark.createDataFrame([(1, "s", "a b", 1, 2, 3, 4, "x")],
                               "doc_id bigint, source string, text string, line int, row int, host int, words int, digest string")
    assert judged(df).first().n_words == 2


def test_one_scan_of_the_texts_and_native(spark, docs):
    df = judged(docs)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "Window" not in plan
    assert SALTS > 1 and measured(docs).count() == docs.count()
