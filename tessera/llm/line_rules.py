"""Quality rules and cross-document line frequency, from DataFrame functions alone.

1. One pass over the texts takes the base counts of every document and, of each
   of its distinct normalised lines, a 64-bit hash with the words it holds.  The
   rows are stored: no later step reads a text.
2. The distinct (host, line, text) rows give the number of different documents of
   a host that hold a line.  Exact copies are one document, so that a page which
   was fetched twice does not make its own lines common.
3. Lines above the limit of their host are joined back.  A line may be in a third
   of all documents, so its rows are dealt by (host, line, salt).
4. The words that a document loses are summed by its row number; a document that
   keeps too little is rejected.

Word windows are hashed by doubling (words, pairs, fours, eights), so that a
window costs three steps and no copies of words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

SPACES = " \t\n\x0b\x0c\r"
INNER_SPACES = "[\\x20\\x09\\x0B-\\x0D]+"  # all of them but the line feed
SYMBOLS = "#*$%&|<>"
#: tasks that the rows of one common line are dealt to
SALTS = 32


@dataclass(frozen=True)
class Limits:
    """What a document is judged by."""

    #: fewer words, and a document fails
    min_words: int = 20
    #: per cent of words in repeated windows above which a document fails
    max_repeated: int = 30
    #: words of a window
    window: int = 8
    #: a line of a host is removed if more different documents than both of these hold it
    line_documents: int = 20
    line_share: float = 0.03
    #: a document is depleted when a smaller share of its words is left
    min_left: float = 0.5


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Maximal runs of characters that are not white space; a text without any has none."""
    inner = F.trim(text, F.lit(SPACES))
    return F.when(F.length(inner) == 0, F.array().cast("array<string>")).otherwise(F.split(inner, "[\\x20\\x09-\\x0D]+"))


def window_hashes(words: Column, size: int) -> Column:
    """A 64-bit hash of every window of ``size`` words (a power of two)."""
    if size & (size - 1):
        raise ValueError("windows are hashed by doubling: size must be a power of two")

    def with_later(hashes: Column, step: int) -> Column:
        return _let(hashes, lambda a: F.transform(a, lambda x, i: F.xxhash64(x, F.get(a, i + step))))

    out, step = F.transform(words, lambda w: F.xxhash64(w)), 1
    while step < size:
        out, step = with_later(out, step), 2 * step
    return _let(out, lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - (size - 1), F.lit(0))))


def repeated_words(hashes: Column, size: int) -> Column:
    """Words that lie in windows found at least twice; ``hashes`` holds the hash of each window in order."""
    def covered(found: Column) -> Column:
        # equal hashes lie side by side once sorted; the starts of those that have an equal are taken in order
        again = F.filter(found, lambda x, j: (F.get(found, j - 1)["h"] == x["h"]) | (F.get(found, j + 1)["h"] == x["h"]))
        starts = F.array_sort(F.transform(again, lambda x: x["i"]))
        return _let(starts, lambda s: F.aggregate(
            F.transform(s, lambda p, j: F.least(F.lit(size), F.coalesce(F.get(s, j + 1) - p, F.lit(size)))), F.lit(0), lambda a, x: a + x))

    def count(h: Column) -> Column:
        some = F.size(F.array_distinct(h)) < F.size(h)
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(some, _let(pairs, covered)).otherwise(0)

    return _let(hashes, count).cast("long")


def base_counts(text: Column, limits: Limits = Limits()) -> dict[str, Column]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a text that is not null."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0)
    words = words_of(text)
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long"),
        "n_repeat_words": repeated_words(window_hashes(words, limits.window), limits.window)}


def normalised(text: Column) -> Column:
    """Lower case, digits as zeros, runs of white space inside a line as one space."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[1-9]", "0"), INNER_SPACES, " ")


def _line_structs(text: Column) -> Column:
    """``(hash, words)`` of every line that holds a word."""
    lines = F.filter(F.transform(F.split(normalised(text), "\n", -1), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(lines, lambda x: F.struct(
        F.xxhash64(x).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).cast("long").alias("words")))


def measured(docs: DataFrame, host: str = "source", limits: Limits = Limits(), text: bool = False) -> DataFrame:
    """Base counts and lines of every document, stored; ``row`` numbers the rows.

    ``doc_id, host, digest, n_words, ..., lines`` and, if asked for, ``text``; other columns are ignored.
    """
    src = docs.select(docs["doc_id"], docs[host].cast("string").alias("host"),
                      F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    t = F.col("text")
    return materialize(src.select("doc_id", "host", F.xxhash64(t).alias("digest"),
                                  *[c.alias(k) for k, c in base_counts(t, limits).items()], _line_structs(t).alias("lines"),
                                  *([t] if text else []))
                       .withColumn("row", F.monotonically_increasing_id()))


def common_lines(rows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``host, line, n_documents`` of the lines above their host's limit, from :func:`measured` rows."""
    each = rows.select("host", "digest", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    held = each.groupBy("host", "line", "digest").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("n_documents"))
    total = (rows.groupBy("host", "digest").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("n_host"))
             .withColumnRenamed("host", "_host"))
    above = held.where(F.col("n_documents") > limits.line_documents)
    return (above.join(total, F.col("host").eqNullSafe(F.col("_host")))
            .where(F.col("n_documents") > F.lit(limits.line_share) * F.col("n_host")).select("host", "line", "n_documents"))


def judged(docs: DataFrame, host: str = "source", limits: Limits = Limits(), texts: bool = False) -> DataFrame:
    """Base counts, lines removed and the verdict of every document.

    Columns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_lines,
    n_removed_words, kept``; with ``texts`` also ``kept_text``, the text without the lines above the limits.
    A null text counts as empty and fails; a null host is a host of its own; repeated rows and null ids are judged
    row by row; other columns are ignored.
    """
    rows = measured(docs, host, limits, texts)
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    common = common_lines(rows, limits).select(F.col("host").alias("_host"), F.col("line").alias("_line"), salt.alias("_salt"))
    each = rows.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.words")
    hit = each.withColumn("salt", F.pmod(F.col("row"), F.lit(SALTS)).cast("int")).join(
        common, F.col("host").eqNullSafe(F.col("_host")) & (F.col("line") == F.col("_line")) & (F.col("salt") == F.col("_salt")))
    lost = hit.groupBy(F.col("row").alias("_row")).agg(
        F.count("*").alias("n_removed_lines"), F.sum("words").alias("n_removed_words"), F.collect_set("line").alias("_gone"))
    out = rows.join(lost, F.col("row") == F.col("_row"), "left")
    removed = F.coalesce("n_removed_words", F.lit(0))
    failed = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeated * F.col("n_words"))
    left = F.col("n_words") - removed
    kept = ~failed & (left >= F.lit(limits.min_left) * F.col("n_words"))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
            F.coalesce("n_removed_lines", F.lit(0)).alias("n_removed_lines"), removed.alias("n_removed_words"), kept.alias("kept")]
    if texts:
        gone = F.coalesce("_gone", F.array().cast("array<bigint>"))
        keep = F.filter(F.split("text", "\n", -1), lambda x: ~F.array_contains(gone, F.xxhash64(F.trim(normalised(x)))))
        cols.append(F.array_join(keep, "\n").alias("kept_text"))
    return out.select(*cols)


def oracle(limits: Limits = Limits()) -> str:
    """The same rows in DuckDB SQL, with lines and windows compared as strings."""
    size = limits.window
    window = " || chr(31) || ".join(["word"] + [f"lead(word, {k}) OVER w" for k in range(1, size)])
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
    words AS (SELECT rid, unnest(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS word,
                     generate_subscripts(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), 1) AS pos FROM d),
    windows AS (SELECT rid, pos, {window} AS win FROM words WINDOW w AS (PARTITION BY rid ORDER BY pos)),
    again AS (SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS n FROM windows WHERE win IS NOT NULL) WHERE n > 1),
    covered AS (SELECT rid, sum(least({size}, coalesce(nxt - pos, {size}))) AS n_repeat_words
                FROM (SELECT rid, pos, lead(pos) OVER (PARTITION BY rid ORDER BY pos) AS nxt FROM again) GROUP BY rid),
    counted AS (SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY rid),
    raw_lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
    dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM raw_lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
    norm AS (SELECT r.rid, host, text, trim(translate(regexp_replace(lower(line), '[\\x20\\x09\\x0B-\\x0D]+', ' ', 'g'), '123456789', '000000000')) AS line
             FROM raw_lines r JOIN d USING (rid)),
    lines AS (SELECT *, length(line) - length(replace(line, ' ', '')) + 1 AS n FROM norm WHERE line <> ''),
    hosts AS (SELECT host, count(DISTINCT text) AS n_host FROM d GROUP BY host),
    common AS (SELECT l.host, line FROM lines l JOIN hosts h ON l.host IS NOT DISTINCT FROM h.host
               GROUP BY l.host, line, n_host HAVING count(DISTINCT text) > {limits.line_documents} AND count(DISTINCT text) > {limits.line_share} * n_host),
    lost AS (SELECT rid, count(*) AS n_removed_lines, sum(n) AS n_removed_words
             FROM lines l JOIN common c ON l.host IS NOT DISTINCT FROM c.host AND l.line = c.line GROUP BY rid),
    all_counts AS (SELECT d.rid, doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
               length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_removed_lines, 0) AS n_removed_lines,
               coalesce(n_removed_words, 0) AS n_removed_words
        FROM d LEFT JOIN counted USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN lost USING (rid)),
    judged AS (SELECT *, n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeated} * n_words AS base_failed FROM all_counts)
    SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
           n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
           n_removed_lines::BIGINT AS n_removed_lines, n_removed_words::BIGINT AS n_removed_words,
           NOT base_failed AND n_words - n_removed_words >= {limits.min_left} * n_words AS kept
    FROM judged"""
