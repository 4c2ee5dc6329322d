"""A training-text pipeline over ``documents``: five stages, each one operator of ``tessera.llm``.

Language ID drops documents that no learned language explains, the quality
model drops documents of unusual perplexity, the n-gram join keeps one document
of each group of near copies, suffix deduplication removes repeated passages,
and packing places the rest into training sequences.  Each stage's rows are
written as Parquet and read again as the next stage's input.

Stages handle null ids, repeated rows, null and empty texts, empty tables and
further columns of any name as their operators state.  Rows are kept or dropped by id and
text, so a row does not share the fate of another text of its id, or of all null
ids.  All stages but the last return the columns they were given.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, ship
from tessera.llm.queries import tokenizer_file
from tessera.session import ensure_checkpoint_dir

#: columns of ``documents``; any other is carried along
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: phrases a letter above which no learned language explains a text (two letters a phrase), where nothing better is known
MOST_PHRASES = 0.5
#: held-out documents that a label's own cut needs; with fewer, those of all labels give one
REFERENCES = 20
#: where the cut lies between what a label's own texts need (0.99 quantile) and what texts need in the next best
#: language (median; of the two nearest languages, as one that was not learned can lie as near)
BETWEEN = 2 / 3
#: the first and the last phrase of a text are cut short by its ends
END_PHRASES = 2


def _apart(stage):
    """A stage that sees further columns under numbered names, so that no name clashes with one of its own; they come back as they were."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        further = [c for c in docs.columns if c not in COLUMNS]
        names = {f"further_{i}": c for i, c in enumerate(further)}
        inside = docs.select(*[c for c in docs.columns if c in COLUMNS], *[F.col(f"`{c}`").alias(k) for k, c in names.items()])
        out = stage(spark, inside, sf_dir).withColumnsRenamed(names)
        return out.select(*[f"`{c}`" for c in docs.columns])
    return run_stage


def _inner_rate(rate: str) -> Column:
    """Phrases a letter without the first and the last phrase."""
    letters = F.length(F.regexp_replace(F.col("text").cast("string"), r"[^\p{L}]+", " "))
    return F.greatest(F.col(rate) - F.lit(float(END_PHRASES)) / letters, F.lit(0.0))


def language_cuts(found: DataFrame, names: tuple[str, str, str]) -> tuple[dict[str, float], float]:
    """Highest phrase rate of each label, and of labels with too few references, from held-out documents of known label."""
    label, score, rate = names
    own = found.where((F.col(label) == F.col("lang")) & (F.col(score) < 1)).select(
        label, _inner_rate(rate).alias("own"), (F.col(rate) / (1 - F.col(score))).alias("other"))
    facts = [F.count("*").alias("n"), F.percentile_approx("own", 0.99, 10_000).alias("own"), F.percentile_approx("other", 0.5, 10_000).alias("other")]
    rows = own.rollup(label).agg(*facts).where(F.col("n") >= REFERENCES).collect()
    other = min((r["other"] for r in rows), default=0.0)
    cuts = {r[label]: min(MOST_PHRASES, r["own"] + BETWEEN * max(0.0, other - r["own"])) for r in rows}
    every = cuts.pop(None, MOST_PHRASES)
    return cuts, every


@_apart
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters that the best language parses in no more phrases than its own held-out documents need."""
    from tessera.llm.cross_parsing import UNDETERMINED, held_out, learn, predict
    ship(spark)
    names = ("_lang_pred", "_score", "_phrase_rate")
    # with nothing to learn from, no document can be judged
    sample = learn(docs)
    if not sample:
        return docs
    cuts, every = language_cuts(predict(docs.where(held_out()).select("text", "lang"), sample, names=names), names)
    cut = F.lit(every)
    if cuts:
        cut = F.coalesce(F.create_map(*[F.lit(x) for pair in sorted(cuts.items()) for x in pair])[F.col(names[0])], cut)
    found = predict(docs, sample, names=names)
    return found.where((F.col(names[0]) != UNDETERMINED) & (_inner_rate(names[2]) <= cut)).select(*docs.columns)


@_apart
def keep_usual_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is not above their language's threshold."""
    from tessera.llm.kneser_ney import classify
    from tessera.llm.ngram_join import text_digest
    ship(spark)
    scores = classify(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), by_text=True)
    # rows of one language and text are decided alike; the id only spreads copies
    gone = materialize(scores.where("not keep").select(
        F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), F.col("digest").alias("_digest")).distinct())
    same = (docs["doc_id"].eqNullSafe(gone["_id"]) & docs["lang"].cast("string").eqNullSafe(gone["_lang"])
            & (text_digest() == gone["_digest"]))
    return docs.join(gone, same, "left_anti")


@_apart
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every class of near copies: the one of the smallest id, null ids last; texts without words all stay."""
    from tessera.llm.ngram_join import link_counts, text_digest
    ship(spark)
    members = link_counts(docs, by_text=True).where("comp is not null")
    kinds = materialize(members.groupBy("comp", "doc_id", "digest").agg(F.count("*").alias("n")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("first")
    chosen = kinds.groupBy("comp").agg(first, F.sum("n").alias("rows")).where("rows > 1").drop("rows")
    marked = kinds.join(chosen, "comp")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest"))
    # of the others every row goes, of the first's repeated rows one stays
    marked = materialize(marked.withColumn("_first", is_first).where("not _first or n > 1").select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "_first"))
    keyed = docs.withColumn("_text", text_digest())
    same = keyed["doc_id"].eqNullSafe(marked["_id"]) & (keyed["_text"] == marked["_digest"])
    rest = keyed.join(marked, same, "left").where(F.coalesce("_first", F.lit(True)))
    if not marked.where("_first").limit(1).count():
        return rest.select(*docs.columns)
    hashed = [c for c in docs.columns if "map<" not in docs.schema[c].dataType.simpleString()]
    number = F.row_number().over(Window.partitionBy("_id", "_digest").orderBy(F.xxhash64(*hashed)))
    single = rest.where("_first").withColumn("_k", number).where("_k = 1")
    return single.select(*docs.columns).union(rest.where("_first is null").select(*docs.columns))


@_apart
def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages of 200 bytes that occur again; ``n_chars`` counts what is left."""
    from tessera.llm.suffix_dedup import deduplicate
    ship(spark)
    left = deduplicate(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing of every kept document; one row per piece."""
    from tessera.llm.best_fit_pack import pack_documents
    ship(spark)
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("language ID", keep_known_languages),
    ("quality classifier", keep_usual_text),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("suffix-array dedup", remove_repeated_passages),
    ("best-fit packing", pack),
]

#: suffix deduplication and model fitting have no SQL form; tests hold the stages against brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    shared = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{shared}/{k}")
            docs = spark.read.parquet(f"{shared}/{k}")
    return docs
