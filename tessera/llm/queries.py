"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _register(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; the executors have the same package installed."""
    import public_tokenizers
    return public_tokenizers.path(name)


@_register
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the ids and of the decoded text of every document."""
    from tessera.llm.sentencepiece_codec import digests
    return digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@_register
def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2,048 tokens."""
    from tessera.llm.best_fit_pack import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@_register
def op5_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    from tessera.llm.cross_parsing import identify
    return identify(table(spark, sf_dir, "documents"))


@_register
def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    from tessera.llm.multiset_hash import compare_edited
    return compare_edited(table(spark, sf_dir, "documents"))


@_register
def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it stays."""
    from tessera.llm.kneser_ney import classify
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_register
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and duplicate class of every document at a similarity of 0.8 on five-word runs."""
    from tessera.llm.ngram_join import link_counts
    return link_counts(table(spark, sf_dir, "documents"))


@_register
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that occur again."""
    from tessera.llm.suffix_dedup import deduplicate
    docs = table(spark, sf_dir, "documents")
    return deduplicate(docs, digests_only=True).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_register
def op1_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotations, linked to what it answers, in reply order."""
    from tessera.llm.quote_threads import reply_order
    return reply_order(table(spark, sf_dir, "conversations"))


@_register
def op8_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence of every document's entire text, and the licences its lines state."""
    from tessera.llm.license_digest import scan
    return scan(table(spark, sf_dir, "documents"))


@_register
def op13_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, the common lines it loses and whether it stays."""
    from tessera.llm.line_rules import judged
    return judged(table(spark, sf_dir, "documents"))


@_register
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, the lightest repair and the digest of the repaired text of every damaged conversation."""
    from tessera.llm.turn_repair import repaired_digests
    return repaired_digests(table(spark, sf_dir, "conversations"))


@_register
def op12_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two public vocabularies line up in every document."""
    from tessera.llm.token_align import summaries
    return summaries(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def _oracles() -> dict[str, str]:
    from tessera.llm import license_digest, line_rules
    return {"op8_license_digest": license_digest.oracle(), "op13_line_rules": line_rules.oracle()}


ORACLES |= _oracles()


@_register
def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and survivor of every vector at a cosine of 0.95."""
    from tessera.llm.cross_polytope import near_duplicates
    return near_duplicates(table(spark, sf_dir, "embeddings"))
