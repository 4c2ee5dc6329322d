"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model's units are the bytes of the text (UTF-8), its n-grams hold up to five
of them, packed into one integer.  All documents travel once, compressed, into
blocks of bounded size, where their labels meet them.  From there

* trusted documents give n-gram counts, summed by Spark; discounts, context
  totals, continuation counts and the interpolated probabilities of all orders
  are joins and aggregates over those counts;
* every block asks for the distinct n-grams of its documents.  Questions and
  model rows are dealt by a hash of the n-gram into shards and joined there;
  the answers return to the block, whose documents are then scored;
* a quantile of the trusted documents' perplexities, one for each language, is
  the threshold.

Nothing of the model passes the driver but the counts of counts (four per order).
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, mix64, shuffle_partitions, trimmed, trimmed_group

ORDER = 5
BLOCK_BYTES = 8 << 20
#: shards of the n-gram space: as many as hold this many 5-grams each (some 16 MB of model rows), and a few at least
SHARD_GRAMS = 1 << 19
LEAST_SHARDS = 32
#: blocks whose questions meet one copy of the model
BLOCKS_TOGETHER = 256
#: a document goes when its perplexity exceeds this quantile of its language's trusted text
QUANTILE = 0.99
#: one trusted document in so many is kept from the counts and sets the thresholds
FOLDS = 5
STEP = 1 << 19
_CONTEXT = 8  # tag of back-off weights; tags 1..5 are probabilities


def _tagged(tag: int, gram: Column) -> Column:
    return gram.bitwiseOR(F.lit(tag << 48))


# ---- n-grams of text, inside tasks ----

def _grams(texts: list[bytes]):
    """5-gram ending at every byte of the texts, and the text each belongs to; zero bytes stand before a text."""
    pad = b"\0" * (ORDER - 1)
    buf = np.frombuffer(pad + pad.join(t.replace(b"\0", b"\1") for t in texts) + pad, np.uint8).astype(np.int64)
    if len(buf) < ORDER:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    g = buf[:-(ORDER - 1)].copy()
    for k in range(1, ORDER):
        g <<= 8
        g |= buf[k:len(buf) - (ORDER - 1) + k]
    size = np.array([len(t) for t in texts], np.int64)
    at = np.cumsum(size + ORDER - 1) - size - (ORDER - 1)
    owner = np.repeat(np.arange(len(texts)), size)
    position = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(at, size)
    return g[position], owner


def _steps(texts: list[bytes]):
    """Index ranges holding about STEP bytes each."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= STEP or i - lo >= 1 << 18:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def _distinct(texts: list[bytes]) -> np.ndarray:
    parts = [np.unique(_grams(texts[lo:hi])[0]) for lo, hi in _steps(texts)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _questions(five: np.ndarray) -> dict[int, np.ndarray]:
    """Per tag, the sorted n-grams and contexts that scoring these 5-grams can need."""
    out = {}
    for k in range(ORDER, 0, -1):
        out[k] = five
        if k > 1:
            out[_CONTEXT + k] = np.unique(five >> 8)
            five = np.unique(five & ((1 << 8 * (k - 1)) - 1))
    return out


def _all_keys(questions: dict[int, np.ndarray]) -> np.ndarray:
    return np.concatenate([keys | (tag << 48) for tag, keys in sorted(questions.items())]) if questions else np.zeros(0, np.int64)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(keys.view(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _squeeze(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _log_probability(questions: dict[int, np.ndarray], answers: dict[int, np.ndarray]) -> np.ndarray:
    """Log probability of every distinct 5-gram: its own where it was seen, else backed off, order by order."""
    p = np.where(np.isnan(answers[1]), 1 / 256, answers[1])
    for k in range(2, ORDER + 1):
        grams = questions[k]
        lower = p[np.searchsorted(questions[k - 1], grams & ((1 << 8 * (k - 1)) - 1))]
        weight = answers[_CONTEXT + k][np.searchsorted(questions[_CONTEXT + k], grams >> 8)]
        backed = lower * np.where(np.isnan(weight), 1.0, weight)
        p = np.where(np.isnan(answers[k]), backed, answers[k])
    return np.log(p)


# ---- Spark side ----

def _blocks(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Documents (compressed) and trusted ids, dealt by a hash of the id: ``block, doc_id, lang, z``; z is null for a trusted id."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n = max(shuffle_partitions(docs.sparkSession), -(-size // BLOCK_BYTES))
    src = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def squeeze(batches):
        for b in batches:
            c = zstandard.ZstdCompressor(level=3)
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                z = [c.compress((t or "").encode("utf-8", "replace")) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(z, pa.binary())], ["doc_id", "lang", "z"])

    packed = src.mapInArrow(trimmed(squeeze), f"doc_id {kind}, lang string, z binary")
    trusted = (labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
               .select(F.col("doc_id").cast(kind).alias("doc_id"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("binary").alias("z")))
    both = packed.union(trusted)
    return both.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int").alias("block"), "doc_id", "lang", "z"), n


def _open(t: pa.Table):
    """Texts of a block with id, language and whether the id is trusted, in one order on every read.

    The arrow table may hold the rows in any order; they are sorted by id and content.
    """
    ids, langs, zs = (t.column(c).to_pylist() for c in ("doc_id", "lang", "z"))
    trusted = {i for i, z in zip(ids, zs) if z is None and i is not None}
    d = zstandard.ZstdDecompressor()
    rows = sorted(((i is not None, i or 0, z, i, lang) for i, lang, z in zip(ids, langs, zs) if z is not None),
                  key=lambda r: r[:3])
    return [(i, lang, i in trusted) for *_, i, lang in rows], [d.decompress(r[2]) for r in rows]


def _apart(text: bytes) -> bool:
    """Whether a trusted text only sets thresholds; copies of one text are on the same side."""
    return zlib.crc32(text) % FOLDS == 0


def _count(blocks: DataFrame) -> DataFrame:
    def count(t: pa.Table) -> pa.Table:
        rows, texts = _open(t)
        texts = [x for r, x in zip(rows, texts) if r[2] and not _apart(x)]
        # counts of a step are summed by Spark before they are shuffled
        parts = [np.unique(_grams(texts[lo:hi])[0], return_counts=True) for lo, hi in _steps(texts)]
        keys, sums = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        return pa.table({"gram": keys, "n": sums})

    return (blocks.groupBy("block").applyInArrow(trimmed_group(count), "gram bigint, n bigint")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def _discounts(counts: DataFrame) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more, from the counts of counts."""
    r = counts.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"c{k}") for k in range(1, 5)]).first()
    c = [r[f"c{k}"] for k in range(1, 5)]
    y = c[0] / (c[0] + 2 * c[1]) if c[0] else 0.5
    return [min(k, max(0.05, k - (k + 1) * y * c[k] / c[k - 1])) if c[k - 1] else 0.5 * k for k in (1, 2, 3)]


def fit(counts: DataFrame) -> DataFrame:
    """Rows ``key, value`` of the model: tagged n-grams with their interpolated probability, tagged contexts with their back-off weight.

    ``counts`` are the 5-gram counts (``gram, n``).  Lower orders count the
    distinct bytes that precede an n-gram.
    """
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        longer = by_order[k + 1]
        by_order[k] = materialize(longer.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram"))
                                  .agg(F.count("*").alias("n")))
    out, lower = None, None
    for k in range(1, ORDER + 1):
        c = by_order[k]
        d = _discounts(c)
        n = F.col("n")
        off = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        ctx = F.shiftright("gram", 8)
        totals = c.groupBy(ctx.alias("ctx")).agg(F.sum("n").alias("total"), F.sum(off).alias("mass"))
        totals = totals.select("ctx", "total", (F.col("mass") / F.col("total")).alias("weight"))
        if k == 1:
            # 256 bytes at most, all of which get a share
            t = totals.first()
            if t is None:
                return counts.sparkSession.createDataFrame([], "key bigint, value double")
            every = counts.sparkSession.range(256).select(F.col("id").alias("gram"))
            probs = every.join(c, "gram", "left").select(
                "gram", (F.greatest(F.coalesce(n - off, F.lit(0.0)), F.lit(0.0)) / t["total"] + t["weight"] / 256).alias("p"))
        else:
            own = c.withColumn("ctx", ctx).join(totals, "ctx")
            low = lower.select(F.col("gram").alias("rest"), F.col("p").alias("q"))
            probs = (own.withColumn("rest", F.col("gram").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(low, "rest")
                     .select("gram", ((n - off) / F.col("total") + F.col("weight") * F.col("q")).alias("p")))
        probs = materialize(probs) if k < ORDER else probs
        rows = probs.select(_tagged(k, F.col("gram")).alias("key"), F.col("p").alias("value"))
        if k > 1:
            rows = rows.union(totals.select(_tagged(_CONTEXT + k, F.col("ctx")).alias("key"), F.col("weight").alias("value")))
        out = rows if out is None else out.union(rows)
        lower = probs
    return out


def _ask(blocks: DataFrame, shards: int) -> DataFrame:
    def ask(t: pa.Table) -> pa.Table:
        _, texts = _open(t)
        keys = _all_keys(_questions(_distinct(texts)))
        shard = _shard(keys, shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        block = t.column("block")[0].as_py()
        parts = [(s, keys[order[a:b]]) for s, (a, b) in enumerate(zip(bounds, bounds[1:])) if b > a]
        # keys ascend inside a shard: their differences compress well
        return pa.table({"block": pa.array([block] * len(parts), pa.int32()), "shard": pa.array([s for s, _ in parts], pa.int32()),
                         "asked": pa.array([_squeeze(np.diff(k, prepend=0)) for _, k in parts], pa.binary())})

    return blocks.groupBy("block").applyInArrow(trimmed_group(ask), "block int, shard int, asked binary")


def _answer(asked: DataFrame, model: DataFrame, n_blocks: int, shards: int) -> DataFrame:
    """Join questions and model inside shards of the n-gram space: ``block, shard, values``."""
    together = -(-n_blocks // BLOCKS_TOGETHER)

    def shard_of(batches):
        for b in batches:
            yield b.append_column("shard", pa.array(_shard(b.column(0).to_numpy(), shards).astype(np.int32)))

    rows = (model.mapInArrow(trimmed(shard_of), "key bigint, value double, shard int")
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(together - 1)))))
    asked = asked.withColumn("part", F.floor(F.col("block") / BLOCKS_TOGETHER).cast("int"))

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        key, value = right.column("key").to_numpy(), right.column("value").to_numpy()
        order = np.argsort(key)
        key, value = np.append(key[order], np.int64(1 << 62)), np.append(value[order], np.nan).astype(np.float32)
        made = []
        for blob in left.column("asked").to_pylist():
            want = np.cumsum(_unpack(blob, np.int64))
            at = np.searchsorted(key, want)
            made.append(_squeeze(np.where(key[at] == want, value[at], np.float32(np.nan))))
        return pa.table({"block": left.column("block"), "shard": left.column("shard"), "answer": pa.array(made, pa.binary())})

    return (asked.groupBy("shard", "part").cogroup(rows.groupBy("shard", "part"))
            .applyInArrow(trimmed_group(answer), "block int, shard int, answer binary"))


def _score(blocks: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    kind = blocks.schema["doc_id"].dataType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, texts = _open(left)
        questions = _questions(_distinct(texts))
        keys = _all_keys(questions)
        value = np.full(len(keys), np.nan, np.float32)
        shard = _shard(keys, shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(shards + 1))
        for s, blob in zip(right.column("shard").to_pylist(), right.column("answer").to_pylist()):
            value[order[bounds[s]:bounds[s + 1]]] = _unpack(blob, np.float32)
        answers, at = {}, 0
        for tag, k in sorted(questions.items()):
            answers[tag] = value[at:at + len(k)].astype(np.float64)
            at += len(k)
        total = np.zeros(len(texts))
        if len(keys):
            logp, five = _log_probability(questions, answers), questions[ORDER]
            for lo, hi in _steps(texts):
                g, owner = _grams(texts[lo:hi])
                both, n = np.unique((g << 20) | owner, return_counts=True)
                v = logp[np.searchsorted(five, both >> 20)]
                total[lo:hi] = np.bincount(both & ((1 << 20) - 1), weights=v * n, minlength=hi - lo)
        size = np.array([len(t) for t in texts], np.int64)
        fitted = bool(len(keys)) and not np.isnan(answers[1]).all()
        ppl = [float(np.exp(-x / n)) if n and fitted else None for x, n in zip(total, size)]
        return pa.table({"doc_id": pa.array([r[0] for r in rows], left.schema.field("doc_id").type),
                         "lang": pa.array([r[1] for r in rows], pa.string()), "trusted": pa.array([r[2] for r in rows], pa.bool_()),
                         "apart": pa.array([r[2] and _apart(x) for r, x in zip(rows, texts)], pa.bool_()),
                         "n_bytes": size, "perplexity": pa.array(ppl, pa.float64()),
                         "digest": pa.array([hashlib.md5(x).hexdigest() for x in texts], pa.string())})

    return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(trimmed_group(score), f"doc_id {kind}, lang string, trusted boolean, apart boolean, n_bytes bigint, perplexity double, digest string"))


def perplexities(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, lang, trusted, apart, n_bytes, perplexity`` (per byte) ``, digest`` (md5 of the text) of every row.

    The perplexity of a null or empty text is null, and so is every one where no
    trusted text exists.  Rows of one id share its label.
    """
    blocks, n = _blocks(docs, labels)
    counts = materialize(_count(blocks))
    shards = max(LEAST_SHARDS, -(-counts.count() // SHARD_GRAMS))
    return _score(blocks, _answer(_ask(blocks, shards), fit(counts), n, shards), shards)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, by_text: bool = False) -> DataFrame:
    """``doc_id, lang, trusted, n_bytes, perplexity, threshold, keep`` of every row.

    ``threshold`` is the given quantile of the perplexities of trusted documents
    kept from the counts, in the row's language; of all languages where it has
    none.  A document above it goes, and so does one without text.  ``by_text``
    adds ``digest``, the md5 of the text; rows of one language and text are
    decided alike.
    """
    scores = materialize(perplexities(docs, labels))
    sure = scores.where("apart and perplexity is not null")
    cut = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = sure.groupBy("lang").agg(cut.alias("own"))
    overall = sure.agg(cut.alias("any")).first()["any"]
    joined = scores.join(by_lang.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")), "left")
    threshold = F.coalesce("own", F.lit(overall).cast("double"))
    keep = (F.col("n_bytes") > 0) & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return joined.select("doc_id", "lang", "trusted", "n_bytes", "perplexity", threshold.alias("threshold"), keep.alias("keep"),
                         *(["digest"] if by_text else []))
