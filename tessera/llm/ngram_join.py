"""Jaccard self-join on word n-grams: MinHash banding, then verification on full n-gram sets.

1. Every text becomes the set of its distinct five-word runs (64-bit hashes).
   Rows of equal sets form one class, so copies are one row from here on.
2. Bands of MinHash rows, their numbers chosen for a target recall at the
   threshold, are shuffled by their hashes.  A class links to the smallest class
   of every bucket it is in; connected links are a candidate family.
3. Only texts of families travel, once.  A family is cut into blocks by a hash
   and every pair of blocks that share a bucket is verified in one task: pairs
   that share a bucket are compared on their full sets.  A task returns link
   counts and a spanning forest, never all pairs.
4. Components of the forests are the duplicate classes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SpanHash, components, materialize, mix64, shingle_spans, text_chunks, trimmed, trimmed_group

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
#: n-grams of a family that one block holds; larger families are cut into blocks
BLOCK_GRAMS = 200_000
#: text that is hashed at once: arrays of this length stay in the processor's cache
STEP_BYTES = 1 << 17
#: columns of a comparison that are dense at once
DENSE_COLUMNS = 1 << 14


def banding(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """Bands and rows: the most rows (fewest chance candidates) whose bands reach the recall within the hashes."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        hit = threshold ** rows  # chance that a pair at the threshold agrees in one band
        if hit < 1e-9:
            break
        bands = math.ceil(math.log(1 - recall) / math.log1p(-hit)) if hit < 1 else 1
        if bands * rows <= most_hashes:
            best = (max(bands, 1), rows)
    return best


def gram_sets(buf: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """Sorted distinct n-gram hashes of each text: ``(values, offsets)``; a text without a word has none."""
    owner, start, end = shingle_spans(buf, offsets, size)
    h = SpanHash(_one_space(buf), seed=5).spans(start, end) if len(owner) else np.zeros(0, np.uint64)
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (h[1:] != h[:-1])
        owner, h = owner[new], h[new]
    return h, np.searchsorted(owner, np.arange(len(offsets)))


def _one_space(buf: np.ndarray) -> np.ndarray:
    """White space of any kind reads as a space."""
    return np.where(buf <= 32, np.uint8(32), buf)


def signatures(values: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes (texts x bands) of non-empty sets."""
    n = len(bounds) - 1
    out = np.zeros((n, bands), np.uint64)
    starts = bounds[:-1]
    for b in range(bands):
        acc = np.full(n, b + 1, np.uint64)
        for r in range(rows):
            k = b * rows + r
            mul = np.uint64(int(mix64(np.array([2 * k + 11], np.uint64))[0]) | 1)
            low = np.minimum.reduceat((values * mul) ^ (values >> np.uint64(29)), starts)
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + low)
        out[:, b] = acc
    return out


def _digests(values: np.ndarray, bounds: np.ndarray) -> list[str | None]:
    """128-bit digest of each set; None for an empty one."""
    first = np.add.reduceat(np.append(mix64(values ^ np.uint64(0xA5A5)), np.uint64(0)), bounds[:-1])
    second = np.add.reduceat(np.append(mix64(values * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)), np.uint64(0)), bounds[:-1])
    return [f"{a:016x}{b:016x}" if n else None for a, b, n in zip(first.tolist(), second.tolist(), np.diff(bounds).tolist())]


def _sketch(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, node, n, keys`` per row, and columns after the text; node (the set's digest) is null for a text without words."""
    more = docs.columns[2:]

    def run(batches):
        for b in batches:
            for part, buf, offsets in text_chunks(b, "text", STEP_BYTES):
                values, bounds = gram_sets(buf, offsets)
                size = np.diff(bounds)
                keys = np.zeros((len(size), bands), np.uint64)
                full = size > 0
                if full.any():
                    keys[full] = signatures(values, np.append(bounds[:-1][full], len(values)), bands, rows)
                flat = pa.array(keys.view(np.int64).ravel())
                at = pa.array(np.arange(0, (len(size) + 1) * bands, bands), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(_digests(values, bounds), pa.string()), pa.array(size, pa.int64()),
                     pa.ListArray.from_arrays(at, flat), *part.columns[2:]], ["doc_id", "node", "n", "keys", *more])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}, node string, n bigint, keys array<bigint>", *(f"{c} string" for c in more)])
    return docs.mapInArrow(trimmed(run), schema)


def _cut(values: np.ndarray, bounds: np.ndarray):
    return [values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, over the values that occur on both sides."""
    lv, rv = np.concatenate(left), np.concatenate(right)
    li = np.repeat(np.arange(len(left)), [len(s) for s in left])
    ri = np.repeat(np.arange(len(right)), [len(s) for s in right])
    shared = np.intersect1d(lv, rv)
    lk, rk = np.searchsorted(shared, lv), np.searchsorted(shared, rv)
    lin = (lk < len(shared)) & (shared[np.minimum(lk, len(shared) - 1)] == lv) if len(shared) else np.zeros(len(lv), bool)
    rin = (rk < len(shared)) & (shared[np.minimum(rk, len(shared) - 1)] == rv) if len(shared) else np.zeros(len(rv), bool)
    li, lk, ri, rk = li[lin], lk[lin], ri[rin], rk[rin]
    out = np.zeros((len(left), len(right)), np.float32)
    lo_l, lo_r = np.argsort(lk, kind="stable"), np.argsort(rk, kind="stable")
    li, lk, ri, rk = li[lo_l], lk[lo_l], ri[lo_r], rk[lo_r]
    for at in range(0, len(shared), DENSE_COLUMNS):
        a0, a1 = np.searchsorted(lk, [at, at + DENSE_COLUMNS])
        b0, b1 = np.searchsorted(rk, [at, at + DENSE_COLUMNS])
        width = min(DENSE_COLUMNS, len(shared) - at)
        x = np.zeros((len(left), width), np.float32)
        y = np.zeros((len(right), width), np.float32)
        x[li[a0:a1], lk[a0:a1] - at] = 1
        y[ri[b0:b1], rk[b0:b1] - at] = 1
        out += x @ y.T
    return out


def _links(left, right, left_keys, right_keys, threshold: float, tile: int = 256):
    """Index pairs of sets that share a band hash and whose Jaccard similarity reaches the threshold."""
    found = []
    sizes_l, sizes_r = (np.array([len(s) for s in x], np.float64) for x in (left, right))
    for i in range(0, len(left), tile):
        for j in range(0, len(right), tile):
            lk, rk = left_keys[i:i + tile], right_keys[j:j + tile]
            near = np.zeros((len(lk), len(rk)), bool)
            for b in range(lk.shape[1]):
                near |= lk[:, b][:, None] == rk[:, b][None, :]
            a, b = sizes_l[i:i + tile][:, None], sizes_r[j:j + tile][None, :]
            near &= np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9
            rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            if not len(rows):
                continue
            both = _common([left[i + r] for r in rows], [right[j + c] for c in cols]).astype(np.float64)
            a, b = sizes_l[i + rows][:, None], sizes_r[j + cols][None, :]
            hit = near[np.ix_(rows, cols)] & (both >= threshold * (a + b - both) - 1e-9)
            p, q = np.nonzero(hit)
            found.append(np.stack([i + rows[p], j + cols[q]]))
    return np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Indices of the pairs that join separate trees."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep.append(k)
    return keep


def text_digest(text_col: str = "text") -> Column:
    """Digest of a row's text; a null text counts as empty."""
    return F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))


def link_counts(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, by_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_links, class_id``.

    ``n_links`` counts the other rows whose n-gram set has a Jaccard similarity
    of at least the threshold, copies included; ``class_id`` is the smallest id
    reachable over links, the row's own id where it has none.  A text without
    words (null, empty, white space) has no links; a text of fewer than five
    words is one n-gram of all its words.  Repeated rows link to each other;
    a null id counts as a row but never names a class.

    ``by_text`` adds ``digest`` (of the row's text) and ``comp``, a key of the
    class that does not depend on ids; null for a text without words.
    """
    spark = docs.sparkSession
    bands, rows = banding(threshold, recall)
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sketch = materialize(_sketch(src.withColumn("digest", text_digest()) if by_text else src, bands, rows))
    classes = (sketch.where("node is not null").groupBy("node")
               .agg(F.count("*").alias("copies"), F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("keys").alias("keys")))
    classes = materialize(classes)

    # links to the smallest class of each bucket
    at = classes.select("node", F.posexplode("keys").alias("band", "key"))
    hubs = at.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count("*").alias("m")).where("m > 1")
    star = at.join(hubs, ["band", "key"]).where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    family = components(star)

    # blocks: a family's classes are dealt by a hash, and meet where a bucket has both
    members = classes.join(family, "node")
    sizes = members.groupBy("comp").agg(F.ceil(F.sum("n") / BLOCK_GRAMS).alias("blocks"))
    members = materialize(members.join(sizes, "comp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    one = members.where("blocks = 1").select("comp", F.lit(0).alias("p"), F.lit(0).alias("q")).distinct()
    cells = members.where("blocks > 1").select("comp", "block", F.posexplode("keys").alias("band", "key")).distinct()
    met = (cells.alias("x").join(cells.alias("y"), ["comp", "band", "key"]).where("x.block <= y.block")
           .select("comp", F.col("x.block").alias("p"), F.col("y.block").alias("q")).distinct())
    tasks = one.union(met)
    sides = (tasks.select("comp", "p", "q", F.col("p").alias("block"))
             .union(tasks.where("p <> q").select("comp", "p", "q", F.col("q").alias("block"))))

    meets = sides.groupBy("comp", "block").agg(F.collect_list(F.struct("p", "q")).alias("meets"))

    # the text of one row of each class; a row of the same id with another text drops out by its digest
    bearer = members.join(meets, ["comp", "block"]).select(
        F.col("low").alias("doc_id"), "node", "comp", "block", "copies", "keys", "meets")
    texts = src.join(bearer, src["doc_id"].eqNullSafe(bearer["doc_id"])).select(*bearer.columns[1:], "text")
    work = _sets(texts).select("comp", F.explode("meets").alias("meet"), "block", "node", "copies", "keys", "grams").select(
        "comp", "meet.p", "meet.q", "block", "node", "copies", "keys", "grams")

    def verify(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        block = t.column("block").to_numpy()
        node = np.array(t.column("node").to_pylist(), object)
        once = np.unique(node.astype(str), return_index=True)[1]  # a repeated row bears the same set
        if len(once) < len(node):
            t, node, block = t.take(pa.array(once)), node[once], block[once]
        copies = t.column("copies").to_numpy()
        keys = np.array(t.column("keys").to_pylist(), np.int64).reshape(len(node), bands)
        grams = [np.frombuffer(x, np.uint64) for x in t.column("grams").to_pylist()]
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        i, j = _links([grams[k] for k in left], [grams[k] for k in right], keys[left], keys[right], threshold)
        i, j = left[i], right[j]
        if p == q:
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, weights=copies[j], minlength=len(node)) + np.bincount(j, weights=copies[i], minlength=len(node))
        tree = forest(len(node), i, j)
        some = np.flatnonzero(links)
        return pa.table({"a": pa.array([*node[some], *node[i[tree]]], pa.string()),
                         "b": pa.array([None] * len(some) + [*node[j[tree]]], pa.string()),
                         "links": pa.array([*links[some].astype(np.int64).tolist(), *[None] * len(tree)], pa.int64())})

    verified = materialize(work.groupBy("comp", "p", "q").applyInArrow(trimmed_group(verify), "a string, b string, links bigint"))
    joined = components(verified.where("b is not null").select("a", "b"))
    counts = verified.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = classes.select("node", "copies", "low").join(joined, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    low = named.groupBy("comp").agg(F.min("low").alias("class_id"))
    facts = named.join(low, "comp").join(counts, "node", "left").select(
        "node", "comp", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return sketch.drop("n", "keys").join(facts, "node", "left").select(
        "doc_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("class_id", "doc_id").alias("class_id"),
        *(["digest", "comp"] if by_text else []))


def _sets(texts: DataFrame) -> DataFrame:
    """The full n-gram set of each class's text, where the text has that class's digest."""
    def run(batches):
        for b in batches:
            for part, buf, offsets in text_chunks(b, "text", STEP_BYTES):
                values, bounds = gram_sets(buf, offsets)
                same = np.array([x == y for x, y in zip(_digests(values, bounds), part.column(0).to_pylist())], bool)
                grams = pa.array([s.tobytes() for s in _cut(values, bounds)], pa.binary())
                out = pa.RecordBatch.from_arrays([*part.columns[:-1], grams], [*part.schema.names[:-1], "grams"])
                yield out.filter(pa.array(same))

    schema = T.StructType([*texts.drop("text").schema.fields, T.StructField("grams", T.BinaryType())])
    return texts.mapInArrow(trimmed(run), schema)
