"""Near-duplicate vectors by cross-polytope hashing.

A vector is rotated by random signs and fast Hadamard transforms (three rounds);
its hash is the signed axis it then lies nearest to.  A table joins ``k`` such
hashes into a bucket.  Multiprobe: a vector is also entered in the buckets that
differ in the hash it decided most narrowly.  Vectors that share a bucket are
candidates, and every candidate pair is verified by its cosine in double
precision.

Equal vectors are one row from the start.  A bucket is cut into blocks of bounded
size and each pair of blocks is one task, which returns link counts and a
spanning forest, never the pairs; a pair is counted only in the first bucket that
both vectors are in.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, materialize, mix64, shuffle_partitions
from tessera.llm.ngram_join import forest

COSINE = 0.95
#: share of the links at the threshold itself that the tables are to find
RECALL = 0.9999
#: buckets in which a vector is entered in each table
PROBES = 3
#: vectors of a bucket that are compared in one task, on either side
BLOCK = 1024
#: rows of small buckets that are compared in one task
BIN_ROWS = 20_000
#: vectors expected in a bucket of unrelated ones
OCCUPANCY = 8


def hashes_for(n: int, dim: int) -> int:
    """Hashes in a bucket key, so that unrelated vectors share a bucket with a few others at most, however many there are."""
    return max(1, math.ceil(math.log(max(2, n / OCCUPANCY)) / math.log(2 * dim)))


def _rotations(dim: int, count: int, seed: int = 11) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.choice(np.array([-1.0, 1.0]), size=(count, 3, dim))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def buckets(x: np.ndarray, tables: int, k: int, probes: int) -> np.ndarray:
    """Bucket keys (vectors x tables * probes) of unit vectors; the first of each table is the vector's own."""
    n, d = x.shape
    width = 1 << (d - 1).bit_length() if d > 1 else 2
    x = np.pad(x, ((0, 0), (0, width - d)))
    signs = _rotations(width, tables * k)
    out = np.zeros((n, tables, probes), np.uint64)
    for t in range(tables):
        axes, seconds, gaps = [], [], []
        for j in range(k):
            y = x
            for r in range(3):
                y = hadamard(y * signs[t * k + j, r])
            size = np.abs(y)
            top = np.argpartition(size, -probes, axis=1)[:, -probes:]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
            value = np.take_along_axis(y, top, 1)
            axes.append(2 * top + (value < 0))
            gaps.append(np.abs(value[:, :1]) - np.abs(value))
        axis, gap = np.stack(axes, 1), np.stack(gaps, 1)  # vectors x hashes x rank
        # candidates: change one hash to its next axes; take the narrowest decisions
        flat = gap[:, :, 1:].reshape(n, -1)
        order = np.argsort(flat, axis=1, kind="stable")[:, :probes - 1]
        for p in range(probes):
            chosen = axis[:, :, 0].copy()
            if p:
                which = order[:, p - 1]
                j, rank = which // (probes - 1), which % (probes - 1) + 1
                chosen[np.arange(n), j] = axis[np.arange(n), j, rank]
            key = np.full(n, t + 1, np.uint64)
            for j in range(k):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + chosen[:, j].astype(np.uint64) + np.uint64(1))
            out[:, t, p] = key
    return out.reshape(n, -1)


@lru_cache(maxsize=64)
def tables_for(dim: int, k: int, probes: int, cosine: float, recall: float) -> int:
    """Tables needed for the recall: from the share of random pairs at the threshold that meet in a table."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(1000, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=(1000, dim))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
    b = cosine * a + math.sqrt(max(0.0, 1 - cosine * cosine)) * side
    x, y = (buckets(v, 4, k, probes).reshape(1000, 4, -1) for v in (a, b))
    met = float((x[:, :, :, None] == y[:, :, None, :]).any(axis=(2, 3)).mean())
    return max(2, math.ceil(math.log(1 - recall) / math.log(max(1e-9, 1 - min(met, 1 - 1e-9)))))


def _unit(table: pa.Table | pa.RecordBatch, column: str) -> np.ndarray:
    x = np.array(table.column(column).to_pylist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components would overflow or vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(v, kind: str):
    """Not null, no null or non-finite component, not zero."""
    ok = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")).cast(kind)))
    return F.coalesce(v.isNotNull() & ok & F.exists(v, lambda c: c != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, probes: int = PROBES) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Rows whose vector is null, zero or holds a null or non-finite component link
    with nothing; vectors of different lengths are never compared.  ``n_links``
    counts other rows, repeated ones included; ``component_id`` is the smallest
    id reachable (null only where all ids of a component are null).
    """
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    src = vectors.select("vec_id", "embedding")
    v = F.col("embedding")
    # zeros of either sign are one value
    node = F.when(_usable(v, kind), F.md5(F.array_join(F.transform(v, lambda c: F.hex((c + 0.0).cast("double").cast("string").cast("binary"))), ",")))
    marked = materialize(src.withColumn("node", node))
    classes = materialize(marked.where("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("low"), F.first("embedding").alias("embedding"),
        F.size(F.first("embedding")).alias("dim")))
    sizes = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).limit(1000).collect()}

    def hashed(batches):
        for b in batches:
            dims = np.array(b.column(3).to_pylist())
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                k, p = hashes_for(sizes.get(d, 2), d), min(probes, 1 << (d - 1).bit_length() if d > 1 else 2)
                tables = tables_for(d, k, p, cosine, recall)
                for at in range(0, part.num_rows, 2048):
                    some = part.slice(at, 2048)
                    keys = buckets(_unit(some, "embedding"), tables, k, p)
                    keys = mix64(keys + np.uint64(d)).view(np.int64)
                    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, keys.shape[1]), pa.int32()), pa.array(keys.ravel()))
                    yield pa.RecordBatch.from_arrays([*some.columns, flat], ["node", "copies", "embedding", "dim", "keys"])

    keyed = materialize(classes.select("node", "copies", "embedding", "dim").mapInArrow(
        hashed, f"node string, copies bigint, embedding array<{kind}>, dim int, keys array<bigint>"))
    at = keyed.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    full = materialize(at.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
                       .select("key", "m", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")))
    rows = full.agg(F.sum("m")).first()[0] or 0
    bins = max(shuffle_partitions(vectors.sparkSession), -(-rows // BIN_ROWS))
    entered = at.join(full, "key").withColumn("block", F.pmod(F.xxhash64("node", "key"), F.col("blocks")).cast("int"))
    # a block meets every block of its bucket: it is sent to the pairs it is in
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda o: F.struct(F.least(o, "block").alias("p"), F.greatest(o, "block").alias("q")))
    # buckets of one block share a task with others
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(bins))).otherwise(F.xxhash64("key", "m.p", "m.q"))
    sent = entered.select("node", "key", "block", "blocks", F.explode(meets).alias("m")).select(
        "node", "key", "block", "m.p", "m.q", task.alias("task"))
    work = sent.join(keyed, "node")

    def verify(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        here, p, q, block = (t.column(c).to_numpy() for c in ("key", "p", "q", "block"))
        order = np.lexsort((q, p, here))
        bounds = np.flatnonzero(np.append(True, (np.diff(here[order]) != 0) | (np.diff(p[order]) != 0) | (np.diff(q[order]) != 0)))
        x, copies = _unit(t, "embedding"), t.column("copies").to_numpy()
        keys = np.sort(np.array(t.column("keys").to_pylist(), np.int64), axis=1)
        found = []
        for lo, hi in zip(bounds, np.append(bounds[1:], len(order))):
            rows = order[lo:hi]
            left, right = rows[block[rows] == p[rows[0]]], rows[block[rows] == q[rows[0]]]
            same = p[rows[0]] == q[rows[0]]
            i, j = np.nonzero(x[left] @ x[right].T >= cosine)
            i, j = (i[i < j], j[i < j]) if same else (i, j)
            if len(i):
                found.append(np.stack([left[i], right[j]]))
        i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        first = np.zeros(len(i), bool)
        for lo in range(0, len(i), 1 << 14):
            s = slice(lo, lo + (1 << 14))
            first[s] = _first_common(keys[i[s]], keys[j[s]]) == here[i[s]]
        i, j = i[first], j[first]
        node, who = np.unique(np.array(t.column("node").to_pylist()).astype(str), return_inverse=True)
        links = np.bincount(who[i], weights=copies[j], minlength=len(node)) + np.bincount(who[j], weights=copies[i], minlength=len(node))
        tree, some = forest(len(node), who[i], who[j]), np.flatnonzero(links)
        return pa.table({"a": pa.array([*node[some], *node[who[i[tree]]]], pa.string()),
                         "b": pa.array([None] * len(some) + [*node[who[j[tree]]]], pa.string()),
                         "links": pa.array([*links[some].astype(np.int64).tolist(), *[None] * len(tree)], pa.int64())})

    verified = materialize(work.groupBy("task", "dim").applyInArrow(verify, "a string, b string, links bigint"))
    joined = components(verified.where("b is not null").select("a", "b"))
    counts = verified.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    named = classes.select("node", "copies", "low").join(joined, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    low = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    facts = named.join(low, "comp").join(counts, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = marked.select("vec_id", "node").join(facts, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest key that two sorted key rows share, row by row."""
    both = np.sort(np.concatenate([a, b], axis=1), axis=1)
    # a key may be in one row twice: only keys of both rows count
    twice = both[:, 1:] == both[:, :-1]
    out = np.full(len(a), np.iinfo(np.int64).max)
    rows = np.arange(len(a))
    pending = twice.any(axis=1)
    while pending.any():
        col = twice.argmax(axis=1)
        key = both[rows, col]
        ok = pending & (a == key[:, None]).any(axis=1) & (b == key[:, None]).any(axis=1)
        out[ok] = key[ok]
        pending &= ~ok
        twice[rows, col] = False
        pending &= twice.any(axis=1)
    return out
