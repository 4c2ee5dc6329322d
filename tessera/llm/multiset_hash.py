"""Homomorphic multiset hash of a document's paragraphs.

Every paragraph (line) hashes to a wide vector; a document's fingerprint is the
sum of its paragraphs' vectors, each coordinate modulo a power of two.  The
order of paragraphs does not matter, and a paragraph is inserted or deleted by
adding or subtracting its vector.  A vector has two parts:

* ``WIDE`` coordinates modulo 2**64, uniform (BLAKE2b of the paragraph): they decide equality;
* ``SKETCH`` coordinates modulo 2**32: each run of five words adds +1 or -1 at one
  hashed place, so that scalar products estimate how many runs two documents share.

The likeness of two fingerprints is the Tanimoto coefficient of their sketches.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import CHUNK_BYTES, SpanHash, shingle_spans

WIDE = 8
SKETCH = 128
SHINGLE = 5
#: texts fingerprinted in one vectorised step
STEP_ROWS = 2048


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Wide (uint64) and sketch (uint32) parts, a row for each text."""
    n = len(texts)
    lines = [t.encode("utf-8", "replace").split(b"\n") for t in texts]
    per = np.array([len(x) for x in lines], np.int64)
    flat = [p for x in lines for p in x]
    digest = b"".join([hashlib.blake2b(p, digest_size=8 * WIDE).digest() for p in flat])
    wide = np.add.reduceat(np.frombuffer(digest, "<u8").reshape(-1, WIDE), np.cumsum(per) - per, axis=0) if n else np.zeros((0, WIDE), np.uint64)
    buf = np.frombuffer(b"".join(flat), np.uint8)
    offsets = np.zeros(len(flat) + 1, np.int64)
    np.cumsum([len(p) for p in flat], out=offsets[1:])
    sketch = np.zeros((n, SKETCH), np.uint32)
    if len(buf):
        line, start, end = shingle_spans(buf, offsets, SHINGLE)
        h = SpanHash(buf, seed=3).spans(start, end)
        owner = np.repeat(np.arange(n), per)[line]
        place = owner * SKETCH + (h >> np.uint64(40)).astype(np.int64) % SKETCH
        sign = 1.0 - 2.0 * (h & np.uint64(1)).astype(np.float64)
        sums = np.bincount(place, weights=sign, minlength=n * SKETCH)
        sketch = sums.astype(np.int64).astype(np.uint32).reshape(n, SKETCH)
    return wide, sketch


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise likeness (0 to 1) of two fingerprint arrays as ``pack`` joins them; 1 exactly for equal ones."""
    same = (a == b).all(axis=1)
    x, y = (_sketch_of(v).astype(np.float64) for v in (a, b))
    ab, size = (x * y).sum(axis=1), (x * x).sum(axis=1) + (y * y).sum(axis=1)
    out = np.clip(ab / np.maximum(size - ab, 1e-9), 0.0, 1.0)
    return np.where(same, 1.0, np.where(size > 0, np.minimum(out, 1 - 1e-9), 0.0))


def pack(wide: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """One uint64 row per fingerprint."""
    return np.concatenate([wide, np.ascontiguousarray(sketch).view("<u8")], axis=1)


def _sketch_of(packed: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(packed[:, WIDE:]).view("<u4").astype(np.int32)


class Fingerprint:
    """A document's fingerprint, to be built up, changed and compared paragraph by paragraph."""

    def __init__(self, text: str | None = None, packed: np.ndarray | None = None):
        empty = np.zeros(WIDE + SKETCH // 2, np.uint64)
        self.packed = packed if packed is not None else empty if text is None else pack(*fingerprints([text]))[0]

    def _with(self, other: np.ndarray, sign: int) -> Fingerprint:
        wide = self.packed[:WIDE] + other[:WIDE] if sign > 0 else self.packed[:WIDE] - other[:WIDE]
        a, b = self.packed[WIDE:].view("<u4"), other[WIDE:].view("<u4")
        return Fingerprint(packed=np.concatenate([wide, (a + b if sign > 0 else a - b).view("<u8")]))

    def insert(self, paragraph: str) -> Fingerprint:
        return self._with(Fingerprint(paragraph).packed, 1)

    def delete(self, paragraph: str) -> Fingerprint:
        return self._with(Fingerprint(paragraph).packed, -1)

    def likeness(self, other: Fingerprint) -> float:
        return float(likeness(self.packed[None], other.packed[None])[0])

    def __str__(self) -> str:
        return text_of(self.packed)


def text_of(packed: np.ndarray) -> str:
    return base64.b64encode(packed.astype("<u8").tobytes()).decode()


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (base64 of all coordinates) of every row; a null text counts as empty."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, STEP_ROWS):
                texts = [t or "" for t in b.column(1).slice(at, STEP_ROWS).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, STEP_ROWS), pa.array([text_of(p) for p in pack(*fingerprints(texts))])],
                    ["doc_id", "fingerprint"])
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def in_order(docs: DataFrame, slices: int) -> DataFrame:
    """Rows dealt into ``slices`` ranges of ``doc_id``: ``slice, head, doc_id, text``, sorted inside each slice.

    Every slice ends with a copy (``head``) of the first row of the next one, and
    the last slice with a copy of the first row of all, so each row's successor
    is in its own slice.  Slices begin at ids that occur: quantiles taken in one
    pass over the ids alone.  Rows of a null id come first; rows of one id are
    in the order of their text's hash.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    src = docs.select(key.alias("key"), "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    probs = F.array(*[F.lit((k + 0.5) / slices) for k in range(slices)])
    row = src.agg(F.min("key").alias("low"), F.percentile_approx("key", probs, F.lit(100 * slices)).alias("q")).first()
    starts = sorted({row["low"], *(row["q"] or [])} - {None})
    begins = F.array(*[F.lit(s) for s in starts]) if starts else F.array().cast("array<bigint>")
    # the slice of a row: how many slices begin at or before its id, less one
    place = F.lit(len(starts) - 1) if len(starts) < 2 else F.expr(_bisect(starts, 0, len(starts)))
    first = F.xxhash64("text")
    src = src.withColumn("slice", place.cast("int"))
    heads = src.where(F.col("key").isin(starts)) if starts else src.limit(0)
    lead = heads.groupBy("key").agg(F.min(F.struct(first.alias("h"), "text")).alias("m")) if starts else None
    own = src.select("slice", F.lit(False).alias("head"), "key", "doc_id", "text")
    if lead is not None:
        n = len(starts)
        before = F.pmod(F.array_position(begins, F.col("key")).cast("int") - 2 + n, F.lit(n))
        own = own.union(lead.select(before.alias("slice"), F.lit(True).alias("head"), "key",
                                    F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.col("m.text").alias("text")))
    dealt = own.repartition("slice")
    return dealt.sortWithinPartitions("slice", "head", "key", F.xxhash64("text")).select("slice", "head", "doc_id", "text")


def _bisect(starts: list[int], lo: int, hi: int) -> str:
    """SQL for the index of the last start at or before ``key``, as a tree of comparisons."""
    if hi - lo == 1:
        return str(lo)
    mid = (lo + hi) // 2
    return f"IF(key < {starts[mid]}L, {_bisect(starts, lo, mid)}, {_bisect(starts, mid, hi)})"


def compare_edited(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Fingerprint every document and its edited text, whose last half is taken from the next document.

    The last ``floor(n_chars / 2)`` code points are replaced by the first as many
    (or all) of the next document in ascending ``doc_id``; after the last comes
    the first.  One shuffle of the texts; returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    slices = slices or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        held: list[tuple] = []  # rows whose successor is not seen yet: at most the last one, and those of this step
        size = 0

        def step(rows):
            texts = [r[2] for r in rows]
            edited, near = [], []
            for a, b in zip(rows, rows[1:]):
                if not a[1] and a[3] == b[3]:
                    k = len(a[2]) // 2
                    edited.append(a[2][:len(a[2]) - k] + b[2][:k])
                    near.append(len(edited) - 1)
                else:
                    near.append(-1)
            made = pack(*fingerprints(texts + edited))
            own = [i for i, k in enumerate(near) if k >= 0]
            if not own:
                return None
            f, e, nxt = made[own], made[len(texts):], made[np.array(own) + 1]
            return pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in own], id_type), pa.array([len(texts[i]) for i in own], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([text_of(x) for x in f], pa.string()), pa.array([text_of(x) for x in e], pa.string()),
                pa.array(likeness(f, e)), pa.array(likeness(f, nxt))],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        id_type = None
        for b in batches:
            id_type = b.column(2).type
            for at in range(0, b.num_rows, 256):
                p = b.slice(at, 256)
                for row in zip(p.column(2).to_pylist(), p.column(1).to_pylist(), p.column(3).to_pylist(), p.column(0).to_pylist()):
                    held.append(row)
                    size += len(row[2])
                    if size > CHUNK_BYTES // 2 or len(held) > STEP_ROWS:
                        if len(held) > 1:
                            if (out := step(held)) is not None:
                                yield out
                            held, size = held[-1:], len(held[-1][2])
        if len(held) > 1 and (out := step(held)) is not None:
            yield out

    return in_order(docs, slices).mapInArrow(
        run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
