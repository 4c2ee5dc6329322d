"""Best-fit decreasing packing of tokenised documents into sequences of fixed capacity.

Pieces are placed in falling length, each into the tightest open sequence that
still takes it.  A segment tree over the remaining capacities finds that
sequence in logarithmic time.  Pieces of one length are interchangeable, and so
are open sequences of one remaining capacity that were filled alike, so the tree
handles them as runs: its input is a histogram of at most ``capacity`` rows and
its output a table of placement runs bounded the same way, whatever the number
of documents.  Spark tokenises, counts, ranks the pieces within their length and
joins every piece to its run.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, trimmed

CAPACITY = 2048
#: pieces of one length that are ranked together; commoner lengths are salted
RANK_GROUP = 50_000
#: longer texts go to the tokenizers library whole
LONG_TEXT = 200_000


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity, holding how many open runs have each."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, by: int) -> None:
        i = remaining + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity of at least ``need`` that has an open run."""
        i = need + self.size
        if self.count[i]:
            return need
        while i > 1:
            if not i & 1 and self.count[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.count[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on a histogram of lengths.

    Returns runs ``(length, first, n, per_sequence, sequence, offset)``: of the
    pieces of that length, those ranked ``first .. first + n - 1`` go into
    sequences from ``sequence`` on, ``per_sequence`` to each, from ``offset`` on.
    """
    tree = CapacityTree(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}  # remaining -> (first sequence, how many)
    runs = []
    sequences = 0

    def reopen(first: int, n: int, remaining: int) -> None:
        if n and remaining:
            open_runs.setdefault(remaining, []).append((first, n))
            tree.add(remaining, 1)

    for length in sorted(histogram, reverse=True):
        todo, done = histogram[length], 0
        if not 0 < length <= capacity:
            raise ValueError("a piece must fit into an empty sequence")
        while todo:
            remaining = tree.tightest(length)
            if remaining is None:
                each = capacity // length
                first, n, remaining = sequences, -(-todo // each), capacity
                sequences += n
            else:
                first, n = open_runs[remaining].pop()
                tree.add(remaining, -1)
                each = remaining // length
            whole = min(n, todo // each)
            if whole:
                runs.append((length, done, whole * each, each, first, capacity - remaining))
                reopen(first, whole, remaining - each * length)
                done, todo = done + whole * each, todo - whole * each
            if todo and whole < n:  # the last pieces fill one more sequence in part
                runs.append((length, done, todo, each, first + whole, capacity - remaining))
                reopen(first + whole, 1, remaining - todo * length)
                whole, done, todo = whole + 1, done + todo, 0
            reopen(first + whole, n - whole, remaining)
    return runs


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """``encode(text) -> uint32 array``: the ids that the tokenizers library gives without adding special tokens.

    A byte-level merge model whose ids follow merge order runs in tiktoken,
    which gives the same ids faster; any other model, and very long texts, use
    tokenizers itself.
    """
    @lru_cache(maxsize=1)
    def library():
        from tokenizers import Tokenizer
        return Tokenizer.from_file(path)

    def plain(text: str) -> np.ndarray:
        return np.array(library().encode(text, add_special_tokens=False).ids, np.uint32)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    simple = (spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
              and not pre.get("add_prefix_space") and not spec.get("normalizer")
              and not spec["model"].get("ignore_merges") and not spec["model"].get("continuing_subword_prefix"))
    if not simple:
        return plain
    import tiktoken
    to_byte = _byte_letters()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("lstrip", "rstrip", "single_word")):
        return plain
    vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
    merged = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    order = [vocab[a + b] for a, b in merged]
    if order != sorted(order) or len(set(order)) != len(order):
        return plain
    ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items()}
    # the byte-level split: contractions, letters, digits, other marks, white space (fixed value of that format)
    split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("packing", pat_str=split, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> np.ndarray:
        if len(text) > LONG_TEXT:
            return plain(text)
        return fast.encode_to_numpy(text, allowed_special="all")

    return encode


def _byte_letters() -> dict[str, int]:
    """The byte-level format's letter for each byte: printable bytes stand for themselves, the rest follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece; the ids themselves with ``token_pieces``."""
    def run(batches):
        encode = tokenizer(tokenizer_path)
        for b in batches:
            texts = b.column(1)
            for at in range(0, b.num_rows, 512):
                row, piece, start, length, crc = [], [], [], [], []
                for i, t in enumerate(texts.slice(at, 512).to_pylist()):
                    ids = np.append(encode(t or ""), np.uint32(end_id)).astype("<u4")
                    for k, (lo, hi) in enumerate(cuts(len(ids), capacity)):
                        row.append(i)
                        piece.append(k)
                        start.append(lo)
                        length.append(hi - lo)
                        crc.append(zlib.crc32(ids[lo:hi].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 512).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    src = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(trimmed(run), f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Bounds of a document's pieces: whole capacities from the end on, the first piece takes the rest."""
    first = n % capacity or capacity
    return [(0, min(first, n))] + [(at, at + capacity) for at in range(first, n, capacity)]


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to every row of ``items`` (needs ``doc_id, piece, start, length``).

    Every row is placed once, repeated rows and null ids too; an empty table
    gives an empty table.  ``items`` is read several times: pass a stored table.
    """
    spark = items.sparkSession
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(histogram, capacity)
    # both tables are bounded by the capacity
    run_table = spark.createDataFrame(runs or [], "length bigint, first bigint, n bigint, per_seq bigint, seq bigint, base bigint")
    salts = spark.createDataFrame([(k, -(-n // RANK_GROUP)) for k, n in histogram.items()], "length bigint, salts bigint")
    salted = (items.join(F.broadcast(salts), "length")
              .withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("salts"))).drop("salts"))
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("size"))
    before = sizes.select("length", "salt", (F.sum("size").over(Window.partitionBy("length").orderBy("salt")) - F.col("size")).alias("before"))
    ranked = salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")) - 1)
    placed = ranked.join(before, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before"))
    r = F.broadcast(run_table)
    inside = F.col("rank") - F.col("first")
    out = placed.join(r, (placed["length"] == r["length"]) & (F.col("rank") >= F.col("first")) & (inside < F.col("n"))).select(
        *[placed[c] for c in items.columns],
        (F.col("seq") + F.floor(inside / F.col("per_seq"))).cast("bigint").alias("sequence_id"),
        (F.col("base") + (inside % F.col("per_seq")) * placed["length"]).cast("bigint").alias("offset"))
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise and pack: one row per piece, ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is the end id alone.
    """
    return pack(materialize(pieces(docs, tokenizer_path, capacity)), capacity)
