"""Alignment of two tokenizers' tokens by lockstep merging.

Both tokenizers cut the same bytes, so their tokens meet wherever a token of
each ends at the same byte.  One NumPy state vector holds a pointer into the
tokens of A and one into those of B for every document of a batch; each step
compares the two ends of all of them, emits a link and a cut where they are
equal, moves the pointer that is behind (both, where equal) and compacts the
documents that are done.  A long document takes several places of the vector:
the merge may start at any byte with the first tokens that end after it, so its
stretches of ``LANE_BYTES`` bytes run side by side.

How often a pair of ids is linked in the corpus comes from the distinct pairs of
each block of text, summed by pair.  The sums go back by (block, pair), so even a
pair that every document has is one small row a block, and every document finds
its pairs in its block's list.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.best_fit_pack import _byte_letters
from tessera.llm.common import materialize, text_chunks, trimmed, trimmed_group

LANE_BYTES = 2048
#: longer texts go to the tokenizers library, which stays linear in runs without spaces
LONG_TEXT = 200_000


class ByteLevel:
    """A byte-level merge model; the strings of its special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.bytes[i] = t.encode() if t in special else bytes(letters[c] for c in t)
        self.fast = self._tiktoken(spec, special)

    def _tiktoken(self, spec: dict, special: set):
        """tiktoken gives the same ids faster where ids follow merge order and the split is the usual one."""
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        usual = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not spec.get("normalizer") and not model.get("ignore_merges") and not model.get("continuing_subword_prefix"))
        if not usual:
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in merges]
        if any(a >= b for a, b in zip(order, order[1:])):
            return None
        import tiktoken
        # the byte-level split (fixed value of that format)
        split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        ranks = {self.bytes[i]: i for t, i in model["vocab"].items() if t not in special}
        return tiktoken.Encoding("aligned", pat_str=split, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for t in texts:
            if self.fast is not None and len(t) <= LONG_TEXT:
                out.append(self.fast.encode_to_numpy(t).astype(np.int64))
            else:
                out.append(np.array(self.library.encode(t, add_special_tokens=False).ids, np.int64))
        return out


class Pieces:
    """A sentencepiece model; it puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.bytes = [bytes([int(self.library.id_to_piece(i)[3:5], 16)]) if self.library.is_byte(i)
                      else self.library.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self.library.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def tokenizers_of(a_path: str, b_path: str):
    a, b = ByteLevel(a_path), Pieces(b_path)
    return a, b, *(np.array([len(x) for x in t.bytes], np.int64) for t in (a, b))


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, offsets: np.ndarray, lane: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the tokens of A and of B that end at the same byte, in order.

    ``ends`` are the rising byte ends of all tokens of documents laid one after the other; document ``d``
    holds the bytes ``offsets[d] .. offsets[d + 1]``.
    """
    size = np.diff(offsets)
    lanes = -(-size // lane)
    doc = np.repeat(np.arange(len(size)), lanes)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    start = offsets[doc] + nth * lane
    end = np.minimum(start + lane, offsets[doc + 1])
    a, stop_a = np.searchsorted(ends_a, start, "right"), np.searchsorted(ends_a, end, "right")
    b, stop_b = np.searchsorted(ends_b, start, "right"), np.searchsorted(ends_b, end, "right")
    linked_a, linked_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while True:
        open_ = (a < stop_a) & (b < stop_b)
        if not open_.all():
            a, b, stop_a, stop_b = a[open_], b[open_], stop_a[open_], stop_b[open_]
        if not len(a):
            break
        ea, eb = ends_a[a], ends_b[b]
        met = ea == eb
        linked_a.append(a[met])
        linked_b.append(b[met])
        a = a + (ea <= eb)
        b = b + (eb <= ea)
    la, lb = np.concatenate(linked_a), np.concatenate(linked_b)
    order = np.argsort(la, kind="stable")
    return la[order], lb[order]


class Aligned:
    """The tokens, links and groups of one batch of texts."""

    def __init__(self, texts: list, a_path: str, b_path: str):
        a, b, len_a, len_b = tokenizers_of(a_path, b_path)
        n = len(texts)
        some = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in some]
        ids_a, ids_b = a.encode(spaced), b.encode([texts[i] for i in some])
        good = []
        for k, t in enumerate(spaced):
            raw = t.encode()
            if b"".join(map(a.bytes.__getitem__, ids_a[k].tolist())) == raw and b"".join(map(b.bytes.__getitem__, ids_b[k].tolist())) == raw:
                good.append((some[k], k, len(raw)))
        none = np.zeros(0, np.int64)
        self.rows = np.array([i for i, _, _ in good], np.int64)  # texts that have tokens
        self.a = np.concatenate([none, *[ids_a[k] for _, k, _ in good]])
        self.b = np.concatenate([none, *[ids_b[k] for _, k, _ in good]])
        bounds = lambda sizes: np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))]).astype(np.int64)
        self.at_a = bounds([len(ids_a[k]) for _, k, _ in good])
        self.at_b = bounds([len(ids_b[k]) for _, k, _ in good])
        self.offsets = bounds([x for _, _, x in good])
        self.link_a, self.link_b = lockstep(np.cumsum(len_a[self.a]), np.cumsum(len_b[self.b]), self.offsets)
        self.at_link = np.searchsorted(self.link_a, self.at_a)
        self.n = n

    def group_texts(self):
        """``a1,a2|b1;a3|b2`` of every text that has tokens."""
        cut_a, cut_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        cut_a[self.link_a] = 1
        cut_b[self.link_b] = 1
        group = np.concatenate([2 * (np.cumsum(cut_a) - cut_a), 2 * (np.cumsum(cut_b) - cut_b) + 1])
        words = np.concatenate([3 * self.a + cut_a, 3 * self.b + 2 * cut_b])[np.argsort(group, kind="stable")]
        table = _decimals(1 + int(words.max()) // 3 if len(words) else 0)
        at = self.at_a + self.at_b
        for lo, hi in zip(at[:-1], at[1:]):
            yield "".join(map(table.__getitem__, words[lo:hi].tolist()))[:-1]


_texts: list[str] = []


def _decimals(n: int) -> list[str]:
    """``id,``, ``id|`` and ``id;`` of every id below n, one after the other; kept, as ids are bounded by the vocabularies."""
    for i in range(len(_texts) // 3, n):
        _texts.extend((f"{i},", f"{i}|", f"{i};"))
    return _texts


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_linked, b_linked``: the ids of both sides and the indexes of the tokens that end together.

    The two lists of indexes also are the ends of the groups.  A null or empty text, or one whose tokens do not give its bytes
    back, has empty lists.  One row per input row; other columns are ignored.
    """
    def run(batches):
        for batch in batches:
            for part, _, _ in text_chunks(batch, "text"):
                x = Aligned(part.column(1).to_pylist(), a_path, b_path)
                out = [[[] for _ in range(x.n)] for _ in range(4)]
                for k, row in enumerate(x.rows.tolist()):
                    la, lb = (v[x.at_link[k]:x.at_link[k + 1]] for v in (x.link_a, x.link_b))
                    out[0][row], out[1][row] = x.a[x.at_a[k]:x.at_a[k + 1]], x.b[x.at_b[k]:x.at_b[k + 1]]
                    out[2][row], out[3][row] = la - x.at_a[k], lb - x.at_b[k]
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(v, pa.list_(pa.int64())) for v in out]],
                                                 ["doc_id", "a_ids", "b_ids", "a_linked", "b_linked"])

    src = _source(docs)
    kind = src.schema["doc_id"].dataType.simpleString()
    lists = ", ".join(f"{c} array<bigint>" for c in ("a_ids", "b_ids", "a_linked", "b_linked"))
    return src.mapInArrow(trimmed(run), f"doc_id {kind}, {lists}")


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_PAIR_BITS = np.int64(32)


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Stored rows: one per document with its pairs as places in its block's list, and one per block with that list.

    A block is a bounded stretch of text (or one longer text).  ``pairs`` is null on the rows of documents.
    """
    src = _source(docs)
    kind = src.schema["doc_id"].dataType.simpleString()
    names = ["block", "doc_id", *_COUNTS, "groups_sha256", "places", "times", "pairs"]

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, _, _ in text_chunks(batch, "text"):
                x = Aligned(part.column(1).to_pylist(), a_path, b_path)
                links = np.diff(x.at_link)
                pair, place = np.unique(x.a[x.link_a] << _PAIR_BITS | x.b[x.link_b], return_inverse=True)
                # the distinct pairs of each text: places in the block's list, and how often
                key, times = np.unique(np.repeat(np.arange(len(links)), links) * (len(pair) + 1) + place, return_counts=True)
                owner, place = np.divmod(key, len(pair) + 1)
                at = np.searchsorted(owner, np.arange(len(links) + 1))
                total = np.bincount(place, times, len(pair)).astype(np.int64)
                counts = np.zeros((4, x.n), np.int64)
                counts[:, x.rows] = np.diff(x.at_a), np.diff(x.at_b), links, links
                sha, places, often = [""] * x.n, [b""] * x.n, [b""] * x.n
                for k, (row, text) in enumerate(zip(x.rows.tolist(), x.group_texts())):
                    sha[row] = hashlib.sha256(text.encode()).hexdigest()
                    places[row] = place[at[k]:at[k + 1]].astype("<i4").tobytes()
                    often[row] = times[at[k]:at[k + 1]].astype("<u4").tobytes()
                here = pa.array(np.full(x.n, block), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [here, part.column(0), *[pa.array(c) for c in counts], pa.array(sha, pa.string()), pa.array(places, pa.binary()),
                     pa.array(often, pa.binary()), pa.nulls(x.n, pa.binary())], names)
                if len(pair):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.nulls(1, part.column(0).type), *[pa.array([0], pa.int64())] * 4, pa.array([""]),
                         pa.array([b""], pa.binary()), pa.array([total.astype("<i8").tobytes()], pa.binary()),
                         pa.array([pair.astype("<i8").tobytes()], pa.binary())], names)
                block += 1

    schema = (f"block bigint, doc_id {kind}, " + ", ".join(f"{c} bigint" for c in _COUNTS)
              + ", groups_sha256 string, places binary, times binary, pairs binary")
    return materialize(src.mapInArrow(trimmed(run), schema))


def _unpack(batches):
    for b in batches:
        for block, pairs, times in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            pair, n = np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), block)), pa.array(np.arange(len(pair), dtype=np.int32)), pa.array(pair),
                                              pa.array(n)], ["block", "place", "pair", "n"])


def summaries(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``n_best`` counts the links whose pair is linked as often as any of its B id in the corpus, ``count_sum`` adds up how often
    the links' pairs are linked in the corpus.  Rows without tokens (see :func:`alignments`) have zeros and an empty string.
    """
    stored = _blocks(docs, a_path, b_path)
    pairs = (stored.where("pairs IS NOT NULL").select("block", "pairs", "times")
             .mapInArrow(_unpack, "block bigint, place int, pair bigint, n bigint"))
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    known = counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = pairs.select("block", "place", "pair").join(known, "pair").select("block", "place", "count", "best")

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("place").to_numpy())
        count = right.column("count").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        n_best, total = [], []
        for places, times in zip(left.column("places").to_pylist(), left.column("times").to_pylist()):
            p, t = np.frombuffer(places, "<i4"), np.frombuffer(times, "<u4").astype(np.int64)
            n_best.append(int(t[best[p]].sum()) if len(p) else 0)
            total.append(int((t * count[p]).sum()) if len(p) else 0)
        return left.select(["doc_id", *_COUNTS]).append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(total, pa.int64())).append_column("groups_sha256", left.column("groups_sha256"))

    rows = stored.where("pairs IS NULL").drop("pairs")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in [*_COUNTS, "n_best", "count_sum"]) + ", groups_sha256 string"
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(trimmed_group(add), schema)
