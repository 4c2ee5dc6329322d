"""Exact removal of repeated byte strings, by deep-shallow suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere
else, in another text or the same one.  Matches never cross texts.

1. Every string of that length (a window) is assigned to the smallest hashed
   ``ANCHOR``-byte string in it.  Equal windows have equal anchors, so only
   windows of one anchor need comparing.  Neighbouring windows of one anchor are
   a run: one row for some 75 windows.
2. Runs whose anchor occurs once are unique and go no further.  Runs that occur
   again as a whole are decided by two 64-bit polynomial hashes (of the anchor and
   of the run), not by their bytes.  Of the others, one copy of each is kept for
   comparison: they lie at the edges of repeated passages.
3. Only those edge runs travel as bytes, dealt into bins by their anchor.  A
   bin's windows are suffixes to be sorted: multikey sorting on eight bytes a
   round down to a shallow depth, and below it blind tries, which branch on the
   first word in which a suffix differs from its group's first one.  Suffixes that no
   branch separates within ``LENGTH`` bytes are equal.
4. An anchor with very many different runs is not sorted in one task: its windows
   are counted by their digests, combined before they are shuffled.
5. Texts travel once, compressed, to meet what was found in them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import SpanHash, materialize, shuffle_partitions, text_chunks, trimmed, trimmed_group

LENGTH = 200
ANCHOR = 50
#: depth of the multikey sorting; blind tries take over below it
SHALLOW = 32
BIN_BYTES = 2 << 20
BLOCK_BYTES = 8 << 20
#: different runs of one anchor that are sorted together at most
HOT_RUNS = 20_000
#: text in which runs are looked for at once: arrays of this length stay in the processor's cache
RUN_BYTES = 1 << 16
#: longer texts are cut into overlapping pieces while anchors are chosen
PIECE = 1 << 18
_POSITION = np.uint64((1 << 22) - 1)


def find_runs(buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Runs of windows in concatenated texts: ``(start, windows, anchor hash, content hash)``."""
    n = len(buf)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z.astype(np.uint64), z.astype(np.uint64)
    sums = SpanHash(buf, seed=7)
    i = np.arange(n - anchor + 1)
    reach = length - anchor + 1
    ranked = sums.rank(anchor)
    ranked &= ~_POSITION
    ranked |= i.astype(np.uint64)
    pad = -len(ranked) % reach
    blocks = np.concatenate([ranked, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, reach)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:n - length + 1], ahead[reach - 1:reach + n - length])
    at = (least & _POSITION).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(at)]
    inside = np.arange(len(at)) + length <= ends
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | (at[1:] != at[:-1])
    start = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | (at[1:] != at[:-1])
    windows = np.flatnonzero(stop) + 1 - start
    anchors = at[start]
    return start, windows, sums.spans(anchors, anchors + anchor), sums.spans(start, start + windows - 1 + length)


def _pieces(buf: np.ndarray, offsets: np.ndarray, length: int):
    """Parts of a chunk small enough to rank positions: the chunk itself, or overlapping pieces of one long text."""
    if len(buf) <= PIECE + length:
        yield 0, buf, offsets
        return
    for i in range(len(offsets) - 1):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        for at in range(lo, max(lo + 1, hi - length + 1), PIECE):
            end = min(hi, at + PIECE + length - 1)
            yield at, buf[at:end], np.array([0, end - at])


def _runs(src: DataFrame, length: int, anchor: int) -> DataFrame:
    """One row per run: anchor and content hash, key of the text, place (start << 32 | windows)."""
    def run(batches):
        for b in batches:
            for part, buf, offsets in text_chunks(b, "text", RUN_BYTES):
                key, digest = part.column(0).to_numpy(), part.column(1).to_numpy()
                for base, piece, bounds in _pieces(buf, offsets, length):
                    start, windows, h, c = find_runs(piece, bounds, length, anchor)
                    if not len(start):
                        continue
                    start = start + base
                    own = np.searchsorted(offsets, start, "right") - 1
                    place = ((start - offsets[own]) << 32) | windows
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(key[own]), pa.array(digest[own]), pa.array(place)],
                        ["h", "c", "key", "digest", "place"])

    return src.mapInArrow(trimmed(run), "h bigint, c bigint, key bigint, digest bigint, place bigint")


def sort_equal(buf: np.ndarray, pos: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> np.ndarray:
    """Deep-shallow sort of the suffixes at ``pos``; returns which of them share their first ``length`` bytes with another.

    ``length`` must be a multiple of 8.
    """
    padded = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(buf), np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k:k + len(buf)]
    repeated = np.zeros(len(pos), bool)
    who = np.arange(len(pos))
    group = np.zeros(len(pos), np.int64)

    def tied(order: np.ndarray, new: np.ndarray):
        """Members of groups of at least two, in order, with fresh group numbers."""
        g = np.cumsum(new) - 1
        keep = np.bincount(g)[g] > 1
        return order[keep], g[keep]

    # shallow: multikey sorting, a word a round, only what is still tied
    for depth in range(0, min(shallow, length), 8):
        key = word[pos[who] + depth]
        order = np.argsort(key, kind="stable") if depth == 0 else np.lexsort((key, group))
        k, g = key[order], group[order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (g[1:] != g[:-1])
        who, group = tied(who[order], new)
        if not len(who):
            return repeated
    # deep: blind tries, all groups a level at a time
    depth = np.full(len(who), min(shallow, length), np.int64)
    while len(who):
        first = np.ones(len(who), bool)
        first[1:] = group[1:] != group[:-1]
        model = who[first][np.cumsum(first) - 1]
        branch = depth.copy()
        open_ = np.arange(len(who))
        while len(open_):
            open_ = open_[branch[open_] < length]
            at = branch[open_]
            open_ = open_[word[pos[who[open_]] + at] == word[pos[model[open_]] + at]]
            branch[open_] += 8
        equal = branch >= length
        size = np.bincount(group[equal])  # each group's first member is always equal to itself
        repeated[who[equal]] = size[group[equal]] > 1
        who, group, branch = who[~equal], group[~equal], branch[~equal]
        if not len(who):
            break
        key = word[pos[who] + branch]
        order = np.lexsort((key, branch, group))
        k, b, g = key[order], branch[order], group[order]
        new = np.ones(len(order), bool)
        new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1]) | (g[1:] != g[:-1])
        deeper = branch + 8
        g = np.cumsum(new) - 1
        keep = np.bincount(g)[g] > 1
        order, group = order[keep], g[keep]
        who, depth = who[order], deeper[order]
    return repeated


def _sort_bin(length: int):
    def sort(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        raw = t.column("raw").to_pylist()
        place = t.column("place").to_numpy()
        windows = place & 0xFFFFFFFF
        base = np.cumsum([0] + [len(x) for x in raw])[:-1]
        row = np.repeat(np.arange(len(raw)), windows)
        step = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
        found = np.flatnonzero(sort_equal(np.frombuffer(b"".join(raw), np.uint8), base[row] + step, length))
        row, start = row[found], (place[row[found]] >> 32) + step[found]
        new = np.ones(len(found), bool)
        new[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(found)))
        return pa.table({"key": t.column("key").take(pa.array(row[first])), "digest": t.column("digest").take(pa.array(row[first])),
                         "place": pa.array((start[first] << 32) | count)})
    return sort


def _squeeze(src: DataFrame) -> DataFrame:
    """The text as zstd bytes ``z``; all other columns as they are."""
    fields = [f for f in src.schema.fields if f.name != "text"]

    def run(batches):
        for b in batches:
            c = zstandard.ZstdCompressor(level=3)
            at_text = b.schema.get_field_index("text")
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                z = pa.array([c.compress((t or "").encode("utf-8", "replace")) for t in part.column(at_text).to_pylist()], pa.binary())
                cols = [x for i, x in enumerate(part.columns) if i != at_text]
                names = [x for i, x in enumerate(part.schema.names) if i != at_text]
                yield pa.RecordBatch.from_arrays([*cols, z], [*names, "_z"])

    return src.mapInArrow(trimmed(run), T.StructType([*fields, T.StructField("_z", T.BinaryType())]))


def _expand(t: pa.Table):
    """Texts of a block's rows."""
    d = zstandard.ZstdDecompressor()
    return [d.decompress(z) for z in t.column("_z").to_pylist()]


def _by_row(left: pa.Table, right: pa.Table) -> list[np.ndarray | None]:
    """For each row of a block its sorted places."""
    found: dict[tuple[int, int], list[int]] = {}
    for k, d, p in zip(right.column("key").to_pylist(), right.column("digest").to_pylist(), right.column("place").to_pylist()):
        found.setdefault((k, d), []).append(p)
    out = []
    for k, d in zip(left.column("_key").to_pylist(), left.column("_digest").to_pylist()):
        p = found.get((k, d))
        out.append(np.unique(np.array(p, np.int64)) if p else None)
    return out


def remove_spans(text: bytes, places: np.ndarray | None, length: int = LENGTH) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text without its repeated windows, and the removed spans."""
    if places is None:
        return text, []
    start, stop = places >> 32, (places >> 32) + (places & 0xFFFFFFFF) - 1 + length
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > stop[:-1]
    first = np.flatnonzero(new)
    spans = list(zip(start[first].tolist(), stop[np.append(first[1:], len(start)) - 1].tolist()))
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return b"".join(kept), spans


def repeated_places(src: DataFrame, blocks: DataFrame, n_blocks: int, length: int, anchor: int) -> DataFrame:
    """``key, digest, place`` of every maximal stretch of repeated windows found in a run."""
    spark = src.sparkSession
    runs = _runs(src, length, anchor)
    # stored, so that the join reads two plain shuffles and a frequent anchor can be split
    again = materialize(runs.groupBy("h").agg(F.count("*").alias("m")).where("m > 1").select("h"))
    shared = materialize(runs.join(again, "h"))
    same = materialize(shared.groupBy("h", "c").agg(F.count("*").alias("m"), F.min(F.struct("key", "digest", "place")).alias("one")))
    whole = shared.join(same.where("m > 1").select("h", "c"), ["h", "c"]).select("key", "digest", "place")
    kinds = same.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    edges = materialize(same.join(kinds, "h").select("h", "one.*", (F.col("kinds") > HOT_RUNS).alias("hot")))
    total = edges.agg(F.sum(F.col("place").bitwiseAND(0xFFFFFFFF) + length)).first()[0] or 0
    bins = max(shuffle_partitions(spark), -(-total // BIN_BYTES))
    asked = edges.withColumn("_block", _block(F.col("key"), F.col("digest"), n_blocks))

    def wanted(left: pa.Table, right: pa.Table):
        """``(anchor, key, digest, place, bytes)`` of every run asked for in a block."""
        want: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for h, k, d, p in zip(*(right.column(c).to_pylist() for c in ("h", "key", "digest", "place"))):
            want.setdefault((k, d), []).append((h, p))
        z = left.column("_z")
        opener = zstandard.ZstdDecompressor()
        for i, kd in enumerate(zip(left.column("_key").to_pylist(), left.column("_digest").to_pylist())):
            asks = want.pop(kd, None)  # repeated rows hold the same text
            if asks:
                text = opener.decompress(z[i].as_py())
                for h, p in asks:
                    yield h, *kd, p, text[p >> 32:(p >> 32) + (p & 0xFFFFFFFF) - 1 + length]

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = list(zip(*wanted(left, right))) or [()] * 5
        return pa.table({"h": pa.array(cols[0], pa.int64()), "key": pa.array(cols[1], pa.int64()), "digest": pa.array(cols[2], pa.int64()),
                         "place": pa.array(cols[3], pa.int64()), "raw": pa.array(cols[4], pa.binary())})

    def digest_windows(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        for h, k, d, p, raw in wanted(left, right):
            j = np.arange(p & 0xFFFFFFFF)
            w = SpanHash(np.frombuffer(raw, np.uint8), seed=9).spans(j, j + length).view(np.int64)
            parts.append(np.stack([np.full(len(j), h), w, np.full(len(j), k), np.full(len(j), d), (((p >> 32) + j) << 32) | 1]))
        got = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
        return pa.table(dict(zip(("h", "w", "key", "digest", "place"), got)))

    by_block = blocks.groupBy("_block")
    strings = by_block.cogroup(asked.where("not hot").groupBy("_block")).applyInArrow(
        trimmed_group(cut), "h bigint, key bigint, digest bigint, place bigint, raw binary")
    equal = (strings.withColumn("bin", F.pmod(F.xxhash64("h"), F.lit(bins)))
             .groupBy("bin").applyInArrow(trimmed_group(_sort_bin(length)), "key bigint, digest bigint, place bigint"))
    out = whole.union(equal)
    if edges.where("hot").limit(1).count():
        single = by_block.cogroup(asked.where("hot").groupBy("_block")).applyInArrow(
            trimmed_group(digest_windows), "h bigint, w bigint, key bigint, digest bigint, place bigint")
        twice = single.groupBy("h", "w").agg(F.count("*").alias("m")).where("m > 1").select("h", "w")
        out = out.union(single.join(twice, ["h", "w"]).select("key", "digest", "place"))
    return out


def _block(key, digest, n: int):
    return F.pmod(F.xxhash64(key, digest), F.lit(n)).cast("int")


def deduplicate(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, digests_only: bool = False) -> DataFrame:
    """All columns of ``docs`` (its ``text`` with the repeated bytes removed) and ``n_bytes, n_removed, spans, kept_sha256``.

    ``spans`` are the maximal removed byte ranges of the original text; bytes that
    no longer form a whole character are left out of the new ``text``, not of
    the digest.  A null text counts as empty and stays null.  Repeated rows are
    copies like any others.  ``digests_only`` leaves ``text`` and ``spans`` out and
    counts the spans in ``n_spans``.  Columns already called like the results are replaced.
    """
    results = ("n_bytes", "n_removed", "n_spans", "spans", "kept_sha256")
    given = [c for c in docs.columns if c not in ("doc_id", "text", *results)]
    names = {f"given_{i}": c for i, c in enumerate(given)}  # none of these clashes with a column of the steps below
    apart = docs.select("doc_id", *[F.col(f"`{c}`").alias(k) for k, c in names.items()], "text")
    return _deduplicate(apart, length, anchor, digests_only).withColumnsRenamed(names)


def _deduplicate(docs: DataFrame, length: int, anchor: int, digests_only: bool) -> DataFrame:
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n_blocks = max(shuffle_partitions(docs.sparkSession), -(-size // BLOCK_BYTES))
    kind = docs.schema["doc_id"].dataType
    key = F.col("doc_id").cast("bigint") if isinstance(kind, T.IntegralType) else F.xxhash64("doc_id")
    text = F.col("text").cast("string")
    keyed = docs.withColumns({"text": text, "_key": F.coalesce(key, F.lit(-(1 << 63))), "_digest": F.xxhash64(text)})
    src = keyed.select(F.col("_key").alias("key"), F.col("_digest").alias("digest"), "text")
    kept = ["doc_id"] if digests_only else [c for c in docs.columns if c != "text"]
    blocks = _squeeze(keyed.select(*kept, F.col("text").isNull().alias("_null"), "_key", "_digest", "text"))
    blocks = blocks.withColumn("_block", _block(F.col("_key"), F.col("_digest"), n_blocks))
    places = repeated_places(src, blocks, n_blocks, length, anchor)
    places = places.withColumn("_block", _block(F.col("key"), F.col("digest"), n_blocks))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        n, cut, count, sha, spans, new = [], [], [], [], [], []
        for raw, where, null in zip(_expand(left), _by_row(left, right), left.column("_null").to_pylist()):
            rest, gone = remove_spans(raw, where, length)
            n.append(len(raw))
            cut.append(len(raw) - len(rest))
            count.append(len(gone))
            sha.append(hashlib.sha256(rest).hexdigest())
            if not digests_only:
                spans.append([{"start": a, "stop": b} for a, b in gone])
                new.append(None if null else rest.decode("utf-8", "ignore"))
        cols = {c: left.column(c) for c in kept}
        facts = {"n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(cut, pa.int64())}
        if digests_only:
            return pa.table(cols | facts | {"n_spans": pa.array(count, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})
        return pa.table(cols | {"text": pa.array(new, pa.string())} | facts
                        | {"kept_sha256": pa.array(sha, pa.string()),
                           "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))})

    fields = [docs.schema[c] for c in kept]
    long, string = T.LongType(), T.StringType()
    tail = [("n_bytes", long), ("n_removed", long)]
    if digests_only:
        tail += [("n_spans", long), ("kept_sha256", string)]
    else:
        span = T.StructType([T.StructField("start", long), T.StructField("stop", long)])
        tail = [("text", string), *tail, ("kept_sha256", string), ("spans", T.ArrayType(span))]
    schema = T.StructType([*fields, *[T.StructField(a, b) for a, b in tail]])
    return blocks.groupBy("_block").cogroup(places.groupBy("_block")).applyInArrow(trimmed_group(finish), schema)
