"""Shared helpers: the shared folder, Arrow text access, vectorised byte hashing."""

from __future__ import annotations

import ctypes
import inspect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

# bytes of text that one vectorised step works on; bounds the memory of a Python worker
CHUNK_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables through Spark, from any file system."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage in ``spark.checkpoint.dir``, which all executors share."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Slices of a batch holding at most ``limit`` bytes of text, or a single row.

    Yields ``(slice, buffer, offsets)``: the UTF-8 bytes of all texts one after
    the other and where each begins (one more entry than rows).  A null text
    counts as empty.
    """
    arr = batch.column(batch.schema.get_field_index(column))
    if arr.null_count:
        arr = pc.fill_null(arr, "" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    n = len(arr)
    if not n:
        return
    large = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    raw = np.frombuffer(arr.buffers()[1], np.int64 if large else np.int32)
    offsets = raw[arr.offset:arr.offset + n + 1].astype(np.int64)
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(n, max(end, at + 1))
        lo, hi = offsets[at], offsets[end]
        yield batch.slice(at, end - at), buf[lo:hi], offsets[at:end + 1] - lo
        at = end


def trim() -> None:
    """Give memory that a worker no longer uses back to the system: workers outlive tasks and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(run):
    """A batch function that trims the worker's memory when its partition is done."""
    def wrapped(batches):
        yield from run(batches)
        trim()
    return wrapped


def trimmed_group(run):
    """A group function (one or two tables in, one out) that trims the worker's memory after each group."""
    if len(inspect.signature(run).parameters) == 1:
        def wrapped(t):
            out = run(t)
            trim()
            return out
    else:
        def wrapped(left, right):
            out = run(left, right)
            trim()
            return out
    return wrapped


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class SpanHash:
    """64-bit hashes of any byte spans of one buffer, in constant time a span.

    A polynomial in an odd base modulo 2**64 over randomised byte values; the
    base has an inverse, so a span's value does not depend on where it lies.
    """

    _tables: dict = {}

    def __init__(self, buf: np.ndarray, seed: int = 1):
        values, base, inverse = self._setup(seed)
        up, down = self._powers(seed, base, inverse, len(buf) + 1)
        self._down, self._seed = down, np.uint64(seed)
        terms = values[buf]
        terms *= up[:len(buf)]
        self._sums = np.empty(len(buf) + 1, np.uint64)
        self._sums[0] = 0
        np.cumsum(terms, out=self._sums[1:])

    @classmethod
    def _setup(cls, seed: int):
        key = ("values", seed)
        if key not in cls._tables:
            values = mix64(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 20))
            base = int(mix64(np.array([seed * 7919 + 3], np.uint64))[0]) | 5
            cls._tables[key] = (values, base, pow(base, -1, 1 << 64))
        return cls._tables[key]

    @classmethod
    def _powers(cls, seed: int, base: int, inverse: int, n: int):
        key = ("powers", seed)
        have = cls._tables.get(key)
        if have is None or len(have[0]) < n:
            size = max(n, CHUNK_BYTES + 1)  # in one go for all usual chunks
            made = []
            for b in (base, inverse):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                made.append(np.cumprod(p))
            if size > 2 * CHUNK_BYTES:  # not kept: only a very long text needs it
                return made
            cls._tables[key] = have = made
        return have

    def rank(self, size: int) -> np.ndarray:
        """A value for every span of ``size`` bytes, equal for equal spans, whose high bits are well mixed."""
        n = len(self._sums) - size
        h = self._sums[size:] - self._sums[:n]
        h *= self._down[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        return h

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = self._sums[end] - self._sums[start]
        h *= self._down[start]
        h += (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix64(h)


def word_bounds(buf: np.ndarray, breaks: np.ndarray | None = None):
    """Start and end of every run of bytes above the space; a run also ends at each position in ``breaks``."""
    solid = np.zeros(len(buf) + 2, np.int8)
    solid[1:-1] = buf > 32
    step = np.diff(solid)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if breaks is not None and len(breaks):
        inner = breaks[(breaks > 0) & (breaks < len(buf))]
        inner = np.unique(inner[(buf[inner] > 32) & (buf[inner - 1] > 32)]) if len(inner) else inner
        if len(inner):
            start, end = np.sort(np.concatenate([start, inner])), np.sort(np.concatenate([end, inner]))
    return start, end


def shingle_spans(buf: np.ndarray, offsets: np.ndarray, size: int):
    """Spans of ``size`` consecutive words inside each text; a shorter text is one span of all its words.

    Returns ``(owner, first word index, start, end)``, words being byte runs between
    white space, with the owner's index into ``offsets``.
    """
    ws, we = word_bounds(buf, offsets)
    owner = np.searchsorted(offsets, ws, "right") - 1
    n = len(offsets) - 1
    first = np.searchsorted(owner, np.arange(n + 1))
    words = np.diff(first)
    idx = np.arange(len(ws))
    left = first[owner + 1] - idx  # words of the same text from here on
    take = (left >= size) | ((idx == first[owner]) & (words[owner] < size))
    i = idx[take]
    last = np.minimum(i + size - 1, first[owner[i] + 1] - 1)
    return owner[i], ws[i], we[last]


def per_text(owner: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each owner's block in an array sorted by owner."""
    return np.searchsorted(owner, np.arange(n + 1))


def components(edges: DataFrame, nodes_of: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Connected components: ``(node, comp)``, comp the smallest node reachable.

    Alternating large-star / small-star steps over an edge table; every step is
    an aggregate and a join on the node, and the table is cut through reliable
    storage, so neither links nor components ever reach the driver.
    """
    a, b = nodes_of
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = materialize(e)
    before = None
    while True:
        # large star: every larger neighbour links to the smallest neighbour
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        # small star: every smaller neighbour and the node itself link to the smallest one
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(low2, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        e = materialize(small)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


#: bytes of rows that a Python worker is handed at once, where the session says nothing else
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would, and bound their batches of text."""
    sc = spark.sparkContext
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if sc.getConf().get(size, None) is None:
        spark.conf.set(size, str(BATCH_BYTES))
    if getattr(sc, "_tessera_shipped", False):
        return
    import pathlib
    import tempfile
    import zipfile

    import tessera
    root = pathlib.Path(tessera.__file__).parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="tessera-")) / "tessera_pkg.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._tessera_shipped = True
