"""SentencePiece encoding and decoding of merge-type (BPE) models, by backtracking.

A text has one valid token sequence: the one in which merging any two
neighbouring tokens' characters again gives the same two tokens.  The encoder
finds it from left to right.  An Aho-Corasick automaton gives all vocabulary
matches, the longest at each position is tried first, a neighbour check
re-merges the two tokens' characters (remembered per pair), and a bit field
marks positions from which no valid rest exists, so no position fails twice.

Pieces hold the white-space mark only at their front, so a text falls apart
into words that are encoded once and remembered in a bounded cache.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
CACHE_WORDS = 300_000
CACHE_PAIRS = 1_000_000


class Codec:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model_pb

        proto = model_pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap:
            raise ValueError("a merge-type (BPE) model with identity normalisation is needed")
        if norm.remove_extra_whitespaces or not norm.escape_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("white-space settings of this model are not supported")
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.dummy_prefix = norm.add_dummy_prefix
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        kinds = type(proto.pieces[0])
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [self.unk] * 256
        self.fallback = proto.trainer_spec.byte_fallback
        self.piece_bytes: list[bytes] = []
        self.is_byte = np.zeros(len(proto.pieces), bool)
        self.silent = np.zeros(len(proto.pieces), bool)
        for i, p in enumerate(proto.pieces):
            out = p.piece.replace(SPACE, " ").encode()
            if p.type == kinds.BYTE:
                self.byte_id[int(p.piece[3:5], 16)] = i
                self.is_byte[i] = True
                out = bytes([int(p.piece[3:5], 16)])
            elif p.type == kinds.CONTROL:
                self.silent[i] = True
                out = b""
            elif p.type == kinds.UNKNOWN:
                out = proto.trainer_spec.unk_surface.encode()
            elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                if p.type == kinds.USER_DEFINED:
                    raise ValueError("user-defined pieces are not supported")
                self.id[p.piece] = i
                self.score[p.piece] = p.score
            self.piece_bytes.append(out)
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.newline_alone = not any("\n" in p for p in self.id)
        # only tokens that merging can reach take part
        self.reachable = {p: i for p, i in self.id.items() if len(p) == 1 or self._merge(p) == [p]}
        self.automaton = ahocorasick.Automaton()
        for p in self.reachable:
            self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        # every token's next shorter token with the same first character
        self.shorter = {}
        for p in self.reachable:
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.reachable), None)
        self.token_ids = {p: np.array([i], "<u4").tobytes() for p, i in self.id.items()}
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _merge(self, s: str) -> list[str]:
        """Plain merging of a short string: best score first, the leftmost among equals."""
        sym = list(s)
        score = self.score
        while True:
            best, at = None, -1
            for i in range(len(sym) - 1):
                sc = score.get(sym[i] + sym[i + 1])
                if sc is not None and (best is None or sc > best):
                    best, at = sc, i
            if at < 0:
                return sym
            sym[at:at + 2] = [sym[at] + sym[at + 1]]

    def _fits(self, left: str, right: str) -> bool:
        """Whether two neighbouring tokens stay what they are when their characters are merged again."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        ok = left not in self.shorter or right not in self.shorter or self._merge(left + right) == [left, right]
        self.pairs[(left, right)] = ok
        return ok

    def tokens(self, s: str) -> list[str]:
        """The valid token sequence of a piece of normalised text; unknown characters stand alone."""
        if s in self.shorter:
            return [s]
        n = len(s)
        longest = list(s)  # at each position; a character without a match stands for itself
        for end, p in self.automaton.iter(s):  # ends ascend, so the last match kept is the longest
            longest[end - len(p) + 1] = p
        shorter, pairs, fits = self.shorter, self.pairs, self._fits
        failed = 0  # bit i: no valid rest begins at position i
        out: list[str] = []
        pos = 0
        last, token = None, longest[0]
        while True:
            while token is not None:
                if not failed or not failed >> (pos + len(token)) & 1:
                    ok = pairs.get((last, token))
                    if ok or ok is None and fits(last, token):
                        break
                token = shorter.get(token)
            if token is None:
                failed |= 1 << pos
                if not out:
                    raise ValueError("no valid token sequence")
                token = shorter.get(last)
                out.pop()
                pos -= len(last)
                last = out[-1] if out else None
                continue
            out.append(token)
            pos += len(token)
            if pos == n:
                return out
            last, token = token, longest[pos]

    def _word(self, s: str) -> bytes:
        return b"".join([self.token_ids.get(t) or self._unknown(t) for t in self.tokens(s)])

    def _unknown(self, t: str) -> bytes:
        return np.array([self.byte_id[b] for b in t.encode()] if self.fallback else [self.unk], "<u4").tobytes()

    def _cached(self, s: str) -> bytes:
        got = self.old.get(s)
        if got is None:
            got = self._word(s)
        if len(s) <= 64:
            if len(self.young) >= CACHE_WORDS:
                self.old, self.young = self.young, {}
            self.young[s] = got
        return got

    def encode_bytes(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers, with begin and end ids."""
        parts = [np.array([self.bos], "<u4").tobytes()]
        if text:
            s = text.replace(" ", SPACE)
            if self.dummy_prefix:
                s = SPACE + s
            for w in self._segments(s):
                got = self.young.get(w)
                parts.append(self._cached(w) if got is None else got)
        parts.append(np.array([self.eos], "<u4").tobytes())
        return b"".join(parts)

    def _segments(self, s: str) -> list[str]:
        """Parts that no merge can cross."""
        if not self.by_word:
            return [s]
        return (_WORDS_LINES if self.newline_alone else _WORDS).findall(s)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces joined, the front space mark dropped, byte pieces read as UTF-8."""
        a = np.asarray(ids, np.int64)
        heard = np.flatnonzero(~self.silent[a]) if len(a) else a
        if not len(heard):
            return ""
        a = a[heard[0]:heard[-1] + 1]
        raw = b"".join(map(self.piece_bytes.__getitem__, a.tolist()))
        if self.dummy_prefix and not self.is_byte[a[0]] and raw[:1] == b" " and a[0] != self.unk:
            raw = raw[1:]
        if not self.is_byte[a].any():
            return raw.decode()
        if self.silent[a].any():  # a begin or end id also ends a run of byte pieces
            return self._decode_broken(a)
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_broken(a)

    def _decode_broken(self, ids: np.ndarray) -> str:
        """As decode, where runs of byte pieces are not all valid: each stray byte reads as U+FFFD."""
        out, run = [], bytearray()

        def flush():
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[at:at + size].decode())
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    size = 1
                at += size
            run.clear()

        first = True
        for i in ids.tolist():
            if self.is_byte[i]:
                run += self.piece_bytes[i]
            else:
                flush()
                s = self.piece_bytes[i].decode()
                if first and self.dummy_prefix and i != self.unk:
                    s = s.removeprefix(" ")
                out.append(s)
            first = False
        flush()
        return "".join(out)


_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_WORDS_LINES = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text and decode it again.

    Returns one row per input row: ``doc_id, n_tokens, ids`` (little-endian
    unsigned 32-bit, binary), ``decoded``.  A null or empty text gives the begin
    and end ids only and decodes to the empty string; a null or repeated id is
    carried through; other columns are ignored.
    """
    def run(batches):
        c = codec(model_path)
        for b in batches:
            texts = b.column(1)
            for at in range(0, b.num_rows, 256):
                part = texts.slice(at, 256).to_pylist()
                ids = [c.encode_bytes(t or "") for t in part]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 256), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary()), pa.array([c.decode(np.frombuffer(x, "<u4")) for x in ids], pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"])

    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids binary, decoded string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per document, hashed where the rows are made."""
    def run(batches):
        c = codec(model_path)
        for b in batches:
            texts = b.column(1)
            for at in range(0, b.num_rows, 512):
                part = texts.slice(at, 512).to_pylist()
                n, h1, h2 = [], [], []
                for t in part:
                    raw = c.encode_bytes(t or "")
                    n.append(len(raw) // 4)
                    h1.append(hashlib.sha256(raw).hexdigest())
                    h2.append(hashlib.sha256(c.decode(np.frombuffer(raw, "<u4")).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, 512), pa.array(n, pa.int64()), pa.array(h1), pa.array(h2)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
