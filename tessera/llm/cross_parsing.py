"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text is built for each language.  A document is
parsed greedily into the longest phrases that occur in that text: walk the
automaton as far as it goes, count a phrase, begin again.  The language whose
text explains the document with the fewest phrases, normalised by the length
of the document and the size of the labelled text, wins.

Fitting uses a bounded sample: ``excerpts`` excerpts of ``excerpt_chars``
characters per label, chosen by a hash of the text among all learnable rows.
Prediction reads every character of every document.  A worker walks many
documents at once, one character of each per step, over one transition table;
long documents are walked in segments side by side, and each segment's state is
handed to the next, so the phrases are those of one greedy parse of the whole
text.  Transitions are stored sparsely, one slot each.  Any number of labels is
compared, ``LABELS_AT_ONCE`` in one pass over the documents.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize, text_chunks, trimmed

UNDETERMINED = "und"
EXCERPTS = 80
EXCERPT_CHARS = 400
#: labels whose automata one worker holds (some 1.5 MB each); more of them take further passes over the documents
LABELS_AT_ONCE = 64
#: letters that are walked side by side with others of the same document; no result depends on it
SEGMENT = 2048
#: slots that are tried at once for a row of transitions
WINDOW = 64
WORK_BYTES = 2 << 20
SEPARATOR = "\x00"


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of the id as text is divisible by 5; a null id is neither held out nor learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame, excerpts: int = EXCERPTS, excerpt_chars: int = EXCERPT_CHARS) -> tuple[tuple[str, str], ...]:
    """The sample: ``(label, text)`` pairs in label order, at most ``excerpts * excerpt_chars`` characters a label.

    Only rows with an id, a text and a label that are not held out are used;
    without any, the sample is empty and every document is undetermined.
    The driver holds the sample, so many characters for each label.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    # distinct texts (within some 5 percent): copies share one draw and give one excerpt
    counts = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()
    if not counts:
        return ()
    # a hash of the text thins each label to a few times the excerpts needed before anything is compared
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 6 * excerpts / max(1, r["n"])))])
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    size = F.char_length("text")
    begin = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(size - excerpt_chars, F.lit(0)) + 1)
    some = (rows.where(draw < share[F.col("lang")])
            .select("lang", F.expr("text").substr((begin + 1).cast("int"), F.lit(excerpt_chars)).alias("part"))
            .distinct())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("part"), "part")
    kept = some.withColumn("k", F.row_number().over(order)).where(F.col("k") <= excerpts).collect()
    by_label: dict[str, list[str]] = {}
    for r in sorted(kept, key=lambda r: (r["lang"], r["k"])):
        by_label.setdefault(r["lang"], []).append(r["part"])
    return tuple((label, SEPARATOR.join(parts)) for label, parts in sorted(by_label.items()))


class Automata:
    """The suffix automata of all languages, their transitions in one sparse table.

    The transition of a state by a letter lies in slot ``offset[state] + letter``,
    which holds the state it belongs to and the next one; rows are shifted until
    no two transitions share a slot.  Without a transition a new phrase begins
    with that letter, in state ``again[language, letter]``.  State 0 stands before
    every text: any letter begins a phrase there.  A letter that the language does
    not have is a phrase of its own, after which state 0 follows.
    """

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        self.labels = [label for label, _ in sample]
        texts = [_letters_only(t) for _, t in sample]
        known = sorted({c for t in texts for c in t if c not in (" ", SEPARATOR)})
        self.letter = {c: i + 1 for i, c in enumerate(known)} | {" ": 0}
        self.width = len(known) + 2  # white space, the known letters, any other letter
        self.class_of = np.zeros(0x110000, np.int32)
        alpha = np.array([c for c in range(0x110000) if chr(c).isalpha()])
        self.class_of[alpha] = self.width - 1
        for c in known:
            self.class_of[ord(c)] = self.letter[c]
        self.bits = [math.log2(max(2, len(t))) for t in texts]
        offsets, slots, again = [np.zeros(1, np.int64)], [np.full(self.width, -1 << 32, np.int64)], []
        base, begin = 1, self.width
        for t in texts:
            offset, made, entry = self._table(self._automaton(t), base, begin)
            offsets.append(offset)
            slots.append(made)
            again.append(entry)
            base, begin = base + len(offset), begin + len(made)
        self.offset, self.slots = np.concatenate(offsets), np.concatenate(slots)
        self.again = np.concatenate(again) if again else np.zeros(0, np.int64)

    def _automaton(self, text: str) -> list[dict[int, int]]:
        """Suffix automaton of a text; a separator starts again at the root."""
        nxt: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for ch in text:
            if ch == SEPARATOR:
                last = 0
                continue
            c = self.letter[ch]
            if c in nxt[last]:  # the factor is known already (after a separator)
                q = nxt[last][c]
                if length[q] == length[last] + 1:
                    last = q
                    continue
                last = self._split(nxt, link, length, last, c, q)
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else self._split(nxt, link, length, p, c, q)
            last = cur
        return nxt

    @staticmethod
    def _split(nxt, link, length, p: int, c: int, q: int) -> int:
        """Split off from state ``q`` the strings that ``p`` reaches."""
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def _table(self, nxt: list[dict[int, int]], base: int, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Offsets of the states, their slots from ``begin`` on, and the states after the first letter of a phrase."""
        counts = np.array([len(row) for row in nxt])
        letters = np.fromiter(chain.from_iterable(nxt), np.int64, counts.sum())
        target = np.fromiter(chain.from_iterable(row.values() for row in nxt), np.int64, counts.sum()) + base
        offset, size = _place(counts, letters, self.width)
        offset += self.width  # a row may begin before the first slot
        slots = np.full(size + 2 * self.width, -1 << 32, np.int64)
        state = np.repeat(np.arange(len(nxt)), counts)
        slots[offset[state] + letters] = (state + base) << 32 | target
        again = np.zeros(self.width, np.int64)
        again[letters[:counts[0]]] = target[:counts[0]]
        return offset + begin, slots, again

    def _step(self, state: np.ndarray, row: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states after letters ``c``, and where a new phrase begins; ``row`` is where a lane's language begins in ``again``."""
        v = self.slots.take(self.offset.take(state) + c)
        new = (v >> 32) != state
        return np.where(new, self.again.take(row + c), v & 0xFFFFFFFF), new

    def phrases(self, classes: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each text's one greedy parse under each language.

        All segments of all texts are walked side by side from state 0.  Then each
        walks again from its predecessor's last state until both walks are in one
        state, after which they are the same.  Where they do not meet before the
        segment's end, the next one begins again from the state that came out.
        """
        n = len(size)
        count = -(-size // SEGMENT)
        owner = np.repeat(np.arange(n), count)
        seg = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = first[owner] + seg * SEGMENT
        length = np.minimum(SEGMENT, first[owner] + size[owner] - start)
        made, fresh_end = self._walk(classes, start, length)
        end = fresh_end.copy()
        given = np.zeros_like(end)  # the state from which a segment was walked
        spare, later = np.zeros_like(made), seg > 0
        every = True
        while True:
            lang, s = np.nonzero(later & (given != np.roll(end, 1, axis=1)))
            if not len(lang):
                break
            if not every:  # only the first of a text is sure to be handed the right state
                one = np.unique(lang * n + owner[s], return_index=True)[1]
                lang, s = lang[one], s[one]
            every = False
            given[lang, s] = end[lang, s - 1]
            spare[lang, s], end[lang, s] = self._hand_over(classes, start[s], length[s], lang * self.width, given[lang, s], fresh_end[lang, s])
        made += spare
        return np.stack([np.bincount(owner, weights=p, minlength=n) for p in made])

    def _walk(self, classes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and last states of each segment from state 0 under each language."""
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        n, langs = len(start), len(self.labels)
        made = np.zeros((langs, n), np.int64)
        state = np.zeros((langs, n), np.int64)
        row = np.arange(langs)[:, None] * self.width
        active = np.searchsorted(-length, -np.arange(int(length[0]) if n else 0), "left")
        for t, k in enumerate(active.tolist()):
            state[:, :k], new = self._step(state[:, :k], row, classes[start[:k] + t])
            made[:, :k] += new
        back = np.empty_like(order)
        back[order] = np.arange(n)
        return made[:, back], state[:, back]

    def _hand_over(self, classes, start, length, row, state, end) -> tuple[np.ndarray, np.ndarray]:
        """Walk from ``state`` beside a walk from state 0, whose last state is ``end``: phrases more than in that, and last states."""
        more, last = np.zeros(len(start), np.int64), end.copy()
        lane, fresh, t = np.arange(len(start)), np.zeros(len(start), np.int64), 0
        while len(lane):
            c = classes[start + t]
            state, new = self._step(state, row, c)
            fresh, other = self._step(fresh, row, c)
            more[lane] += new.astype(np.int64) - other
            t += 1
            apart = state != fresh
            over = apart & (length == t)
            last[lane[over]] = state[over]
            go = apart & ~over
            if not go.all():
                lane, state, fresh, start, length, row = (x[go] for x in (lane, state, fresh, start, length, row))
        return more, last

    def classify(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """For each text: best label, its cost and the next best one (infinite without), fewest phrases a letter."""
        n = len(texts)
        if not self.labels:
            return [UNDETERMINED] * n, np.full(n, np.inf), np.full(n, np.inf), np.zeros(n)
        joined = SEPARATOR.join([t.lower().replace(SEPARATOR, " ") for t in texts])
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
        mark = points == 0
        owner = np.zeros(len(points), np.int32)
        np.cumsum(mark[:-1], out=owner[1:])
        classes = self.class_of[points]
        keep = ~mark
        keep[1:] &= (classes[1:] != 0) | (classes[:-1] != 0)  # runs of anything but letters count as one space
        classes, owner = classes[keep], owner[keep]
        letters = np.bincount(owner[classes != 0], minlength=n)
        first = np.searchsorted(owner, np.arange(n + 1))
        size = np.diff(first)
        norm = self.phrases(classes, first[:-1], size) / np.maximum(size, 1)
        cost = norm * np.array(self.bits)[:, None]
        best = cost.argmin(axis=0)
        ranked = np.sort(cost, axis=0)
        second = ranked[1] if len(ranked) > 1 else np.full(n, np.inf)
        labels = [self.labels[i] if k else UNDETERMINED for i, k in zip(best, letters)]
        return labels, ranked[0], second, norm.min(axis=0)


def _score(label: list[str], cost: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How far the best label's cost is below the next one's: 1 without another, 0 for ties and undetermined texts."""
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(second > 0, 1 - cost / second, 0.0)
    return np.where([x != UNDETERMINED for x in label], np.clip(np.nan_to_num(score), 0, 1), 0.0)


def _place(counts: np.ndarray, letters: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Shifts of rows of letters so that no two letters share a slot, and the slots needed: the first place that fits, long rows first."""
    start = np.cumsum(counts) - counts
    offset = np.zeros(len(counts), np.int64)
    used = np.zeros(2 * len(letters) + 2 * (WINDOW + width), bool)
    at = size = 0
    for row in np.argsort(-counts, kind="stable").tolist():
        n = int(counts[row])
        if n < 2:
            break
        if n != size:
            at, size = 0, n
        mine = letters[start[row]:start[row] + n]
        low = mine.min()
        while True:
            if at + WINDOW + width > len(used):
                used = np.concatenate([used, np.zeros(len(used), bool)])
            free = at + np.flatnonzero(~used[at:at + WINDOW])
            fits = np.flatnonzero(~used[free[:, None] + (mine - low)].any(axis=1))
            if len(fits):
                break
            at += WINDOW
        at = int(free[fits[0]])
        used[at + mine - low] = True
        offset[row] = at - low
    single = np.flatnonzero(counts == 1)
    free = np.flatnonzero(~used)
    if len(free) < len(single):
        free = np.concatenate([free, len(used) + np.arange(len(single) - len(free))])
    taken = free[:len(single)]
    offset[single] = taken - letters[start[single]]
    last = max(np.flatnonzero(used).max(initial=-1), taken.max(initial=-1))
    return offset, int(last) + 1


def _letters_only(text: str) -> str:
    """Lower case, every run of anything but letters one space; separators stay."""
    return re.sub(" +", " ", "".join(c if c.isalpha() or c == SEPARATOR else " " for c in text.lower()))


@lru_cache(maxsize=2)
def automata(sample: tuple[tuple[str, str], ...]) -> Automata:
    return Automata(sample)


def predict(docs: DataFrame, sample: tuple[tuple[str, str], ...], text_col: str = "text",
            names: tuple[str, str, str] = ("lang_pred", "score", "phrase_rate")) -> DataFrame:
    """All columns of ``docs`` and three more: predicted label, score (0 to 1), best phrases a letter.

    The label is ``und`` (score 0) where the text is null or has no letter.
    Ties go to the first label in order.  Columns already called like the three
    are replaced.  More labels than a worker holds take several passes over the
    documents, with the best so far carried along.
    """
    src = docs.drop(*names)
    second = "next_cost"
    while second in src.columns or second in names:
        second += "_"
    blocks = [sample[k:k + LABELS_AT_ONCE] for k in range(0, len(sample), LABELS_AT_ONCE)] or [()]
    out = src
    for k, block in enumerate(blocks):
        if k:
            out = materialize(out)
        out = _pass(out, src, block, text_col, (*names, second), k > 0, k == len(blocks) - 1)
    return out


def _pass(docs: DataFrame, src: DataFrame, block, text_col: str, names: tuple[str, ...], carried: bool, final: bool) -> DataFrame:
    """One pass over the documents with the automata of some labels; ``names`` are those of label, cost, rate and next cost."""
    width = len(src.columns)
    schema = T.StructType(list(src.schema.fields))
    kept = names[:3] if final else names
    for name, kind in zip(kept, ("string", "double", "double", "double")):
        schema = schema.add(name, kind)

    def run(batches):
        model = automata(block)
        for b in batches:
            for part, _, _ in text_chunks(b, text_col, WORK_BYTES):
                given = part.columns[:width]
                texts = [t or "" for t in given[part.schema.get_field_index(text_col)].to_pylist()]
                label, cost, other, rate = model.classify(texts)
                if carried:
                    had, *figures = (c.to_pylist() for c in part.columns[width:])
                    cost0, rate0, other0 = (np.array(f, np.float64) for f in figures)
                    label = [x if new < old else y for x, y, new, old in zip(label, had, cost, cost0)]
                    other = np.minimum(np.maximum(cost, cost0), np.minimum(other, other0))
                    cost, rate = np.minimum(cost, cost0), np.minimum(rate, rate0)
                made = [pa.array(label, pa.string()), pa.array(_score(label, cost, other) if final else cost, pa.float64()),
                        pa.array(rate, pa.float64()), pa.array(other, pa.float64())]
                yield pa.RecordBatch.from_arrays([*given, *made[:len(kept)]], [*part.schema.names[:width], *kept])

    return docs.mapInArrow(trimmed(run), schema)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows not held out and predict every document: ``doc_id, held_out, lang_pred, score``."""
    sample = learn(docs)
    src = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(src, sample).select("doc_id", "held_out", "lang_pred", "score")
