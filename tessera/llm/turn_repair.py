"""Conversation structure repair by Knuth's lightest-derivation agenda.

A repaired conversation has the role initials ``(s?(ua)+)?``.  An item
``[i, j, q, r]`` says that rows ``i .. j`` of a conversation can be edited so that
they lead the automaton of that pattern from state ``q`` to ``r``; its value is
``(cost, audit)``, the edits' initials in order.  Axioms are the edits of one row and
insertions; a deduction joins two neighbouring items, adds their costs and puts
their audits one after the other.  Both functions are superior and monotone: two
audits of one item and one cost consume the same rows and hold as many
insertions, so neither is a beginning of the other.  The agenda pops values in
rising order, so the first value popped for an item is its lightest.

A conversation of any size is repaired in blocks: rows are numbered along
(conversation, turn) by one range shuffle, a task derives the items of a block of
``BLOCK`` rows from every state to every state, and blocks' items are joined by the
same deductions, ``FAN`` at a time, until one item covers the conversation.  The
way back hands every block its two states, and so its edits.
"""

from __future__ import annotations

import hashlib
import heapq
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, shuffle_partitions, trimmed, trimmed_group

BLOCK = 512
FAN = 64
SPACES = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)  # nothing yet, after s, after u, after a
ENDS = (START, ASSISTANT)
#: where a role leads from each state
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
_INSERTS = [(q, r, INSERT, "I") for c in "ua" for q, r in STEPS[c].items()]


def lightest(parts: list[list[tuple]], start: int, loops: list[tuple] = ()) -> dict[int, tuple[int, str, list[int]]]:
    """Lightest derivations of a row of items, from state ``start`` to every state that can be reached.

    ``parts[i]`` lists the items ``(q, r, cost, audit)`` of element i; ``loops`` are items that consume nothing and may stand anywhere.
    Returns ``{r: (cost, audit, states before each element and at the end)}``.
    """
    by_state = [[[x for x in part if x[0] == q] for q in range(4)] for part in parts]
    free = [[x for x in loops if x[0] == q] for q in range(4)]
    n, done = len(parts), {}
    best = {(0, start): (0, "")}
    agenda = [(0, "", 0, start, None)]
    while agenda:
        cost, audit, i, q, came = heapq.heappop(agenda)
        if (i, q) in done:
            continue
        done[i, q] = cost, audit, came
        for at, items in ((i + 1, by_state[i][q] if i < n else ()), (i, free[q])):
            for _, r, c, text in items:
                item, value = (at, r), (cost + c, audit + text)
                if item not in done and (item not in best or value < best[item]):
                    best[item] = value
                    heapq.heappush(agenda, (*value, at, r, (i, q)))
    out = {}
    for r in range(4):
        if (n, r) in done:
            cost, audit, came = done[n, r]
            states, at = [r], (n, r)
            while came is not None:
                if came[0] < at[0]:
                    states.append(came[1])
                at, came = came, done[came][2]
            out[r] = cost, audit, states[::-1]
    return out


def edits(token: tuple[str, int]) -> list[tuple]:
    """Items of one token: ``d`` is a run of rows that must go, ``s u a x`` a row of that initial (``x``: any other), capital if truncated."""
    kind, n = token
    gone = [(q, q, DELETE * n, "D" * n) for q in range(4)]
    if kind == "d":
        return gone
    extra, role = TRUNCATED * kind.isupper(), kind.lower()
    keep = [(q, r, extra, "K") for q, r in STEPS.get(role, {}).items()]
    other = [(q, r, RELABEL + extra, "R") for c in "ua" if c != role for q, r in STEPS[c].items()]
    return gone + keep + other


def derive(tokens: tuple, start: int) -> dict[int, tuple[int, str, list[int]]]:
    """Lightest derivations of a stretch of rows."""
    return lightest([edits(t) for t in tokens], start, _INSERTS)


#: short stretches repeat, so they are remembered
SHORT = 16
_remembered = lru_cache(maxsize=50_000)(derive)


def replay(tokens: tuple, audit: str, state: int):
    """``(token index, edit, role)`` of every row that is left, in order; index None for an insertion, role None where it stays."""
    i = used = 0  # token, and rows of it that are done
    for op in audit:
        if op == "I":
            state, role = (ASSISTANT, "assistant") if state == USER else (USER, "user")
            yield None, op, role
            continue
        if op == "R":
            state, role = (ASSISTANT, "assistant") if state == USER else (USER, "user")
            yield i, op, role
        elif op == "K":
            state = STEPS[tokens[i][0].lower()][state]
            yield i, op, None
        used += 1
        if used == tokens[i][1]:
            i, used = i + 1, 0


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults: ``conv_id, turn, role, text, n`` (``n`` equal rows; none for a dropped one).

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its marks ``. ! ?``, 3 repeats it, 4 makes it
    the user's.  A null role, text or part of the key counts as one space; ``conv_id`` and ``turn`` stay null.
    """
    blank = F.lit(" ")
    c = conversations
    key = F.concat(F.coalesce(c["conv_id"].cast("string"), blank), F.lit(":"), F.coalesce(c["turn"].cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(c["role"].cast("string"), blank), F.coalesce(c["text"].cast("string"), blank)
    return c.select(
        c["conv_id"], c["turn"].cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("n"))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """Stored distinct rows ``conv_id, turn, role, digest, n, kind, fault, at``, numbered without gaps along (conversation, turn), and how many.

    Rows that a turn does not tell apart follow role, then the digest of the text.  Equal rows are one row with their number.
    Dropped rows stay as one row of a conversation with ``n`` 0, so that no conversation is lost.
    """
    live = F.col("n") > 0
    cut = F.rtrim(F.col("text"), F.lit(SPACES))
    ends = F.substring(cut, -1, 1)
    thin = rows.select("conv_id", F.when(live, F.col("turn")).alias("turn"), F.when(live, F.col("role")).otherwise("").alias("role"),
                       F.when(live, _digest(F.col("text"))).otherwise("").alias("digest"),
                       (live & (F.length(cut) == 0)).alias("blank"),
                       (live & (F.length(cut) > 0) & ~ends.isin(".", "!", "?")).alias("truncated"), "n")
    each = thin.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.sum("n").alias("n"))
    first = (each.where("n > 0").groupBy("conv_id", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("m"))
             .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("m.turn").alias("t"), F.lit(True).alias("first")))
    # joined on all of a row's key, which is its own: no key is common
    marked = each.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
                       & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    initial = F.substring("role", 1, 1)
    marked = marked.select("conv_id", "turn", "role", "digest", "n", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("kind"),
                           F.when(F.col("n") == 0, "").when(F.col("blank"), "b").when(F.col("first").isNull(), "d")
                           .when(F.col("truncated"), "t").otherwise("").alias("fault"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    stored = materialize(marked.repartitionByRange(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)
                         .withColumn("pid", F.spark_partition_id()).withColumn("rid", F.monotonically_increasing_id()))
    # one number a partition: where its rows begin
    sizes = {r["pid"]: r["size"] for r in stored.groupBy("pid").agg(F.count("*").alias("size")).collect()}
    begin, so_far = [], 0
    for p in sorted(sizes):
        begin.append((p, so_far - (p << 33)))
        so_far += sizes[p]
    table = F.broadcast(rows.sparkSession.createDataFrame(begin, "p int, begin bigint"))
    return stored.join(table, F.col("pid") == F.col("p")).withColumn("at", F.col("rid") + F.col("begin")).drop("pid", "rid", "p", "begin"), so_far


_SUMS = ["blank", "duplicate", "truncated", "illegal", "turns"]
_ITEMS = "items array<struct<q:int,r:int,cost:bigint,audit:string,states:array<int>>>"


def _segment_schema(kind: str) -> str:
    return (f"conv_id {kind}, node bigint, partial boolean, size bigint, children array<bigint>, first_kind string, last_kind string, first_turn bigint, last_turn bigint, "
            + ", ".join(f"{c} bigint" for c in _SUMS) + ", at array<bigint>, tokens array<struct<kind:string,n:bigint>>, " + _ITEMS)


def _legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _segment(rows: list[dict], starts, open_end: bool) -> dict:
    """A stretch of one conversation's rows: its counts, ends and items."""
    tokens, at, sums = [], [], dict.fromkeys(_SUMS, 0)
    kinds, last_turn, first_turn = [], None, None
    for x in rows:
        n, fault = x["n"], x["fault"]
        if not n:
            continue
        if x["turn"] is not None:
            first_turn = x["turn"] if first_turn is None else first_turn
            sums["turns"] += x["turn"] != last_turn
            last_turn = x["turn"]
        if kinds:
            sums["illegal"] += not _legal(kinds[-1], x["kind"])
        sums["illegal"] += n - 1  # a role never follows itself
        kinds.append(x["kind"])
        gone = n if fault in ("b", "d") else n - 1
        if fault == "b":
            sums["blank"] += n
        else:
            sums["duplicate"] += gone
            sums["truncated"] += fault == "t"
        if fault not in ("b", "d"):
            tokens.append((x["kind"].upper() if fault == "t" else x["kind"], 1))
            at.append(x["at"])
        if gone:
            if tokens and tokens[-1][0] == "d":
                tokens[-1] = ("d", tokens[-1][1] + gone)
            else:
                tokens.append(("d", gone))
                at.append(None)
    items = []
    for q in starts:
        for r, (cost, audit, _) in (_remembered if len(tokens) <= SHORT else derive)(tuple(tokens), q).items():
            if open_end or r in ENDS:
                items.append({"q": q, "r": r, "cost": cost, "audit": audit, "states": [q, r]})
    return {"size": len(kinds), "children": [], "first_kind": kinds[0] if kinds else None, "last_kind": kinds[-1] if kinds else None,
            "first_turn": first_turn, "last_turn": last_turn, **sums, "at": at, "tokens": [{"kind": k, "n": n} for k, n in tokens], "items": items}


def _block_segments(schema: pa.Schema):
    """Cut every block at its conversations; only its first and last may go on in other blocks."""
    def run(batches):
        for batch in batches:
            out = []
            for block, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cuts = [i for i in range(len(rows)) if not i or rows[i]["conv_id"] != rows[i - 1]["conv_id"]] + [len(rows)]
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    starts = range(4) if not k else (START,)
                    partial = not k or hi == len(rows)
                    out.append({"conv_id": rows[lo]["conv_id"], "node": block, "partial": partial, **_segment(rows[lo:hi], starts, hi == len(rows))})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _join_segments(schema: pa.Schema):
    """One node of the items of up to ``FAN`` neighbouring ones of a conversation."""
    def run(t: pa.Table) -> pa.Table:
        parts = sorted(t.to_pylist(), key=lambda x: x["node"])
        parent = parts[0]["node"] // FAN
        out = {"conv_id": parts[0]["conv_id"], "node": parent, "partial": True, "size": sum(p["size"] for p in parts), "children": [p["node"] for p in parts],
               "at": [], "tokens": [], **{c: sum(p[c] for p in parts) for c in _SUMS}}
        some = [p for p in parts if p["size"]]
        out["first_kind"], out["last_kind"] = (some[0]["first_kind"], some[-1]["last_kind"]) if some else (None, None)
        out["illegal"] += sum(not _legal(a["last_kind"], b["first_kind"]) for a, b in zip(some, some[1:]))
        dated = [p for p in parts if p["first_turn"] is not None]
        out["first_turn"], out["last_turn"] = (dated[0]["first_turn"], dated[-1]["last_turn"]) if dated else (None, None)
        out["turns"] -= sum(a["last_turn"] == b["first_turn"] for a, b in zip(dated, dated[1:]))
        chain = [[(x["q"], x["r"], x["cost"], x["audit"]) for x in p["items"]] for p in parts]
        out["items"] = [{"q": q, "r": r, "cost": cost, "audit": audit, "states": states}
                        for q in sorted({x[0] for x in chain[0]}) for r, (cost, audit, states) in lightest(chain, q).items()]
        return pa.Table.from_pylist([out], schema)

    return run


def _final(node: DataFrame) -> DataFrame:
    """The lightest item of a whole conversation, from nothing to a state that may end."""
    goal = F.filter("items", lambda x: (x["q"] == START) & x["r"].isin(*ENDS))
    best = F.array_min(F.transform(goal, lambda x: F.struct(x["cost"].alias("cost"), x["audit"].alias("audit"), x["r"].alias("r"))))
    return node.withColumn("goal", best)


def _tree(numbered: DataFrame, total: int) -> list[DataFrame]:
    """Stored levels of nodes, from blocks to one node for every conversation that a block may not hold whole (at most two a block)."""
    kind = numbered.schema["conv_id"].dataType.simpleString()
    spark = numbered.sparkSession
    text = _segment_schema(kind)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(spark.createDataFrame([], text).schema)
    row = F.struct("at", "conv_id", "turn", "kind", "fault", "n")
    blocks = (numbered.groupBy(F.floor(F.col("at") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(row)).alias("rows")))
    levels = [materialize(blocks.mapInArrow(trimmed(_block_segments(arrow)), text))]
    nodes = -(-total // BLOCK)
    while nodes > 1:
        below = levels[-1].where("partial")
        levels.append(materialize(below.groupBy("conv_id", F.floor(F.col("node") / FAN).alias("parent"))
                                  .applyInArrow(trimmed_group(_join_segments(arrow)), text)))
        nodes = -(-nodes // FAN)
    return levels


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repair conversations: ``(summary, repaired rows)``.

    ``rows`` has ``conv_id, turn, role, text, n`` (``n`` equal rows side by side, 0 keeps a conversation without rows).  The summary has
    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``; repaired rows are ``conv_id, at, sub, edit, turn, role, text`` in the
    order ``at, sub`` (edit K keep, R rerole, I insert).  Null conversation ids are one conversation, null turns come first.
    """
    numbered, total = _numbered(rows)
    if not total:
        kind = rows.schema["conv_id"].dataType.simpleString()
        spark = rows.sparkSession
        return (spark.createDataFrame([], f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"),
                spark.createDataFrame([], f"conv_id {kind}, at bigint, sub int, edit string, turn bigint, role string, text string"))
    levels = _tree(numbered, total)
    top = _final(levels[-1].where("partial").unionByName(levels[0].where("NOT partial")))
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    summary = top.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("goal.cost").alias("cost"), F.col("goal.audit").alias("audit"))

    # down the tree: the states of a node's lightest item are its children's first and last ones
    ends = top.select(F.col("conv_id").alias("c"), F.col("node").alias("k"), F.lit(START).alias("q"), F.col("goal.r").alias("r"), "partial")
    chosen = ends.where("partial").drop("partial")
    for level in reversed(levels):
        if level is levels[0]:
            chosen = chosen.unionByName(ends.where("NOT partial").drop("partial"))
        item = F.filter("items", lambda x: (x["q"] == F.col("q")) & (x["r"] == F.col("r")))[0]
        here = (level.join(chosen, level["conv_id"].eqNullSafe(F.col("c")) & (level["node"] == F.col("k")))
                .select("conv_id", "node", "children", "at", "tokens", "q", item.alias("item")))
        if level is levels[0]:
            break
        child = F.explode(F.transform("children", lambda x, i: F.struct(
            x.alias("k"), F.get(F.col("item.states"), i).alias("q"), F.get(F.col("item.states"), i + 1).alias("r"))))
        chosen = here.select(F.col("conv_id").alias("c"), child.alias("x")).select("c", "x.k", "x.q", "x.r")

    def edits_of(batches):
        for b in batches:
            at, sub, op, role, near = [], [], [], [], []
            for x in b.to_pylist():
                tokens = tuple((t["kind"], t["n"]) for t in x["tokens"])
                place, k = x["begin"], 1 << 20  # behind what the block before puts after its last row
                for i, edit, new in replay(tokens, x["audit"], x["q"]):
                    place, k = (x["at"][i], 0) if i is not None else (place, k + 1)
                    near.append(x["conv_id"])
                    at.append(place)
                    sub.append(k)
                    op.append(edit)
                    role.append(new)
            yield pa.RecordBatch.from_arrays([pa.array(near, b.schema.field("conv_id").type), pa.array(at, pa.int64()), pa.array(sub, pa.int32()),
                                              pa.array(op, pa.string()), pa.array(role, pa.string())], ["c", "at", "sub", "edit", "new_role"])

    kind = numbered.schema["conv_id"].dataType.simpleString()
    # insertions before a block's first row that is left stand at its beginning
    plan = (here.select("conv_id", "at", "tokens", "q", F.col("item.audit").alias("audit"), (F.col("node") * BLOCK - 1).alias("begin"))
            .mapInArrow(trimmed(edits_of), f"c {kind}, at bigint, sub int, edit string, new_role string"))
    where = numbered.select(F.col("at").alias("p"), "conv_id", "turn", "role", "digest")
    kept = plan.where("edit <> 'I'").join(where, F.col("at") == F.col("p")).drop("p", "c")
    texts = (rows.where("n > 0").select("conv_id", "turn", "role", _digest(F.col("text")).alias("digest"), "text")
             .dropDuplicates(["conv_id", "turn", "role", "digest"])
             .withColumnsRenamed({"conv_id": "_c", "turn": "_t", "role": "_r", "digest": "_d"}))
    same = (F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d")))
    left = kept.join(texts, same).select("conv_id", "at", "sub", "edit", "turn", F.coalesce("new_role", "role").alias("role"), "text")
    new = plan.where("edit = 'I'").select(F.col("c").alias("conv_id"), "at", "sub", "edit", F.lit(None).cast("bigint").alias("turn"),
                                          F.col("new_role").alias("role"), F.lit("").alias("text"))
    return summary, left.unionByName(new)


def _hash_rows(batches):
    """SHA-256 of each conversation's ``role:text`` lines, which come sorted; one state, whatever the conversation's size."""
    ids, out, group, state, kind = [], [], None, None, None
    for b in batches:
        kind = b.schema.field(0).type
        for conv, role, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            if state is None or conv != group:
                if state is not None:
                    ids.append(group)
                    out.append(state.hexdigest())
                group, state = conv, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(f"{role}:{text}".encode())
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(out)], ["c", "repaired_sha256"])
            ids, out = [], []
    if state is not None:
        ids.append(group)
        out.append(state.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(out)], ["c", "repaired_sha256"])


def repaired_digests(conversations: DataFrame) -> DataFrame:
    """Damage and repair all conversations: the summary with ``repaired_sha256``.

    A digest is one chain over its conversation, so a conversation's repaired rows pass one task, sorted and streamed.
    """
    summary, rows = repair(damage(conversations))
    kind = summary.schema["conv_id"].dataType.simpleString()
    hashed = (rows.repartition("conv_id").sortWithinPartitions("conv_id", "at", "sub").select("conv_id", "role", "text")
              .mapInArrow(trimmed(_hash_rows), f"c {kind}, repaired_sha256 string"))
    out = summary.join(hashed, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    return out.select(*summary.columns, F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
