"""Quotation linking: conversations in reply order, without the passages their messages quote.

Built from DataFrame functions alone.

* A line that begins with ``>`` marks is quoted, its level is the number of
  marks.  Neighbouring quoted lines of one level form a passage.  A line that
  names the author of the quotation after it ("... wrote:") belongs to it.
* Passages, their lines, and every message's own lines and whole own text are
  normalised (case, punctuation, spacing) and hashed.  The original of a passage
  is the earliest message of the conversation that holds it as its own words.
* A passage that is linked by neither itself nor a line is looked for in pieces,
  so that a part of a line or a passage with other line breaks is found: its
  sentences, and its runs of ``RUN`` words, among those of the own texts.  A part
  of a sentence that is shorter than that has no original.
* A message replies to the earlier message that most of its outermost linked
  quotation (by normalised characters, then the later one) comes from; one
  without a linked quotation continues the message before it.
* Reply order: every message is followed by the replies to it.  Only messages
  that branch off (reply to another than the one before) open a new segment;
  paths of segments are composed by doubling, so that the number of rounds is
  the logarithm of their depth.

Conversations may be of any size: positions come from a distributed ordered
scan and originals from aggregates, never from a whole conversation in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.native_scan import positions, running_total

#: words of a run by which parts of passages are found
RUN = 6
MARKS = r"^(?:[ \t]*>)+"
# fixed values: how mail programs introduce a quotation
NAMING = r"^\s*(?:On .{1,200} wrote|Am .{1,200} schrieb.{0,100}|Le .{1,200} a écrit|El .{1,200} escribió)\s*:\s*$"


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def _body(line: Column) -> Column:
    return F.regexp_replace(line, MARKS + "[ \t]?", "")


def normalised(text: Column) -> Column:
    """Lower case, letters and digits only, single spaces between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _named(lines: Column, i: Column) -> Column:
    """Whether line ``i`` only names the author of the quotation that follows it."""
    after = F.get(lines, i + 1)
    return F.get(lines, i).rlike(NAMING) & F.coalesce(_level(after) > 0, F.lit(False))


def parse(messages: DataFrame) -> DataFrame:
    """Add ``_lines`` (all lines), ``_own`` (own lines) and ``clean`` (own text without blank edges)."""
    lines = F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), "\r?\n")
    own = F.filter(F.col("_lines"), lambda x, i: (_level(x) == 0) & ~_named(F.col("_lines"), i))
    return (messages.withColumn("_lines", lines).withColumn("_own", own)
            .withColumn("clean", F.regexp_replace(F.array_join("_own", "\n"), r"^\s+|\s+$", "")))


def _units(df: DataFrame, text: Column, *keep) -> DataFrame:
    """Hash and normalised length of each text that has any letter or digit."""
    return (df.withColumn("_n", normalised(text)).where(F.length("_n") > 0)
            .select(*keep, F.md5("_n").alias("unit"), F.length("_n").alias("size")))


def _pieces(df: DataFrame, text: str, *keep) -> DataFrame:
    """Units of the sentences and of the word runs of a text."""
    sentences = F.transform(F.split(text, r"[.!?]+(?:\s|$)|\n"), normalised)
    words = F.split(normalised(F.col(text)), " ")
    runs = F.when(F.size(words) >= RUN, F.transform(F.sequence(F.lit(1), F.size(words) - RUN + 1), lambda i: F.array_join(F.slice(words, i, F.lit(RUN)), " ")))
    each = F.filter(F.concat(sentences, F.coalesce(runs, F.array().cast("array<string>"))), lambda x: x != "")
    return (df.select(*keep, F.explode(F.array_distinct(each)).alias("_n"))
            .select(*keep, F.md5("_n").alias("unit"), F.length("_n").alias("size")))


def passages(parsed: DataFrame) -> DataFrame:
    """Quoted passages: ``_conv, _pos, passage, level, body`` with the body's lines joined by spaces."""
    quoted = parsed.where(F.exists("_lines", lambda x: _level(x) > 0))
    marked = F.transform("_lines", lambda x: F.struct(_level(x).alias("level"), _body(x).alias("body")))
    rows = (quoted.select("_conv", "_pos", F.posexplode(marked).alias("i", "l"), F.col("_lines"))
            .select("_conv", "_pos", "i", "l.level", "l.body", F.coalesce(_level(F.get("_lines", F.col("i") - 1)), F.lit(0)).alias("before"))
            .where("level > 0"))
    inside = Window.partitionBy("_conv", "_pos").orderBy("i")  # a message at a time
    return rows.withColumn("passage", F.sum(F.when(F.col("level") != F.col("before"), 1).otherwise(0)).over(inside)).drop("before")


def _originals(asked: DataFrame, said: DataFrame, keys) -> DataFrame:
    """Stored ``keys, size, origin``: the earliest message of the conversation that says each unit, where it is an earlier one."""
    wanted = asked.select(F.col("_conv").alias("c"), F.col("unit").alias("u")).distinct()
    same = said["_conv"].eqNullSafe(wanted["c"]) & (said["unit"] == wanted["u"])
    first = said.join(wanted, same, "left_semi").groupBy("_conv", "unit").agg(F.min("_pos").alias("origin"))
    first = first.select(F.col("_conv").alias("c"), F.col("unit").alias("u"), "origin")
    return materialize(asked.join(first, asked["_conv"].eqNullSafe(first["c"]) & (asked["unit"] == first["u"])
                                  & (first["origin"] < asked["_pos"])).select(*keys, "size", "origin"))


def link(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(parents, counts)``: per message the position it replies to by quotation, and its passages and linked passages."""
    lines = materialize(passages(parsed))
    whole = (lines.groupBy("_conv", "_pos", "passage", "level")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "body"))), lambda x: x["body"]), " ").alias("body")))
    keys = ("_conv", "_pos", "passage", "level")
    asked = _units(lines, F.col("body"), *keys).union(_units(whole, F.col("body"), *keys)).distinct()
    said = (_units(parsed.select("_conv", "_pos", F.explode("_own").alias("line")), F.col("line"), "_conv", "_pos")
            .union(_units(parsed, F.col("clean"), "_conv", "_pos")))
    found = _originals(asked, said, keys)
    # what is left is looked for in pieces, in the conversations that need it
    done = found.select(*[F.col(k).alias(f"d{k}") for k in keys[:3]]).distinct()
    left = materialize(whole.join(done, F.col("_conv").eqNullSafe(F.col("d_conv")) & (F.col("_pos") == F.col("d_pos")) & (F.col("passage") == F.col("dpassage")), "left_anti"))
    some = left.select(F.col("_conv").alias("c")).distinct()
    texts = parsed.select("_conv", "_pos", "clean").join(some, F.col("_conv").eqNullSafe(F.col("c")), "left_semi")
    found = found.union(_originals(_pieces(left, "body", *keys), _pieces(texts, "clean", "_conv", "_pos"), keys))
    votes = found.groupBy("_conv", "_pos", "level", "origin").agg(F.sum("size").alias("size"))
    parents = votes.groupBy("_conv", "_pos").agg(F.max(F.struct(-F.col("level"), "size", "origin"))["origin"].alias("parent"))
    n = whole.groupBy("_conv", "_pos").agg(F.count("*").alias("n_quoted"))
    linked = found.select("_conv", "_pos", "passage").distinct().groupBy("_conv", "_pos").agg(F.count("*").alias("n_linked"))
    n = n.select(F.col("_conv").alias("c"), F.col("_pos").alias("p"), "n_quoted")
    counts = (n.join(linked, n["c"].eqNullSafe(linked["_conv"]) & (n["p"] == linked["_pos"]), "left")
              .select("c", "p", "n_quoted", F.coalesce("n_linked", F.lit(0)).alias("n_linked")))
    return parents, counts


def segment_paths(segments: DataFrame) -> DataFrame:
    """``_conv, seg, path``: sort key of each segment in reply order.

    ``segments`` has ``_conv, seg, head, attach, up``: a segment begins at position
    ``head`` and replies to position ``attach`` of segment ``up`` (both null for the
    first).  Under one segment, replies to later messages come first, as the
    replies to a message follow it at once.
    """
    step = F.when(F.col("up").isNull(), F.array().cast("array<bigint>")).otherwise(
        F.array(-F.col("attach"), F.col("head")).cast("array<bigint>"))
    state = materialize(segments.select("_conv", "seg", F.col("up").alias("above"), step.alias("path")))
    while state.where("above is not null").limit(1).count():
        a = state.select(F.col("_conv").alias("c"), F.col("seg").alias("s"), F.col("above").alias("next"), F.col("path").alias("front"))
        state = materialize(
            state.join(a, state["_conv"].eqNullSafe(a["c"]) & (state["above"] == a["s"]), "left")
            .select("_conv", "seg", F.col("next").alias("above"),
                    F.concat(F.coalesce("front", F.array().cast("array<bigint>")), "path").alias("path")))
    return state.select("_conv", "seg", "path")


def reply_order(conversations: DataFrame) -> DataFrame:
    """One row per message: ``conv_id, position, turn, role, reply_to, n_quoted, n_linked, text``.

    ``position`` counts a conversation's messages in reply order from 1,
    ``reply_to`` is the turn answered (null for the first message), ``text`` is
    the message without quotations.  Messages of a null ``conv_id`` form one
    conversation; null turns come last; repeated rows are separate messages; a
    null text is an empty message; other columns are left out.
    """
    src = conversations.select(F.col("conv_id").alias("_conv"), "turn", "role", F.col("text").cast("string").alias("text"))
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.xxhash64("text")]
    messages = materialize(positions(src, "_conv", order, "_pos"))
    parsed = parse(messages)
    parents, counts = link(parsed)

    p = parents.select(F.col("_conv").alias("c"), F.col("_pos").alias("p"), "parent")
    linked = materialize(messages.select("_conv", "_pos", "turn").join(
        p, F.col("_conv").eqNullSafe(p["c"]) & (F.col("_pos") == p["p"]), "left")
        .select("_conv", "_pos", "turn", F.coalesce("parent", F.when(F.col("_pos") > 1, F.col("_pos") - 1)).alias("parent")))
    branch = F.col("parent").isNull() | (F.col("parent") != F.col("_pos") - 1)
    numbered = materialize(running_total(linked.withColumn("_head", branch.cast("bigint")), "_conv", [F.col("_pos").asc()], "_head", "seg"))

    at = numbered.select(F.col("_conv").alias("c"), F.col("_pos").alias("p"), F.col("seg").alias("up"), F.col("turn").alias("reply_to"))
    replies = numbered.join(at, numbered["_conv"].eqNullSafe(at["c"]) & (numbered["parent"] == at["p"]), "left").select(
        "_conv", "_pos", "seg", "_head", "parent", "up", "reply_to")
    replies = materialize(replies)
    paths = segment_paths(replies.where("_head = 1").select("_conv", "seg", F.col("_pos").alias("head"), F.col("parent").alias("attach"), "up"))
    paths = paths.select(F.col("_conv").alias("c"), F.col("seg").alias("s"), "path")
    placed = replies.join(paths, replies["_conv"].eqNullSafe(paths["c"]) & (replies["seg"] == paths["s"])).select(
        F.col("_conv").alias("c"), F.col("_pos").alias("p"), "reply_to", "path")
    clean = parsed.select("_conv", "_pos", "turn", "role", "clean")
    rows = clean.join(placed, clean["_conv"].eqNullSafe(placed["c"]) & (clean["_pos"] == placed["p"])).drop("c", "p")
    rows = rows.join(counts, rows["_conv"].eqNullSafe(counts["c"]) & (rows["_pos"] == counts["p"]), "left").drop("c", "p")
    out = positions(rows, "_conv", [F.col("path").asc(), F.col("_pos").asc()], "position")
    return out.select(F.col("_conv").alias("conv_id"), "position", "turn", "role", "reply_to",
                      F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
                      F.col("clean").alias("text"))
