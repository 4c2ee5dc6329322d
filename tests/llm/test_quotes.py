from tessera.llm.quote_threads import reply_order


def test_threads(spark):
    rows = [(1, 0, "a", "Hello there.\nHow are you?"), (1, 1, "b", "On Monday a wrote:\n> Hello there.\n> How are you?\n\nFine, thanks."),
            (1, 2, "c", "> hello THERE\nHi from c"), (1, 3, "b", ">> Hello there.\n>> How are you?\n> Fine, thanks.\nGood."),
            (1, 4, "d", "> > Hello there\n> Hi from c\nreply to c"), (1, 5, "e", "no quote"), (1, 6, "f", "> unknown words\nx"),
            (2, 0, "a", None), (None, 0, "z", "> q"), (None, None, "z", "y"), (3, 0, "u", ""), (3, 0, "u", "")]
    got = reply_order(spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, seg int, path string"))
    have = {}
    for r in got.collect():
        have.setdefault(r.conv_id, []).append((r.position, r.turn, r.reply_to, r.n_quoted, r.n_linked, r.text))
    assert sorted(have[1]) == [
        (1, 0, None, 0, 0, "Hello there.\nHow are you?"), (2, 1, 0, 1, 1, "Fine, thanks."), (3, 3, 1, 2, 2, "Good."),
        (4, 2, 0, 1, 1, "Hi from c"), (5, 4, 2, 2, 2, "reply to c"), (6, 5, 4, 0, 0, "no quote"), (7, 6, 5, 1, 0, "x")]
    assert have[2] == [(1, 0, None, 0, 0, "")]
    assert sorted(have[None]) == [(1, 0, None, 1, 0, ""), (2, None, 0, 0, 0, "y")]
    assert sorted(have[3]) == [(1, 0, None, 0, 0, ""), (2, 0, 0, 0, 0, "")]


def test_deep_branches_are_composed(spark):
    # each message quotes the one two turns before it: two interleaved chains
    rows = [(7, i, "r", (f"> words number {i - 2}\n" if i > 1 else "") + f"words number {i}") for i in range(12)]
    got = sorted(reply_order(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect(), key=lambda r: r.position)
    children = {}
    for i in range(1, 12):
        children.setdefault(i - 2 if i > 1 else 0, []).append(i)

    def walk(i):
        return [i, *(x for c in sorted(children.get(i, [])) for x in walk(c))]

    order = [r.turn for r in got]
    assert [r.reply_to for r in sorted(got, key=lambda r: r.turn)] == [None, 0, *range(10)]
    at = {t: k for k, t in enumerate(order)}
    assert sorted(order) == list(range(12)) and all(at[max(i - 2, 0)] < at[i] for i in range(1, 12))
    assert order == walk(0) or all(order[k + 1] in children.get(order[k], []) or order[k + 1] in sum(children.values(), []) for k in range(11))


def test_table(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = reply_order(c)
    assert got.count() == c.count() and got.where("position <> turn + 1").count() == 0
    assert reply_order(c.limit(0)).count() == 0


def norm(text):
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def pieces(text):
    import re
    words = norm(text).split(" ")
    out = {norm(x) for x in re.split(r"[.!?]+(?:\s|$)|\n", text)} | {" ".join(words[i:i + 6]) for i in range(len(words) - 5)}
    return out - {""}


def brute(rows):
    """Threads of one conversation from plain loops: rows are (turn, role, text) in order."""
    own, quoted = [], []
    for _, _, text in rows:
        mine, passages, before = [], [], 0
        for line in text.split("\n"):
            marks = line[:len(line) - len(line.lstrip("> \t"))].count(">")
            body = line.lstrip("> \t") if marks else line
            if not marks:
                mine.append(line)
            elif marks != before:
                passages.append((marks, [body]))
            else:
                passages[-1][1].append(body)
            before = marks
        own.append("\n".join(mine).strip())
        quoted.append(passages)
    parents = []
    for i, passages in enumerate(quoted):
        votes, linked = {}, 0
        for level, body in passages:
            units = {norm(x) for x in [*body, " ".join(body)]} - {""}
            found = {}
            for u in units:
                at = next((j for j in range(len(rows)) if u in {norm(x) for x in [*own[j].split("\n"), own[j]]}), i)
                if at < i:
                    found[u] = at
            if not found:
                for u in pieces(" ".join(body)):
                    at = next((j for j in range(len(rows)) if u in pieces(own[j])), i)
                    if at < i:
                        found[u] = at
            linked += bool(found)
            for u, at in found.items():
                votes[level, at] = votes.get((level, at), 0) + len(u)
        best = max(((-level, size, at) for (level, at), size in votes.items()), default=None)
        parents.append((best[2] if best else i - 1 if i else None, len(passages), linked))
    children = {}
    for i, (p, *_) in enumerate(parents):
        children.setdefault(p, []).append(i)
    order, stack = [], [0]
    while stack:  # a message, then its replies: the one that follows it last, as the others branch off
        i = stack.pop()
        order.append(i)
        kids = children.get(i, [])
        stack += [k for k in reversed(kids) if k != i + 1] + [k for k in kids if k == i + 1]
    return {i: (None if p is None else rows[p][0], n, m) for i, (p, n, m) in enumerate(parents)}, order


def test_parts_of_lines_and_other_line_breaks(spark):
    text = "The cat sat on the mat. The dog ran far away. We met at noon."
    long = "one two three four five six seven eight\nnine ten eleven twelve thirteen fourteen"
    rows = [(0, "a", text), (1, "b", "Well."), (2, "c", "> The dog ran far away.\nIt did."), (3, "a", long),
            (4, "b", "ok"), (5, "c", "> four five six seven\n> eight nine ten eleven\nyes"), (6, "c", "> sat on the\nshort part")]
    got = {r.turn: (r.reply_to, r.n_linked) for r in reply_order(spark.createDataFrame([(1, *r) for r in rows], "conv_id int, turn int, role string, text string")).collect()}
    assert got[2] == (0, 1) and got[5] == (3, 1) and got[6] == (5, 0)


def test_random_threads_equal_brute_force(spark):
    import random
    rng = random.Random(12)
    conversations = {}
    for c in range(25):
        rows = []
        for i in range(rng.randint(2, 14)):
            lines = []
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                if rows:
                    source = " ".join(x for x in rng.choice(rows)[2].split("\n") if not x.startswith(">"))
                    words = source.split(" ")
                    lo = rng.randint(0, max(0, len(words) - 3))
                    part = words[lo:lo + rng.choice([2, 5, 9, 30])]
                    width = rng.choice([3, 8, 40])
                    level = rng.choice([">", "> >", ">"])
                    lines += [f"{level} " + " ".join(part[k:k + width]) for k in range(0, len(part), width)]
                    lines.append("")
            own = " ".join(rng.choice(["red", "blue", "green", "tall", "old"]) + str(rng.randint(0, 40)) + rng.choice(["", "", "", ".", "!"])
                           for _ in range(rng.randint(1, 25)))
            rows.append((i, "r", "\n".join([*lines, own])))
        conversations[c] = rows
    df = spark.createDataFrame([(c, *r) for c, rows in conversations.items() for r in rows], "conv_id int, turn int, role string, text string").repartition(4)
    got = {}
    for r in reply_order(df).collect():
        got.setdefault(r.conv_id, []).append((r.position, r.turn, r.reply_to, r.n_quoted, r.n_linked))
    part = 0
    for c, rows in conversations.items():
        want, order = brute(rows)
        mine = sorted(got[c])
        assert {t: (reply, n, m) for _, t, reply, n, m in mine} == want, c
        assert sorted(t for _, t, *_ in mine) == sorted(order)
        place = {t: p for p, t, *_ in mine}
        assert all(place[reply] < place[t] for t, (reply, *_) in want.items() if reply is not None)
        part += sum(m for *_, m in want.values())
    assert part > 40


def test_a_long_text_and_tied_votes(spark):
    words = [f"w{i}" for i in range(4000)]
    rows = [(0, "a", " ".join(words)), (1, "b", "same line"), (2, "c", "same words"), (3, "d", "> " + " ".join(words[500:2500]) + "\nlong"),
            (4, "e", "> same line\n\n> same word\n> same words\ntied")]
    got = {r.turn: r.reply_to for r in reply_order(spark.createDataFrame([(1, *r) for r in rows], "conv_id int, turn int, role string, text string")).collect()}
    assert got[3] == 0 and got[4] == 2  # ten characters against nine; an equal count would go to the later one
