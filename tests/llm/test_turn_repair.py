import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm import turn_repair
from tessera.llm.turn_repair import damage, repair, repaired_digests

SOLID = re.compile(r"[^\x20\x09-\x0D]")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        here = out[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = SOLID.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def by_dp(rows, faults):
    """Lightest (cost, audit, repaired) by relaxing a table until nothing changes: initials so far are a state of the pattern."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    names = {"u": "user", "a": "assistant"}
    table = {"": (0, "", ())}

    def inserts(t):
        t = dict(t)
        for _ in range(8):
            for q, (c, w, o) in list(t.items()):
                for x in "ua":
                    if x in moves[q]:
                        v = (c + 5, w + "I", o + ((names[x], ""),))
                        if moves[q][x] not in t or v[:2] < t[moves[q][x]][:2]:
                            t[moves[q][x]] = v
        return t

    for (_, role, text), fault in zip(rows, faults):
        table, new = inserts(table), {}
        for q, (c, w, o) in table.items():
            options = [(q, c + 2, w + "D", o)]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] in moves[q]:
                    options.append((moves[q][role[:1]], c + extra, w + "K", o + ((role, text),)))
                options += [(moves[q][x], c + 1 + extra, w + "R", o + ((names[x], text),)) for x in "ua" if x in moves[q]]
            for r, *v in options:
                if r not in new or tuple(v[:2]) < new[r][:2]:
                    new[r] = tuple(v)
        table = new
    table = inserts(table)
    return min(table[q] for q in ("", "a") if q in table)


def by_enumeration(rows, faults, most=2):
    """Lightest (cost, audit) over all audits with at most ``most`` insertions."""
    best = None
    n = len(rows)
    for inserts in range(most + 1):
        for where in itertools.combinations(range(n + inserts), inserts):
            for ops in itertools.product("DKR", repeat=n):
                it = iter(range(n))
                for new in itertools.product("ua", repeat=inserts + ops.count("R")):
                    it, pick = iter(range(n)), iter(new)
                    audit, initials, cost = "", "", 0
                    for k in range(n + inserts):
                        if k in where:
                            audit, initials, cost = audit + "I", initials + next(pick), cost + 5
                            continue
                        i = next(it)
                        op = ops[i]
                        audit += op
                        if op == "D":
                            cost += 2
                            continue
                        if faults[i] in ("blank", "duplicate"):
                            cost += 10 ** 6
                        cost += (op == "R") + 5 * (faults[i] == "truncated")
                        initials += rows[i][1][:1] if op == "K" else next(pick)
                    if PATTERN.fullmatch(initials) and (best is None or (cost, audit) < best):
                        best = cost, audit
    return best


def brute(rows):
    original = {r[0] for r in rows}
    out, data = [], damaged(rows)
    for conv in original:
        r = data.get(conv, [])
        f = faults_of(r)
        turns = [t for t, *_ in r if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = Counter(f)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(r, r[1:]))
        cost, audit, kept = by_dp(r, f)
        text = "\n".join(f"{a}:{b}" for a, b in kept)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


def result(df):
    return Counter((r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect())


def made(seed, conversations, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "assistant", "user", "tool", "", None]
    texts = ["Yes.", "No!", "what", " \t\n", "", None, "Fine. ", "é漢。", "a\nb?", "cut off, "]
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, most)):
            rows.append((c if c else None, rng.choice([t, t, t + 1, t * 2, None]), rng.choices(roles, [6, 6, 1, 1, 1, 1, 1, 1])[0], rng.choice(texts)))
    return rows + rows[:3]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def test_equal_to_brute_force(spark):
    rows = made(4, 150, 9)
    assert result(repaired_digests(frame(spark, rows))) == brute(rows)


def test_conversations_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "BLOCK", 4)
    monkeypatch.setattr(turn_repair, "FAN", 3)
    rows = made(8, 12, 60)
    assert len(rows) > 4 * 3 * 3 * 3
    assert result(repaired_digests(frame(spark, rows))) == brute(rows)


def test_the_table_equals_enumeration():
    rng = random.Random(2)
    for _ in range(60):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", " "])) for i in range(rng.randint(0, 4))]
        faults = faults_of(rows)
        cost, audit, _ = by_dp(rows, faults)
        assert (cost, audit) == by_enumeration(rows, faults)


def test_repaired_rows(spark):
    rows = [(1, t, role, f"{t}.") for t, role in enumerate(["system", "assistant", "user", "user", "assistant"])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", n bigint")
    summary, left = repair(df)
    assert (summary.first().cost, summary.first().audit) == (2, "KRRKK")
    initials = "".join(r.role[0] for r in left.orderBy("at", "sub").collect())
    assert PATTERN.fullmatch(initials)


@pytest.mark.parametrize("n", [1, 700])
def test_repeated_rows(spark, n):
    rows = [(7, 2, "user", "Hello.")] * n + [(7, 3, "assistant", "Yes.")]
    assert result(repaired_digests(frame(spark, rows))) == brute(rows)


def test_empty_table_and_extra_columns(spark):
    assert repaired_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = made(1, 5, 4)
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA + ", n bigint, digest string, at int, node int")
    assert result(repaired_digests(df)) == brute(rows)
    assert damage(df).columns == ["conv_id", "turn", "role", "text", "n"]
