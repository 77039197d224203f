import hashlib
import itertools
import random
import zlib
from functools import lru_cache

import pytest

from cardgeo.llm import dialogue as d

SPACE = " \t\n\x0b\x0c\r"
ROWS = [  # conv, turn, role, text
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "Late?"), (2, 1, "user", "cut off"),
    (3, 0, "system", "Be kind."), (4, None, None, None), (4, None, "user", "No turn."), (4, 5, "assistant", "x."),
    (None, 1, "user", "A."), (None, 2, "assistant", "A."), (5, 1, "user", "same."), (5, 1, "user", "same."),
    (5, 9, "user", "same."), (6, 1, "tool", "odd."), (6, 2, "user", " \n "), (6, 4, "", "é" * 5000 + "! "),
    (7, -2 ** 63, "user", "low."), (7, 2 ** 63 - 1, "assistant", "high."), (8, 0, "umbrella", "u?"), (8, 1, "ant", "a!"),
]


def made(n, seed):
    r = random.Random(seed)
    out = []
    for conv in range(100, 100 + n):
        for turn in range(r.randint(1, 6)):
            out.append((conv, r.choice([turn, turn, turn, turn + 1, None]), r.choice(["user", "assistant", "system", "tool"]),
                        r.choice(["yes.", "no", "", "  ", "ok!", f"t{turn}", "same."])))
    return out


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        x = zlib.crc32(key.encode()) % 20
        if x == 0:
            continue
        text = "" if x == 1 else "".join(c for c in text if c not in ".!?") if x == 2 else text
        out += [(conv, turn, "user" if x == 4 else role, text)] * (2 if x == 3 else 1)
    return out


def brute(rows):
    """All edit strings of a conversation, cheapest and then least first."""
    rows = sorted(((r[1] is not None, r[1] or 0), r[2], r[3]) for r in rows)
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(SPACE)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else
                      "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    n = len(rows)

    @lru_cache(None)
    def best(i, place, inserted):  # place: initials so far, folded
        ends = [(0, "", ())] if i == n and place in ("", "a") else []
        nexts = {"": "u", "s": "u", "u": "a", "a": "u"}
        to = nexts[place]
        if inserted < 3:
            c, a, m = best(i, to, inserted + 1)
            ends.append((c + 3, "I" + a, ((d.ROLE[to], ""),) + m))
        if i < n:
            c, a, m = best(i + 1, place, 0)
            ends.append((c + 4, "D" + a, m))
            if faults[i] not in ("blank", "duplicate"):
                more, (_, role, text) = 3 * (faults[i] == "truncated"), rows[i]
                if role[:1] == to or role[:1] == "s" and place == "":
                    c, a, m = best(i + 1, role[0], 0)
                    ends.append((c + more, "K" + a, ((role, text),) + m))
                c, a, m = best(i + 1, to, 0)
                ends.append((c + 3 + more, "R" + a, ((d.ROLE[to], text),) + m))
        return min(ends) if ends else (10 ** 9, "~", ())

    cost, audit, messages = best(0, "", 0)
    turns = {t for (has, t), _, _ in rows if has}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    gaps = (gaps + 2 ** 63) % 2 ** 64 - 2 ** 63
    illegal = sum(a[1][:1] + b[1][:1] not in d.LEGAL for a, b in itertools.pairwise(rows))
    return (gaps, *(faults.count(f) for f in d.FAULTS[1:]), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in messages).encode()).hexdigest())


def by_conversation(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


COLUMNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk", [d.CHUNK, 2])  # whole in memory; backpointers leave the task
def test_against_all_edits(spark, chunk):
    rows = ROWS + made(120, 1)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS + ", k string, audit int").repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in d.repair_report(df, d.damage(df), chunk=chunk).collect()}
    after = by_conversation(damaged(rows))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got == {c: brute(after[c]) if c in after else nothing for c in by_conversation(rows)}
    assert sum(c not in after for c in got) > 0


def test_undamaged_rows(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    got = {r.conv_id: tuple(r)[1:] for r in d.repair_report(df, df).collect()}
    spaced = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in ROWS]
    assert got == {c: brute(r) for c, r in by_conversation(spaced).items()}
    assert got[1][6] == "KK" and got[3][6] == "D" and got[8][6] == "KK"


def test_damage_by_rule(spark):
    rows = ROWS + made(60, 2)
    got = d.damage(spark.createDataFrame(rows, COLUMNS))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, damaged(rows)))


def test_messages_of_the_plan(spark):
    df = spark.createDataFrame(ROWS + made(40, 3), COLUMNS)
    plans = d.plan_repairs(df)
    audits = {r.k: r.audit for r in plans.collect()}
    of = {}
    for r in d.repaired(df, plans).orderBy("k", "position").collect():
        of.setdefault(r.k, []).append(r)
    for k, audit in audits.items():
        rows = of.get(k, [])
        assert [r.position for r in rows] == list(range(len(rows)))
        assert "".join(r.edit for r in rows) == audit.replace("D", "")
        initials = "".join(r.role[0] for r in rows)
        body = initials[1:] if initials[:1] == "s" else initials
        assert (body or not initials) and body == "ua" * (len(body) // 2)


def test_giant_conversation(spark):
    """Longer than an Arrow batch and than many chunks of backpointers."""
    rows = spark.range(30000).selectExpr("1L as conv_id", "id as turn", "if(id % 7 = 3, 'user', if(id % 2 = 0, 'user', 'assistant')) as role",
                                         "concat('text ', id, if(id % 11 = 5, '', '.')) as text")
    a, b = (d.repair_report(rows, rows, chunk=c).first() for c in (d.CHUNK, 1000))
    assert a == b and len(a.audit) >= 30000 and a.truncated == sum(i % 11 == 5 for i in range(30000))
    program, state, cost = d.Program(), 0, 0
    for i in range(30000):
        state, more, _ = program.step(state, "u" if i % 7 == 3 or i % 2 == 0 else "a", 3 if i % 11 == 5 else 0)
        cost += more
    assert a.cost == cost + program.finish(state)[0] and len(program.states) < 200


def test_empty_table(spark):
    df = spark.createDataFrame([], COLUMNS)
    assert d.repair_report(df, d.damage(df)).collect() == []
