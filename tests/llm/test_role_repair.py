import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from cohortlens.llm import role_repair
from cohortlens.llm.common import table
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
LEGAL = re.compile("(s?(ua)+)?")
BEGUN = re.compile("s?(ua)*u?")
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """The first fault of each row of (turn, role, text) in order."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall("[^\\x20\\x09-\\x0d]", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """All edits of all rows, cut only where the roles so far cannot begin a legal conversation."""
    marks, best = faults(rows), None

    def follow(i, cost, audit, made):
        nonlocal best
        initials = "".join(role[:1] if role else "?" for role, _ in made)
        if not BEGUN.fullmatch(initials) or best and cost > best[0]:
            return
        if i == len(rows):
            if LEGAL.fullmatch(initials) and (best is None or (cost, audit) < best[:2]):
                best = cost, audit, "\n".join(f"{r}:{t}" for r, t in made)
        else:
            (_, role, text), mark = rows[i], marks[i]
            follow(i + 1, cost + 3, audit + "D", made)
            if mark in ("", "truncated"):
                extra = mark == "truncated"
                follow(i + 1, cost + extra, audit + "K", [*made, (role, text)])
                for new in NAMES.values():
                    follow(i + 1, cost + 2 + extra, audit + "R", [*made, (new, text)])
        if len(audit) - sum(c != "I" for c in audit) < len(rows) + 2:
            for new in NAMES.values():
                follow(i, cost + 2, audit + "I", [*made, (new, "")])

    follow(0, 0, "", [])
    return best


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    marks = faults(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    cost, audit, text = cheapest(rows)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest), text


def damage(rows):
    name = lambda v: " " if v is None else str(v)
    out = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        made = [(turn, name(role) if kind != 4 else "user", {1: "", 2: re.sub("[.!?]", "", name(text))}.get(kind, name(text)))]
        out.setdefault(conv, []).extend(made * {0: 0, 3: 2}.get(kind, 1))
    return out


def results(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_all_conversations(spark):
    given = damage([tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()])
    got = results(QUERIES["op11_role_repair"](spark, SF))
    assert got.keys() == given.keys()
    assert {c: expected(rows)[0] for c, rows in given.items()} == got


def test_every_short_sequence_of_roles():
    """All conversations of up to four rows over roles and faults, against all edits."""
    repairs = role_repair.Repairs()
    kinds = [(r, t) for r in ("system", "user", "assistant", "tool") for t in ("Yes.", "no")] + [("user", " ")]
    draw = random.Random(11)
    given = [c for n in range(3) for c in product(kinds, repeat=n)]
    given += [tuple(draw.choices(kinds, k=n)) for n in (3, 4, 5) for _ in range(150)]
    for rows in given:
        held = role_repair.Conversation(repairs)
        seen = set()
        numbered = [(i, r, f"{i % 3}{t}" if t.strip() else t) for i, (r, t) in enumerate(rows)]
        for turn, role, text in numbered:
            held.add(turn, role, text, (role, text) in seen)
            seen.add((role, text))
        assert held.result() == expected(numbered)[0], rows


def test_another_grammar():
    """Left recursion with an optional tool turn; costs of its own."""
    settings = role_repair.Settings(
        rules=(("C", ""), ("C", "T"), ("T", "P"), ("T", "TP"), ("P", "ua"), ("P", "uta")), rerole=5, insert=1, delete=4
    )
    repairs = role_repair.Repairs(settings)

    def audit(*roles):
        held = role_repair.Conversation(repairs)
        for i, role in enumerate(roles):
            held.add(i, role, f"{i}.", False)
        return held.result()[5:7]

    assert audit("user", "tool", "assistant") == (0, "KKK")
    assert audit("tool", "assistant", "user") == (2, "IKKKI")
    assert audit() == (0, "")


def test_long_conversation_is_packed_in_segments():
    repairs, held = role_repair.Repairs(), None
    held = role_repair.Conversation(repairs)
    for i in range(20_000):
        held.add(i, "user" if i % 2 == 0 else "assistant", f"{i}.", False)
    result = held.result()
    assert result[5] == 0 and result[6] == "K" * 20_000
    text = "\n".join(f"{'user' if i % 2 == 0 else 'assistant'}:{i}." for i in range(20_000))
    assert result[7] == hashlib.sha256(text.encode()).hexdigest()


ODD = [
    (1, None, "user", "a."), (1, None, "user", "a."), (1, 0, None, "b."), (1, 9, "assistant", None),
    (None, 0, "system", "s."), (None, 0, "user", "q?"), (None, 5, "user", "q?"), (None, None, "", "x!"),
    (2, 3, "user", ""), (3, 0, "assistant", "z" * 200_000), (3, 0, "assistant", "z" * 200_000),
]


@pytest.fixture
def odd(frame):
    made = frame(ODD, "conv_id long, turn long, role string, text string")
    return made.withColumns({"seen": made.conv_id, "there": made.turn, "audit": made.role})


def filled(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return out


def test_odd_rows(odd):
    got = results(role_repair.repair(odd))
    assert got == {c: expected(rows)[0] for c, rows in filled(ODD).items()}
    assert role_repair.repair(odd.limit(0)).collect() == []
    assert results(role_repair.repair(role_repair.damaged(odd))) == {c: expected(r)[0] for c, r in damage(ODD).items()}


def test_dropped_rows_leave_their_conversation(spark):
    rows = spark.createDataFrame([(7, 0, "user", "a.", True)], "conv_id long, turn long, role string, text string, dropped boolean")
    empty = hashlib.sha256(b"").hexdigest()
    assert results(role_repair.repair(rows)) == {7: (0, 0, 0, 0, 0, 0, "", empty)}


def test_repaired_turns_are_the_digested_text(spark, odd):
    for rows in (role_repair.damaged(table(spark, SF, "conversations")), odd):
        repaired = role_repair.repair(rows).cache()
        turns = {}
        for r in role_repair.repaired_turns(rows, repaired).collect():
            turns.setdefault(r.conv_id, []).append((r.turn, f"{r.role}:{r.text}"))
        for r in repaired.collect():
            own = sorted(turns.get(r.conv_id, []))
            assert [t for t, _ in own] == list(range(len(own)))
            assert hashlib.sha256("\n".join(t for _, t in own).encode()).hexdigest() == r.repaired_sha256
