"""Conversation repair (op11) against all edits of small conversations and a plain pass over states."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from daybook.llm import conversations as C

GRAMMAR = re.compile(r"(s?(ua)+)?")


def all_edits(turns):
    """Least (cost, audit) by trying every edit sequence with few inserts (turns as align takes them, x included)."""
    best = None
    n = len(turns)
    for inserts in range(4):
        for where in itertools.combinations_with_replacement(range(n + 1), inserts):
            for ops in itertools.product("DKR", repeat=n):
                audit, made, cost, after = [], [], 0, []
                for i in range(n + 1):
                    # inserts may stand before or after the deletes around them: all orders of a gap's letters
                    audit.append(("I" * where.count(i), ops[i] if i < n else ""))
                letters = "".join(a + b for a, b in audit)
                flat, roles = [], [[]]
                for a, b in audit:
                    flat += ["I"] * len(a)
                    if b:
                        flat.append(b)
                at, options = 0, [""]
                for x in flat:
                    if x == "I":
                        options = [o + r for o in options for r in "ua"]
                        cost += 5
                        continue
                    t = turns[at]
                    at += 1
                    if x == "D":
                        cost += 2
                    elif t == "x":
                        options = []
                    else:
                        options = [o + (t.lower() if x == "K" else r) for o in options for r in ("u" if x == "K" else "ua")]
                        cost += (x == "R") + 5 * t.isupper()
                if any(GRAMMAR.fullmatch(o) for o in options) and (best is None or (cost, letters) < best):
                    best = (cost, letters)
    return best


def by_states(turns):
    """The same by one pass over grammar states."""
    def inserted(reached):
        for _ in range(3):
            for st, (c, a) in list(reached.items()):
                for to in {"": "u", "s": "u", "u": "a", "a": "u"}[st]:
                    way = (c + 5, a + "I")
                    if to not in reached or way < reached[to]:
                        reached[to] = way
        return reached

    reached = {"": (0, "")}
    for t in turns:
        reached = inserted(dict(reached))
        after = {}
        for st, (c, a) in reached.items():
            ways = [(st, c + 2, a + "D")]
            if t != "x":
                extra = 5 * t.isupper()
                step = {"": "su", "s": "u", "u": "a", "a": "u"}[st]
                if t.lower() in step:
                    ways.append((t.lower(), c + extra, a + "K"))
                to = step[-1]
                if to != t.lower():
                    ways.append((to, c + 1 + extra, a + "R"))
            for to, cost, audit in ways:
                if to not in after or (cost, audit) < after[to]:
                    after[to] = (cost, audit)
        reached = after
    reached = inserted(dict(reached))
    return min(reached[e] for e in ("", "a") if e in reached)


def test_states_equal_all_edits():
    for n in range(4):
        for turns in itertools.product("suaoUAx", repeat=n):
            assert by_states(turns) == all_edits("".join(turns)), turns


def test_alignment_equals_states(monkeypatch):
    rng = random.Random(1)
    for k in range(4_000):
        turns = "".join(rng.choice("suaoSUAOx" if k % 2 else "uauauUAx") for _ in range(rng.randrange(0, 14)))
        assert C.final(C.extend({"": (0, "")}, turns)) == by_states(turns), turns
    monkeypatch.setattr(C, "BLOCK", 3)  # the same by blocks
    for k in range(2_000):
        turns = "".join(rng.choice("suaoSUAOx" if k % 2 else "uauauUAx") for _ in range(rng.randrange(0, 14)))
        assert C.final(C.extend({"": (0, "")}, turns)) == by_states(turns), turns


def test_long_conversations_by_blocks():
    rng = random.Random(2)
    turns = "".join(rng.choice("uauaUAx") for _ in range(700))
    assert C.final(C.extend({"": (0, "")}, turns)) == by_states(turns)
    assert C.final(C.extend({"": (0, "")}, "u" * 300)) == by_states("u" * 300)


def brute(rows):
    """The contract, conversation by conversation, in plain Python."""
    out = []
    for conv in {r[0] for r in rows}:
        own = []
        for c, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if v is None else v for v in (role, text))
            d = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if d == 1:
                text = ""
            elif d == 2:
                text = re.sub("[.!?]", "", text)
            elif d == 4:
                role = "user"
            own += [(turn, role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        turns = {r[0] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        marks, seen, count = "", set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            body = re.sub(r"[\x20\x09-\x0D]", "", text)
            initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if not body:
                count["blank"] += 1
                marks += "x"
            elif (role, text) in seen:
                count["duplicate"] += 1
                marks += "x"
            elif body[-1] not in ".!?":
                count["truncated"] += 1
                marks += initial.upper()
            else:
                marks += initial
            seen.add((role, text))
        initials = [r[1][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = by_states(marks)
        lines, at, state = [], 0, ""
        for x in audit:
            if x == "D":
                at += 1
                continue
            step = "a" if state == "u" else "u"
            if x == "I":
                lines.append({"u": "user:", "a": "assistant:"}[step])
                state = step
                continue
            role, text = own[at][1:]
            at += 1
            if x == "R":
                role = {"u": "user", "a": "assistant"}[step]
            state = role[0]
            lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *count.values(), illegal, cost, audit, digest))
    return out


def table(rng, large):
    texts = ["One.", "Two!", "", " \t\n", "no end", "tail. ", "déjà vu?", "long. " * 40, "x" * 70_000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown", "User"]
    rows = []
    for conv in [*range(40), None, -3]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(roles), rng.choice([*texts, None])))
    for i in range(large):
        rows.append((1_000, i + 3 * (i // 50) if i % 97 else None, ("user", "assistant")[i % 2], f"turn {i % 700} of it" + ".!?x"[i % 4]))
    rows += [(1_000, 5, "user", "again and again.")] * (large // 3)
    rows += rows[:30]
    return rows


@pytest.mark.parametrize("large", [0, 2_000])
def test_repair_equals_brute_force(spark, large):
    rows = table(random.Random(large), large)
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, copies int, __x string")
    got = [tuple(r) for r in C.repair(C.damaged(df)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_empty_and_dropped(spark):
    schema = "conv_id string, turn long, role string, text string"
    assert C.repair(C.damaged(spark.createDataFrame([], schema))).collect() == []
    gone = next(str(i) for i in range(1_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = C.repair(C.damaged(spark.createDataFrame([(gone, 0, "user", "x")], schema))).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
