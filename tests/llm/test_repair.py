"""Conversation repair against exhaustive search and a set of rules stated plainly."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from candlewick.llm import repair
from tests.llm.common import AWKWARD, with_extras

SCHEMA = "conv_id long, turn long, role string, text string"
SHOWN = re.compile("[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, lines) by a table over the last role that compares whole strings."""
    def add(table, key, cand):
        if key not in table or cand[:2] < table[key][:2]:
            table[key] = cand

    table = {"": (0, "", ())}

    def insert(table):
        for _ in range(3):
            for key, (c, a, out) in list(table.items()):
                t = "a" if key == "u" else "u"
                add(table, t, (c + 3, a + "I", out + (("user" if t == "u" else "assistant") + ":",)))

    for role, text, must_go, truncated in rows:
        insert(table)
        new = {}
        for key, (c, a, out) in table.items():
            add(new, key, (c + 4, a + "D", out))
            if not must_go:
                more = 3 if truncated else 0
                t = "a" if key == "u" else "u"
                add(new, t, (c + 3 + more, a + "R", out + (("user" if t == "u" else "assistant") + ":" + text,)))
                i = role[:1]
                if (i == "s" and key == "") or (i == "u" and key != "u") or (i == "a" and key == "u"):
                    add(new, i, (c + more, a + "K", out + (role + ":" + text,)))
        table = new
    insert(table)
    return min(table[k] for k in ("", "a") if k in table)


def all_paths(rows):
    """Every edit path with at most two inserts in a gap (small inputs only)."""
    found = []

    def go(i, state, cost, audit, room):
        if i == len(rows) and (state == "" or state == "a"):
            found.append((cost, audit))
        if room:
            go(i, "a" if state == "u" else "u", cost + 3, audit + "I", room - 1)
        if i == len(rows):
            return
        role, _, must_go, truncated = rows[i]
        more = 3 if truncated else 0
        go(i + 1, state, cost + 4, audit + "D", 2)
        if not must_go:
            go(i + 1, "a" if state == "u" else "u", cost + 3 + more, audit + "R", 2)
            k = role[:1]
            if (k == "s" and state == "") or (k == "u" and state != "u") or (k == "a" and state == "u"):
                go(i + 1, k, cost + more, audit + "K", 2)

    go(0, "", 0, "", 2)
    return min(found)


def decided(rows, block):
    r = repair.Repair(block=block)
    for role, text, must_go, truncated in rows:
        r.add(None, role, text, must_go, False, truncated)
    out = r.finish()
    return out["cost"], out["audit"], out["repaired_sha256"]


def made(rnd, n):
    roles = ["system", "user", "assistant", "tool", "", "s", "User", "a"]
    return [(rnd.choice(roles), rnd.choice(["x.", "y", "z!"]), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(n)]


def sha(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_integer_minimum_equals_exhaustive_search():
    rnd = random.Random(5)
    for _ in range(150):
        rows = made(rnd, rnd.randint(0, 5))
        cost, audit, lines = cheapest(rows)
        assert (cost, audit) == all_paths(rows)
        for block in (1, 2, 64):
            assert decided(rows, block) == (cost, audit, sha(lines))


def test_long_conversations_in_blocks():
    rnd = random.Random(6)
    cases = [made(rnd, 400) for _ in range(4)]
    cases.append([("tool", "t.", False, False)] * 301)           # paths that never meet
    cases.append([("system", "t.", False, True)] * 200 + [("user", "q.", False, False)])
    for rows in cases:
        cost, audit, lines = cheapest(rows)
        for block in (7, 64, 1000):
            assert decided(rows, block) == (cost, audit, sha(lines))


def brute(table, damaged):
    convs = {}
    for conv, turn, role, text in table:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        rows = convs.setdefault(conv, [])
        if not damaged:
            rows.append((turn, role, text))
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        rows.extend([(turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1))
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, facts, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            shown = SHOWN.findall(text)
            fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            facts.append((role, text, fault < 2, fault == 2))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, lines = cheapest(facts)
        out.append((conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha(lines), lines))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0))


def conversations(n=120, seed=2):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, 9)):
            rows.append((c, t * rnd.choice([1, 1, 2]), rnd.choice(["user", "assistant", "system", "tool", None, ""]),
                         rnd.choice(["Hi.", "why", "ok!", "\t \n", "é?", None, "A. B", *AWKWARD])))
    rows += [(None, 0, "user", "q?"), (None, None, "assistant", "a."), (7000, None, None, None)]
    rows += [(8000, 3, "user", "same.")] * 5
    return rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_table_equals_brute_force(spark):
    table = conversations()
    df = spark.createDataFrame(table, SCHEMA)
    for damaged in (True, False):
        want = brute(table, damaged)
        given = repair.damage(df) if damaged else df
        got = repair.repair(given)
        assert rows_of(got) == [w[:9] for w in want]
        turns = {}
        for r in repair.repaired_turns(given, got).orderBy("conv_id", "position").collect():
            turns.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
        assert turns == {w[0]: list(w[9]) for w in want if w[9]}


def test_extra_columns_empty_table_and_a_long_conversation(spark):
    table = conversations(20)
    df = with_extras(spark.createDataFrame(table, SCHEMA)).withColumn("nth", F.lit(1)).withColumn("blank", F.lit("b"))
    want = [w[:9] for w in brute(table, True)]
    assert rows_of(repair.repair(repair.damage(df))) == want
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(repair.damage(empty)).count() == 0
    long = [(1, t, random.Random(t).choice(["user", "assistant", "tool"]), f"text {t % 900}.") for t in range(3000)]
    assert rows_of(repair.repair(repair.damage(spark.createDataFrame(long, SCHEMA)))) == [
        w[:9] for w in brute(long, True)]
