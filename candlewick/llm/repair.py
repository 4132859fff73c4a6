"""Conversation structure repair: cheapest edits to roles ``(s?(ua)+)?``.

Method. Every edit path of a conversation has one scalar weight, a big integer: the
high digits carry its cost, the low digits its audit letters, one base-8 digit to
each position of a fixed width (D=1, I=2, K=3, R=4, in ASCII order), with zero
digits after the last letter. An edit at position p adds cost * 8^width +
letter * 8^(width - 1 - p), so an ordinary integer minimum over a small acyclic
graph (rows x last role: none, s, u, a) finds the cheapest edits and, among those,
the least audit string. Two inserts before a row are enough: a third only returns to
a role already reached at less cost.

Long conversations. Rows are taken in blocks of ``BLOCK`` (the width of a block is
then fixed: 3 letters a row). A block gives one weight per (role before, role after);
at its border those are added to the weights so far, again by integer minimum, and
letters that all surviving paths share are set down, so the integers stay short. This
is exact: two paths of equal cost over the same rows are never prefixes of each other
(the longer one would have paid for more inserts), so a tie inside a block stays
decided whatever follows.

On Spark. One shuffle deals the rows by conversation; two sorts (Spark's, spilling)
find the repeated rows and put each conversation in order; one streaming pass then
decides it. A task holds a block of rows, the audit letters and up to four running
hashes, never a whole conversation. A single conversation is still one stream, since
a SHA-256 of its repaired text can only be taken in order.

Defined results: a null role or text is one blank; a null turn comes first and is no
turn number; rows of one turn are ordered by role, then text (by bytes); a null
conv_id is a conversation of its own; a conversation without rows has zero counts,
an empty audit and the hash of the empty string; a text of white space only is blank;
an empty table gives an empty result; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import tune

BLOCK = 64
NONE, S, U, A = range(4)
#: Role reached by an inserted or reroled turn, by the role before it.
_NEXT = (U, U, A, U)
#: Role reached by keeping a turn, by its initial and the role before it.
_KEEP = {"s": (S, None, None, None), "u": (U, U, None, U), "a": (None, None, A, None)}
COST_REROLE, COST_DELETE, COST_INSERT, COST_TRUNCATED = 3, 4, 3, 3
D, I, K, R = 1, 2, 3, 4
_LETTERS = str.maketrans("1234", "DIKR")
_BLANKS = " \t\n\x0b\x0c\r"


def _width(rows: list) -> int:
    """Positions of a block: two inserts and an edit for each row, two inserts at the
    end, and two more that ``_inserts`` tries in vain."""
    return 3 * len(rows) + 4


def _inserts(best: list, width: int) -> None:
    """Relax the inserted turns (at most two in a row can win) in place."""
    unit = COST_INSERT << 3 * width
    for _ in range(2):
        for x in range(4):
            if best[x] is not None:
                w, p = best[x]
                v = (w + unit + (I << 3 * (width - 1 - p)), p + 1)
                t = _NEXT[x]
                if best[t] is None or v[0] < best[t][0]:
                    best[t] = v


def block_weights(rows: list, start: int, last: bool) -> list:
    """Per role after the block the least (weight, letters used) from ``start``;
    rows are (initial, must go, truncated). ``last`` allows inserts at the end."""
    width = _width(rows)
    best: list = [None] * 4
    best[start] = (0, 0)
    for initial, must_go, truncated in rows:
        _inserts(best, width)
        keep = _KEEP.get(initial)
        extra = COST_TRUNCATED if truncated else 0
        out: list = [None] * 4
        for x in range(4):
            if best[x] is None:
                continue
            w, p = best[x]
            at = 3 * (width - 1 - p)
            moves = [(x, COST_DELETE, D)]
            if not must_go:
                moves.append((_NEXT[x], COST_REROLE + extra, R))
                if keep and keep[x] is not None:
                    moves.append((keep[x], extra, K))
            for t, cost, letter in moves:
                v = w + (cost << 3 * width) + (letter << at)
                if out[t] is None or v < out[t][0]:
                    out[t] = (v, p + 1)
        best = out
    if last:
        _inserts(best, width)
    return best


def _octal(digits: int, width: int) -> str:
    return format(digits, "o").rjust(width, "0") if width else ""


def walk(letters: str, rows: list, state: int):
    """The edits of a block as (letter, role, text); a deleted row's role and text
    are its own. Rows are (role, text)."""
    at = 0
    for x in letters:
        if x == "I":
            state = _NEXT[state]
            yield x, "user" if state == U else "assistant", ""
            continue
        role, text = rows[at]
        at += 1
        if x == "R":
            state = _NEXT[state]
            role = "user" if state == U else "assistant"
        elif x == "K":
            state = _KEEP[role[0]][state]
        yield x, role, text


class Repair:
    """Decides one conversation from its rows in order: ``add`` them, then ``finish``.
    ``hashed`` also takes the SHA-256 of the repaired text."""

    def __init__(self, hashed: bool = True, block: int = BLOCK):
        self.block, self.hashed = block, hashed
        self.rows, self.texts = [], []
        self.live = {NONE: (0, 0, 0, hashlib.sha256())}   # state -> cost, digits, used, hash
        self.width, self.done = 0, []
        self.n = self.gone = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = self.turn = None
        self.turns = 0
        self.initial = None

    def add(self, turn, role, text, blank, duplicate, truncated):
        c = self.counts
        c["blank"] += blank
        c["duplicate"] += duplicate
        c["truncated"] += truncated
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            c["illegal"] += 1
        self.initial = initial
        if turn is not None:
            if turn != self.turn:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        if len(self.rows) == self.block:
            self._close(False)
        self.rows.append((initial, blank or duplicate, truncated))
        self.texts.append((role, text))

    def _close(self, last: bool):
        n = _width(self.rows)
        width = self.width + n
        pick: dict = {}
        for s, (cost, digits, used, h) in self.live.items():
            for t, v in enumerate(block_weights(self.rows, s, last)):
                if v is None:
                    continue
                w, p = v
                c, own = cost + (w >> 3 * n), w & ((1 << 3 * n) - 1)
                new = (digits << 3 * n) + (own << 3 * (width - used - n))
                weight = (c << 3 * width) + new
                if t not in pick or weight < pick[t][0]:
                    pick[t] = (weight, c, new, used + p, h, s, _octal(own, n)[:p].translate(_LETTERS))
        if last:
            legal = min((pick[t][0], t) for t in (NONE, A) if t in pick)[1]
            pick = {legal: pick[legal]}
        self.live = {}
        for t, (_, c, new, used, h, s, letters) in pick.items():
            if self.hashed:
                h = h.copy()
                first = s == NONE
                for x, role, text in walk(letters, self.texts, s):
                    if x != "D":
                        h.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                        first = False
            self.live[t] = (c, new, used, h)
        self._set_down(width)
        self.rows, self.texts = [], []

    def _set_down(self, width: int):
        """Take the leading letters that all paths share out of the integers, and the
        unused positions at the end."""
        states = list(self.live.values())
        spread = 0
        for s in states[1:]:
            spread |= states[0][1] ^ s[1]
        same = min((3 * width - spread.bit_length()) // 3, min(s[2] for s in states))
        longest = max(s[2] for s in states)
        if same:
            self.done.append(_octal(states[0][1] >> 3 * (width - same), same))
        self.width = longest - same
        cut, mask = 3 * (width - longest), (1 << 3 * self.width) - 1
        self.live = {t: (c, (d >> cut) & mask, u - same, h) for t, (c, d, u, h) in self.live.items()}

    def finish(self) -> dict:
        self._close(True)
        cost, digits, used, h = next(iter(self.live.values()))
        audit = "".join(self.done) + _octal(digits, self.width)[:used]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": audit.translate(_LETTERS),
                "repaired_sha256": h.hexdigest()}


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, absent): a table damaged by the checksum of
    ``conv_id:turn``; a dropped row stays as an ``absent`` one, so that its
    conversation is not forgotten."""
    word = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(word[0], F.lit(":"), word[1])) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    hurt = conversations.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind <= 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind == 0).alias("absent"),
        F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1)).alias("copies"))
    return hurt.select("conv_id", "turn", "role", "text", "absent", F.explode("copies").alias("copy")).drop("copy")


def _faults(rows: DataFrame) -> DataFrame:
    """Rows dealt by conversation, with their first fault and their place among equals."""
    shown = F.rtrim("text", F.lit(_BLANKS))
    blank = F.btrim("text", F.lit(_BLANKS)) == ""
    again = F.row_number().over(Window.partitionBy("conv_id", "absent", "role", "text").orderBy("turn"))
    rows = rows.repartition("conv_id").withColumn("nth", again).withColumn("blank", blank)
    rows = rows.withColumn("duplicate", ~F.col("blank") & (F.col("nth") > 1))
    return rows.withColumn("truncated", ~F.col("blank") & (F.col("nth") == 1)
                           & ~F.right(shown, F.lit(1)).isin(".", "!", "?"))


def _prepared(conversations: DataFrame) -> DataFrame:
    tune(conversations.sparkSession)
    absent = F.col("absent") if "absent" in conversations.columns else F.lit(False)
    return _faults(conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), absent.alias("absent")))


_ORDER = ["conv_id", "turn", "role", "text", "nth"]      # Spark sorts nulls first
_SUMMARY = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
            "audit string, repaired_sha256 string")
_NAMES = [f.split()[0] for f in _SUMMARY.split(", ")]


def _conversations(batches):
    """(conv_id, rows of it in this batch) runs, in order."""
    for b in batches:
        rows = b.to_pylist()
        i = 0
        while i < len(rows):
            j, conv = i, rows[i]["conv_id"]
            while j < len(rows) and rows[j]["conv_id"] == conv:
                j += 1
            yield conv, rows[i:j]
            i = j


def repair(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, the counts of its faults, the cost and the audit of
    its cheapest repair, and the SHA-256 of the repaired text. Rows with a true
    ``absent`` (optional) count for the presence of their conversation only."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = _prepared(conversations).sortWithinPartitions(*_ORDER).select(
        "conv_id", "turn", "role", "text", "absent", "blank", "duplicate", "truncated")

    def run(batches):
        out, conv, now = [], None, None

        def batch():
            return pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("conv_id", id_type[0])] + [(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64())
                                             for c in _NAMES]))

        id_type = [None]

        def typed(source):
            for b in source:
                id_type[0] = b.schema.field("conv_id").type
                yield b

        for c, part in _conversations(typed(batches)):
            if now is None or c != conv:
                if now is not None:
                    out.append({"conv_id": conv, **now.finish()})
                conv, now = c, Repair()
            for r in part:
                if not r["absent"]:
                    now.add(r["turn"], r["role"], r["text"], r["blank"], r["duplicate"], r["truncated"])
            if len(out) >= 1000:
                yield batch()
                out = []
        if now is not None:
            out.append({"conv_id": conv, **now.finish()})
        if out:
            yield batch()

    return rows.mapInArrow(run, f"conv_id {kind}, {_SUMMARY}")


def repaired_turns(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, position (from 0), role, text and the edit that
    made each (K, R or I). ``repaired`` is the result of ``repair``; a conversation's
    audit comes first in its stream, so again no conversation is held."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    rows = _prepared(conversations).where(~F.col("absent")).select(
        "conv_id", F.lit(1).alias("part"), "turn", "role", "text", "nth")
    heads = repaired.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"),
                            F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("nth"))
    both = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions(
        "conv_id", "part", *_ORDER[1:]).select(
        "conv_id", "part", "role", "text")

    def run(batches):
        audit, at, state, n = "", 0, NONE, 0
        conv = None
        for b in batches:
            ids, out = b.schema.field("conv_id").type, []

            def edit(row):
                nonlocal at, state, n
                x = audit[at]
                at += 1
                (_, role, text), = walk(x, [row], state)
                if x == "D":
                    return
                state = _NEXT[state] if x in "IR" else _KEEP[role[0]][state]
                out.append({"conv_id": conv, "position": n, "role": role, "text": text, "edit": x})
                n += 1

            for r in b.to_pylist():
                if r["part"] == 0:
                    conv, audit, at, state, n = r["conv_id"], r["text"], 0, NONE, 0
                else:
                    edit((r["role"], r["text"]))
                while at < len(audit) and audit[at] == "I":      # inserts before the next row
                    edit(None)
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("conv_id", ids), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                 ("edit", pa.string())]))

    return both.mapInArrow(run, f"conv_id {kind}, position long, role string, text string, edit string")
