"""Preference pairs as prompt and masked completions, in DataFrame functions.

A pair is a chosen and a rejected conversation. Their longest common prefix of
turns (equal role and text, from the first turn on) is the prompt, rendered once;
the turns after it are rendered as each side's completion. A completion's mask
lists the [start, end) character spans to be trained on: the text and end mark of
each assistant turn; headers and other roles are masked out. Spans count from the
start of the completion, so prompt + completion trains on the same spans shifted
by the prompt's length.

A table of conversations gives two kinds of pairs, neither by a join over a
group. Equal conversations (turn for turn) count once, under their smallest id,
and are ordered by the digest of all turns.

* ``neighbours``: conversations with the same first turn are candidates for one
  another; numbers 0 and 1, 2 and 3, ... of a first turn are pairs. The numbers come
  from counts per digest range, so a first turn that a third of all conversations
  share is spread over many tasks. The side with more assistant text is chosen; a
  tie goes to the earlier digest.
* ``swapped_replies``: a conversation up to its last assistant turn is chosen; the
  same with the last assistant turn of the next conversation in its digest range
  (about ``ring`` conversations, the last followed by the first) is rejected.

Defined results: a null role is ``unknown`` and a null text empty; turns are
ordered by (turn, role, text), a repeated turn row counts once; a conversation
without an id is left out, as its turns cannot be told from others'; the last of
an odd number of conversations has no neighbour and gives no pair; when one side
ends with the prompt its completion is empty; a conversation without an assistant
turn, alone in its range or next to an equal reply gets no swapped reply; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from candlewick.session import checkpoint_root

HEAD, TAIL, END = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"
RING = 1000


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: array of {turn, role, text}) in order."""
    t = F.struct(F.col("turn"), F.coalesce("role", F.lit("unknown")).alias("role"),
                 F.coalesce("text", F.lit("")).alias("text"))
    return turns.where("conv_id is not null").select("conv_id", t.alias("t")) \
        .groupBy("conv_id").agg(F.array_sort(F.collect_set("t")).alias("turns"))


def _same(a: Column, b: Column) -> Column:
    return (a["role"] == b["role"]) & (a["text"] == b["text"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common turn prefix of two turn arrays."""
    differ = F.filter(F.sequence(F.lit(0), F.least(F.size(a), F.size(b))),
                      lambda i: (i >= F.least(F.size(a), F.size(b))) | ~_same(F.get(a, i), F.get(b, i)))
    return F.array_min(differ)


def rendered(turns: Column) -> Column:
    """One text: each turn as header, text and end mark."""
    return F.concat_ws("", F.transform(turns, lambda t: F.concat(
        F.lit(HEAD), t["role"], F.lit(TAIL), t["text"], F.lit(END))))


def trained_spans(turns: Column) -> Column:
    """[start, end) character spans of the assistant turns' text and end marks."""
    head, end = len(HEAD) + len(TAIL), len(END)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc, t):
        start = acc["at"] + head + F.length(t["role"])
        stop = start + F.length(t["text"]) + end
        mine = F.array(F.struct(start.alias("start"), stop.alias("end")))
        return F.struct(stop.alias("at"), F.when(t["role"] == TRAINED, F.concat(acc["spans"], mine))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Prompt, completions and masks of (chosen, rejected) turn arrays; other columns
    pass through, but for those named like a result, which the result replaces."""
    made = ("prompt_turns", "prompt", "chosen_completion", "chosen_mask", "rejected_completion", "rejected_mask")
    rest = [c for c in pairs.columns if c not in ("chosen", "rejected") + made]
    n = pairs.withColumn("prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    out = [F.col(f"`{c}`") for c in rest] + ["prompt_turns", rendered(
        F.slice("chosen", F.lit(1), F.col("prompt_turns"))).alias("prompt")]
    for side in ("chosen", "rejected"):
        tail = F.slice(side, F.col("prompt_turns") + 1, F.size(side))
        out += [rendered(tail).alias(f"{side}_completion"), trained_spans(tail).alias(f"{side}_mask")]
    return n.select(*out)


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds ``rank``: 0, 1, ... within an opening in digest order. Only counts of
    digest ranges are ranked over a whole opening."""
    cell = ["opening", "slice"]
    rows = rows.withColumn("slice", F.substring("digest", 1, 4))
    count = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    before = count.withColumn("before", F.sum("n").over(
        W.partitionBy("opening").orderBy("slice").rowsBetween(W.unboundedPreceding, 0)) - F.col("n"))
    place = F.row_number().over(W.partitionBy(*cell).orderBy("digest"))
    return rows.withColumn("place", place).join(before.drop("n"), cell) \
               .withColumn("rank", F.col("before") + F.col("place") - 1).drop("place", "before", "slice")


def _last_reply(turns: Column) -> Column:
    """1-based place of the last assistant turn, null if there is none."""
    return F.array_max(F.filter(F.sequence(F.lit(1), F.size(turns)),
                                lambda i: F.get(turns, i - 1)["role"] == TRAINED))


def distinct_conversations(kept: DataFrame) -> DataFrame:
    """(opening, digest, said, last, conv_id) of the distinct conversations."""
    said = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.when(
        t["role"] == TRAINED, F.length(t["text"])).otherwise(0))
    return kept.select("conv_id", F.sha2(rendered(F.slice("turns", 1, 1)), 256).alias("opening"),
                       F.sha2(rendered(F.col("turns")), 256).alias("digest"), said.alias("said"),
                       _last_reply(F.col("turns")).alias("last")) \
        .groupBy("opening", "digest", "said", "last").agg(F.min("conv_id").alias("conv_id")).checkpoint()


def neighbours(kept: DataFrame, small: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, chosen, rejected) of neighbouring
    conversations with the same first turn."""
    one = F.struct("said", (-F.col("rank")).alias("order"), "conv_id")
    pair = _numbered(small).withColumn("pair", F.floor(F.col("rank") / 2)).groupBy("opening", "pair") \
        .agg(F.count("*").alias("n"), F.max(one).alias("c"), F.min(one).alias("x")).where("n = 2")
    ids = pair.select(
        F.concat_ws(":", F.substring("opening", 1, 16), F.col("pair").cast("string")).alias("pair_id"),
        F.col("c.conv_id").alias("chosen_id"), F.col("x.conv_id").alias("rejected_id"))

    def side(name):
        return kept.select(F.col("conv_id").alias(f"{name}_id"), F.col("turns").alias(name))

    return ids.join(side("chosen"), "chosen_id").join(side("rejected"), "rejected_id") \
              .select("pair_id", "chosen_id", "rejected_id", "chosen", "rejected")


def swapped_replies(kept: DataFrame, small: DataFrame, ring: int = RING) -> DataFrame:
    """(pair_id, chosen_id, rejected_id, chosen, rejected): each conversation and
    itself with the last reply of the next one."""
    with_reply = small.where("last is not null")
    rings = max(1, with_reply.count() // ring)
    in_ring = with_reply.withColumn("ring", F.shiftright(
        F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") * F.lit(rings), 32))
    order = W.partitionBy("ring").orderBy("digest")
    following = F.coalesce(F.lead("conv_id").over(order), F.first("conv_id").over(order))
    ids = in_ring.select(F.col("conv_id").alias("chosen_id"), following.alias("rejected_id"), "last")
    reply = kept.select(F.col("conv_id").alias("rejected_id"),
                        F.get("turns", _last_reply(F.col("turns")) - 1).alias("reply"))
    own = kept.select(F.col("conv_id").alias("chosen_id"), "turns")
    both = ids.join(own, "chosen_id").join(reply, "rejected_id")
    return both.where(F.get("turns", F.col("last") - 1)["text"] != F.col("reply.text")).select(
        F.concat(F.lit("swap:"), F.col("chosen_id").cast("string")).alias("pair_id"),
        "chosen_id", "rejected_id", F.slice("turns", F.lit(1), F.col("last")).alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), F.array("reply")).alias("rejected"))


def preference_pairs(turns: DataFrame, ring: int = RING) -> DataFrame:
    """Formatted preference pairs of a table of turns."""
    checkpoint_root(turns.sparkSession)
    kept = conversations(turns).checkpoint()
    small = distinct_conversations(kept)
    return format_pairs(neighbours(kept, small).unionByName(swapped_replies(kept, small, ring)))
