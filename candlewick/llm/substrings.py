"""Repeated passages by prefix-partitioned groups of suffixes.

A word is removed when it lies in a window of ``window`` consecutive words whose
word sequence also starts anywhere else in the table (same document included).

Partitioning. Each window is a suffix cut at ``window`` words. Windows are dealt
by a ``prefix``-word gram inside them: the one with the smallest hash, the first
of equals. Equal windows hold equal grams, so they always meet. Consecutive
windows mostly share that gram, so one row carries a whole run of suffixes (about
12 of them) and the shuffle holds a few bytes per word instead of a row per word.
A gram with more than ``group_rows`` rows (not counting up to two in each task) is
lengthened to the whole window, where equal suffixes are counted with a map-side
combine and no group has to be held at all; beyond HOT_KEYS such grams only the
larger ones are. So the prefix length varies from ``prefix`` to ``window`` words.

Groups. A task takes whole groups of ``task_bytes`` and finds equal suffixes: a
sort by a 64-bit mix of gram, place of the gram and a 48-bit hash of the window (for
lengthened grams all three are compared). Equal neighbours are what the leaves below
one internal node at depth ``window`` of a suffix tree would be. No tree is built and
no words are compared: carrying the words themselves would take a shuffle of about
3.8 times the text, beyond the disk that the operator may use. Deeper nodes only
lengthen the same passages; touching windows are joined into maximal repeats.

Defined results: a null text has no words; texts shorter than a window are never
cut; repeated rows are repeats of one another, so every row of theirs of at least
``window`` words is emptied; a null doc_id is handled like a value; an empty table
gives an empty result. Results are joined to rows by (doc_id, text hash), so
doc_id need not be unique. Other columns pass through whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import (NON_SPACE, gram_hashes, mix64, slices, text_buffer, tune,
                                      word_hashes, words)
from candlewick.session import checkpoint_root

WINDOW = 35
PREFIX = 12
GROUP_ROWS = 50_000
#: Bytes of suffix rows in memory at once and in a shuffle partition, and most
#: lengthened prefixes to broadcast.
TASK_BYTES = 8 << 20
PARTITION_BYTES = 256 << 20
HOT_KEYS = 1 << 20
_FP = 6  # bytes of a window's fingerprint


def _first_min(v: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value among the ``width`` from each position on."""
    n = len(v) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at, done = None, None, 0
    cur, pos, size, rest = v, np.arange(len(v), dtype=np.int64), 1, width
    while rest:
        if rest & 1:
            a, p = cur[done:done + n], pos[done:done + n]
            if best is None:
                best, at = a.copy(), p.copy()
            else:
                less = a < best
                best, at = np.where(less, a, best), np.where(less, p, at)
            done += size
        rest >>= 1
        if rest:
            less = cur[size:] < cur[:-size]
            pos = np.where(less, pos[size:], pos[:-size])
            cur = np.where(less, cur[size:], cur[:-size])
            size *= 2
    return at


def suffix_runs(buf, offs, window: int, prefix: int):
    """Runs of windows that share their gram: (gram hash, document, first window's
    word, words from there to the gram, windows in the run, fingerprints)."""
    starts, ends, wo = words(buf, offs, NON_SPACE)
    h = word_hashes(buf, starts, ends, lower=False)
    gram = gram_hashes(h, prefix)
    at = _first_min(gram, window - prefix + 1)
    doc_end = np.repeat(wo[1:], np.diff(wo))
    s = np.flatnonzero(np.arange(len(at)) + window <= doc_end[:len(at)])
    p = at[s]
    new = np.flatnonzero((np.diff(p, prepend=-1) != 0) | (np.diff(s, prepend=-2) != 1))
    fp = gram_hashes(h, window)[s] >> np.uint64(64 - 8 * _FP)
    first = s[new]
    count = np.diff(np.append(new, len(s)))
    doc = np.searchsorted(wo, first, side="right") - 1
    return gram[p[new]], doc, first - wo[doc], p[new] - first, count, fp


def _pack_fp(fp: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fp.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_FP]).ravel()


def _unpack_fp(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw) // _FP, 8), np.uint8)
    wide[:, :_FP] = raw.reshape(-1, _FP)
    return wide.view("<u8").ravel().astype(np.uint64)


def _hot_grams(texts: DataFrame, window: int, prefix: int, group_rows: int):
    """Hashes of the grams with more than ``group_rows`` rows, sorted. A task
    reports the grams that it met at least three times."""
    def run(batches):
        seen = []
        for b in batches:
            buf, offs = text_buffer(b.column(0))
            for i, j in slices(offs):
                seen.append(suffix_runs(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, prefix)[0])
        g, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64),) * 2
        many = n >= 3
        yield pa.RecordBatch.from_arrays([pa.array(g[many].view(np.int64)),
                                          pa.array(n[many].astype(np.int64))], ["g", "n"])

    sums = texts.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")) \
                .where(F.col("n") > group_rows).checkpoint()
    # the broadcast stays within HOT_KEYS keys: beyond, only larger groups are lengthened
    least = group_rows
    while sums.where(F.col("n") > least).count() > HOT_KEYS:
        least *= 2
    keys = [r["g"] for r in sums.where(F.col("n") > least).select("g").collect()]
    return np.sort(np.array(keys, np.int64).view(np.uint64))


def _rows(keyed: DataFrame, window: int, prefix: int, hot, want_hot: bool) -> DataFrame:
    """Suffix runs as rows (g, doc_id, th, first, lead, fps) of the grams that are
    (not) in ``hot``."""
    shared = keyed.sparkSession.sparkContext.broadcast(hot)
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hot = shared.value
        for b in batches:
            buf, offs = text_buffer(b.column(2))
            for i, j in slices(offs):
                g, doc, first, lead, count, fp = suffix_runs(
                    buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, prefix)
                use = np.full(len(g), not want_hot)
                if len(hot) and len(g):
                    is_hot = hot[np.minimum(np.searchsorted(hot, g), len(hot) - 1)] == g
                    use = is_hot == want_hot
                if not use.any():
                    continue
                raw = _pack_fp(fp[np.repeat(use, count)])
                to = np.concatenate(([0], np.cumsum(count[use]) * _FP)).astype(np.int32)
                who = pa.array(i + doc[use])
                fps = pa.Array.from_buffers(pa.binary(), int(use.sum()),
                                            [None, pa.py_buffer(to), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g[use].view(np.int64)), b.column(0).take(who), b.column(1).take(who),
                     pa.array(first[use].astype(np.int32)), pa.array(lead[use].astype(np.int32)), fps],
                    ["g", "doc_id", "th", "first", "lead", "fps"])

    return keyed.mapInArrow(run, f"g long, doc_id {kind}, th long, first int, lead int, fps binary")


def _subtree(g, lead, count, fp) -> np.ndarray:
    """Which suffixes have an equal elsewhere in their group."""
    run = np.repeat(np.arange(len(g)), count)
    place = lead[run] - (np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count))
    key = mix64(g[run] + place.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)) \
        ^ (fp * np.uint64(0xC2B2AE3D27D4EB4F))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _chunks(batches, limit: int):
    """Tables of whole groups (rows come sorted by g) of about ``limit`` bytes."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.nbytes
        if size >= limit:
            t = pa.Table.from_batches(held)
            g = t.column("g").to_numpy()
            cut = int(np.searchsorted(g, g[-1]))        # the last group may go on
            if cut:
                yield t.slice(0, cut)
                held = [pa.concat_tables([t.slice(cut)]).combine_chunks().to_batches()[0]]
                size = held[0].nbytes
    if held:
        yield pa.Table.from_batches(held)


def _spans(t: pa.Table, window: int) -> pa.Table:
    """(doc_id, th, start, end) of the repeats in a table of whole groups."""
    g = t.column("g").to_numpy().view(np.uint64)
    first, lead = (t.column(c).to_numpy().astype(np.int64) for c in ("first", "lead"))
    col = pa.concat_arrays(t.column("fps").chunks)
    _, o, data = col.buffers()
    to = np.frombuffer(o, np.int64 if pa.types.is_large_binary(col.type) else np.int32)
    to = to[col.offset:col.offset + len(col) + 1]
    fp = _unpack_fp(np.frombuffer(data, np.uint8)[to[0]:to[-1]])
    count = np.diff(to).astype(np.int64) // _FP
    rep = _subtree(g, lead, count, fp)
    run_of = np.repeat(np.arange(len(g)), count)
    # joined repeats inside a run: a span opens where a repeat has none before it
    prev = np.concatenate(([False], rep[:-1])) & (np.diff(run_of, prepend=-1) == 0)
    nxt = np.concatenate((rep[1:], [False])) & (np.diff(run_of, append=len(g)) == 0)
    a, z = np.flatnonzero(rep & ~prev), np.flatnonzero(rep & ~nxt)
    base = np.cumsum(count) - count
    who = run_of[a]
    start = first[who] + a - base[who]
    end = first[who] + z - base[who] + window
    at = pa.array(who)
    return pa.table([t.column("doc_id").take(at), t.column("th").take(at),
                     pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
                    ["doc_id", "th", "start", "end"])


def _cold_repeats(rows: DataFrame, partitions: int, window: int, task_bytes: int) -> DataFrame:
    """(doc_id, th, start, end) word spans. A partition is sorted by gram (Spark's
    sort spills), and subtrees are built of as many whole groups as fit in
    ``task_bytes``, so memory does not depend on the size of a partition."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for t in _chunks(batches, task_bytes):
            yield from _spans(t, window).combine_chunks().to_batches(100_000)

    return rows.repartition(partitions, "g").sortWithinPartitions("g").mapInArrow(
        run, f"doc_id {kind}, th long, start int, end int")


def _hot_repeats(rows: DataFrame, window: int) -> DataFrame:
    """The same spans for lengthened prefixes: one row per suffix, counted with a
    map-side combine, then joined back (a join that may be split by skew)."""
    n = F.length("fps") / _FP
    each = rows.select("g", "doc_id", "th", "first", "lead", "fps",
                       F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("i")) \
               .select("g", "doc_id", "th", (F.col("first") + F.col("i")).alias("start"),
                       (F.col("lead") - F.col("i")).alias("place"),
                       F.substring("fps", F.col("i") * _FP + 1, F.lit(_FP)).alias("fp"))
    node = ["g", "place", "fp"]
    deep = each.groupBy(*node).agg(F.count("*").alias("leaves")).where("leaves > 1").drop("leaves")
    return each.join(deep, node).select(
        "doc_id", "th", "start", (F.col("start") + window).alias("end"))


def repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX,
            group_rows: int = GROUP_ROWS, task_bytes: int = TASK_BYTES) -> DataFrame:
    """(doc_id, th, spans): per distinct (doc_id, text hash) the word spans that
    are covered by repeated windows, as a set of {start, end}."""
    spark = docs.sparkSession
    tune(spark)
    checkpoint_root(spark)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").where("text <> ''")
    size = keyed.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(size * 1.3) // PARTITION_BYTES))
    hot = _hot_grams(keyed.select("text"), window, prefix, group_rows)
    spans = _cold_repeats(_rows(keyed, window, prefix, hot, False), partitions, window, task_bytes)
    if len(hot):
        spans = spans.unionByName(_hot_repeats(_rows(keyed, window, prefix, hot, True), window))
    return spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _kept(buf, offs, spans: list):
    """(words, removed words, kept words joined by one blank) per document."""
    starts, ends, wo = words(buf, offs, NON_SPACE)
    cut = np.zeros(len(starts) + 1, np.int64)
    for d, s in enumerate(spans):
        if s:
            pairs = np.array([(x["start"], x["end"]) for x in s]) + wo[d]
            np.add.at(cut, pairs[:, 0], 1)
            np.add.at(cut, pairs[:, 1], -1)
    keep = np.cumsum(cut)[:-1] == 0
    ko = np.concatenate(([0], np.cumsum(keep)))[wo]
    s, size = starts[keep], (ends - starts)[keep] + 1
    to = np.concatenate(([0], np.cumsum(size)))
    out = np.append(buf, np.uint8(0x20))[np.repeat(s - to[:-1], size) + np.arange(int(to[-1]))]
    out[to[1:] - 1] = 0x20
    n_kept = np.diff(ko)
    a, b = to[ko[:-1]], to[ko[1:]] - (n_kept > 0)
    raw = out.tobytes()
    texts = [raw[x:y].decode("utf-8") for x, y in zip(a.tolist(), b.tolist())]
    n = np.diff(wo)
    return n, n - n_kept, texts


def remove_repeats(docs: DataFrame, keep: tuple = ("doc_id",), **params) -> DataFrame:
    """Per row of ``docs``: the ``keep`` columns, n_words, n_removed and kept_text
    (the kept words joined by one blank)."""
    found = repeats(docs.select("doc_id", "text"), **params) \
        .select(F.col("doc_id").alias("r_doc"), F.col("th").alias("r_th"), "spans")
    carried = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)]
    rows = docs.select(*carried, F.col("doc_id").alias("l_doc"), F.xxhash64("text").alias("l_th"),
                       F.col("text").alias("l_text"))
    joined = rows.join(found, F.col("l_doc").eqNullSafe(F.col("r_doc"))
                       & (F.col("l_th") == F.col("r_th")), "left") \
                 .select(*[f"c{k}" for k in range(len(keep))], "spans", "l_text")
    n = len(keep)
    schema = "".join(f"c{k} {docs.schema[c].dataType.simpleString()}, " for k, c in enumerate(keep))

    def run(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(n + 1))
            for i, j in slices(offs):
                part = b.slice(i, j - i)
                words_, gone, texts = _kept(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i],
                                            part.column(n).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    part.columns[:n] + [pa.array(words_), pa.array(gone), pa.array(texts, pa.string())],
                    [f"c{k}" for k in range(n)] + ["n_words", "n_removed", "kept_text"])

    out = joined.mapInArrow(run, schema + "n_words long, n_removed long, kept_text string")
    return out.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(keep)],
                      "n_words", "n_removed", "kept_text")


def drop_repeats(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with its columns, the repeated passages taken out of the text; a
    document without any keeps its text as it is. A column ``n_chars`` is set to the
    new length of the texts that changed."""
    found = remove_repeats(docs, keep=tuple(docs.columns), **params)
    cut = F.col("found_removed") > 0
    out = found.toDF(*[f"k{i}" for i in range(len(docs.columns))], "found_words", "found_removed", "found_text")
    made = []
    for i, f in enumerate(docs.schema.fields):
        c = F.col(f"k{i}")
        if f.name == "text":
            c = F.when(cut, F.col("found_text")).otherwise(c)
        elif f.name == "n_chars":
            c = F.when(cut, F.length("found_text").cast(f.dataType)).otherwise(c)
        made.append(c.alias(f.name))
    return out.select(*made)
