"""Benchmark decontamination with training suffix arrays.

The documents of a task's slice form a training shard. Its suffix array holds,
in word order, the suffixes that can start a test window: a position is kept
when its words run through the test set's word pairs for a whole window, which
drops no match of a window or more. Every test suffix that can fill a window is
binary-searched in each shard's array (both borders of its window, all suffixes at
once); the interval found gives every verbatim occurrence, and neighbouring
occurrences on one diagonal join into the longest match and its location. Matches
shorter than a window are not looked for: without a longer one, ``longest`` is 0. A document is a row, so the whole search is one
narrow pass over the corpus: no shuffle, no key to run hot.

The test set is cut into blocks of at most ``block_bytes`` of text. Each block
is collected and broadcast by itself; with more than one block the passes follow
each other through a checkpoint, so nothing of unbounded size is broadcast.

Words are lower-cased (A-Z) runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. A
window is ``window`` consecutive words of an item; an item with fewer words, but
not none, is one window. A document is contaminated when it has a hit word and
its hit words are at least 1/``share`` of its words.

Defined results: a null or empty text (document or item) has no words, hits
nothing and is never contaminated; repeated rows give repeated results; items
without an id count as hits but are not listed; an empty benchmark hits nothing;
an empty document table gives no rows. Other columns of ``docs`` pass through
``decontaminate`` whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import (ALNUM, slices, take_utf8, text_buffer, tune,
                                      word_hashes, words)
from candlewick.session import checkpoint_root

WINDOW = 13
SHARE = 20
BLOCK_BYTES = 8 << 20
_PAIRS = 1 << 22
_NONE = np.zeros(0, np.int64)


class TestSet:
    """The words, windows and suffixes of one block of test items."""

    __test__ = False  # not a pytest class

    def __init__(self, texts: list[str], window: int):
        buf, offs = text_buffer(pa.array(texts, pa.large_string()))
        starts, ends, wo = words(buf, offs, ALNUM)
        h = word_hashes(buf, starts, ends, lower=True)
        self.vocab = np.unique(h)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.vocab >> np.uint64(44)] = True
        self.word = np.searchsorted(self.vocab, h).astype(np.int64) + 1   # 0: not a test word
        item = np.repeat(np.arange(len(texts)), np.diff(wo))
        self.item, self.end = item, wo[item + 1]
        size = np.minimum(np.diff(wo), window)[item]
        at = np.arange(len(item))
        keep = at + size <= self.end
        #: window length -> start positions of the test windows of that length
        self.windows = {int(k): at[keep & (size == k)] for k in np.unique(size[keep])}
        inner = at[:-1][item[1:] == item[:-1]]
        self.pairs = np.unique(self.word[inner] << 32 | self.word[inner + 1]) if len(at) else _NONE

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Rank of each word hash in the test vocabulary, 0 when absent."""
        out = np.zeros(len(h), np.int64)
        may = np.flatnonzero(self.bits[h >> np.uint64(44)])
        if len(may):
            at = np.minimum(np.searchsorted(self.vocab, h[may]), len(self.vocab) - 1)
            out[may] = np.where(self.vocab[at] == h[may], at + 1, 0)
        return out


def _in_sorted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def suffix_array(ids: np.ndarray, doc_end: np.ndarray, test: TestSet, size: int) -> np.ndarray:
    """Positions that can start a window of ``size`` test words, in word order."""
    n = len(ids)
    if n < size:
        return _NONE
    if size == 1:
        at = np.flatnonzero(ids)
    else:
        hot = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        good = np.zeros(n, np.int32)
        good[hot] = _in_sorted(ids[hot] << 32 | ids[hot + 1], test.pairs)
        run = np.concatenate(([0], np.cumsum(good)))
        at = np.flatnonzero(run[size - 1:n] - run[:n - size + 1] == size - 1)
    at = at[at + size <= doc_end[at]]
    keys = [ids[at + k] for k in range(size)]
    return at[np.lexsort(keys[::-1])] if len(at) else at


def _compare(ids, at, test, t, size):
    """Sign of (training suffix at) - (test suffix t) over ``size`` words."""
    out = np.zeros(len(at), np.int8)
    open_ = np.arange(len(at))
    for k in range(size):
        d = np.sign(ids[at[open_] + k] - test.word[t[open_] + k])
        out[open_] = d
        open_ = open_[d == 0]
        if not len(open_):
            break
    return out


def search(ids, array, test: TestSet, t: np.ndarray, size: int):
    """For each test suffix, the interval of ``array`` that starts with its window."""
    def border(right: bool):
        lo, hi = np.zeros(len(t), np.int64), np.full(len(t), len(array), np.int64)
        while True:
            go = np.flatnonzero(lo < hi)
            if not len(go):
                return lo
            mid = (lo[go] + hi[go]) >> 1
            c = _compare(ids, array[mid], test, t[go], size)
            low = c <= 0 if right else c < 0
            lo[go[low]] = mid[low] + 1
            hi[go[~low]] = mid[~low]
    return border(False), border(True)


def _longest(ids, doc_end, test, t, lo, hi, array, size, best):
    """Join occurrences along diagonals; keep each document's longest match in
    ``best`` (document end -> (length, position, item, item position))."""
    n, i = hi - lo, 0
    total = np.concatenate(([0], np.cumsum(n)))
    while i < len(t):
        j = max(int(np.searchsorted(total, total[i] + _PAIRS, side="right")) - 1, i + 1)
        reps = n[i:j]
        tt = np.repeat(t[i:j], reps)
        p = array[np.repeat(lo[i:j], reps) + np.arange(len(tt)) - np.repeat(total[i:j] - total[i], reps)]
        order = np.lexsort((p, test.item[tt], p - tt)) if len(tt) else _NONE
        tt, p = tt[order], p[order]
        same = (np.diff(p) == 1) & (np.diff(tt) == 1) & (np.diff(test.item[tt]) == 0)
        cut = np.flatnonzero(np.concatenate(([True], ~same))) if len(tt) else _NONE
        s, q = tt[cut], p[cut]
        length = np.diff(np.append(cut, len(tt))) - 1 + size
        grow = np.arange(len(s))                      # a run cut by the chunk goes on
        while len(grow):
            a, b = s[grow] + length[grow], q[grow] + length[grow]
            ok = (a < test.end[s[grow]]) & (b < doc_end[q[grow]])
            grow, a, b = grow[ok], a[ok], b[ok]
            grow = grow[test.word[a] == ids[b]]
            length[grow] += 1
        order = np.lexsort((s, q, -length))
        ends, first = np.unique(doc_end[q[order]], return_index=True)
        for e, k in zip(ends.tolist(), order[first].tolist()):
            found = int(length[k]), int(q[k]), int(test.item[s[k]]), int(s[k])
            if found[0] > best.get(e, (0,))[0]:
                best[e] = found
        i = j


def scan_slice(buf, offs, test: TestSet):
    """(words per document, hit flag per word, [(document, item)], longest match
    per document, word starts, word ends) of one slice."""
    starts, ends, wo = words(buf, offs, ALNUM)
    ids = test.ids(word_hashes(buf, starts, ends, lower=True))
    n_words = np.diff(wo)
    doc_end = np.repeat(wo[1:], n_words)
    cover = np.zeros(len(ids) + 1, np.int64)
    hits, best = [], {}
    for size, t in test.windows.items():
        array = suffix_array(ids, doc_end, test, size)
        if not len(array):
            continue
        lo, hi = search(ids, array, test, t, size)
        got = np.flatnonzero(hi > lo)
        if not len(got):
            continue
        t, lo, hi = t[got], lo[got], hi[got]
        # equal test windows share an interval: each occurrence is covered once
        ulo, first, which = np.unique(lo, return_index=True, return_inverse=True)
        uhi = hi[first]
        reps = uhi - ulo
        at = array[np.repeat(ulo, reps) + np.arange(int(reps.sum()))
                   - np.repeat(np.cumsum(reps) - reps, reps)]
        cover[:len(ids)] += np.bincount(at, minlength=len(ids))
        cover += np.bincount(at + size, minlength=len(ids) + 1)[:len(ids) + 1] * -1
        doc = np.searchsorted(wo, at, side="right") - 1
        interval = np.repeat(np.arange(len(ulo)), reps)
        seen = np.unique(doc * len(ulo) + interval)
        by = np.argsort(which, kind="stable")
        # items of each distinct window, then items of each (document, window)
        witem = np.unique(which[by] * len(test.end) + test.item[t[by]])
        wper = np.bincount(witem // len(test.end), minlength=len(ulo))
        wbegin = np.cumsum(wper) - wper
        d, w = seen // len(ulo), seen % len(ulo)
        step = max(1, _PAIRS // max(1, int(wper.max())))
        for i in range(0, len(d), step):
            r = wper[w[i:i + step]]
            k = np.repeat(wbegin[w[i:i + step]], r) + np.arange(int(r.sum())) - np.repeat(np.cumsum(r) - r, r)
            hits.append(np.unique(np.repeat(d[i:i + step], r) * len(test.end) + witem[k] % len(test.end)))
        _longest(ids, doc_end, test, t, lo, hi, array, size, best)
    hit = np.cumsum(cover)[:-1] > 0
    pairs = np.unique(np.concatenate(hits)) if hits else _NONE
    return n_words, wo, hit, pairs // max(1, len(test.end)), pairs % max(1, len(test.end)), best, starts, ends


_STATE = ("n_words long, spans array<int>, items array<string>, longest int, longest_word int, "
          "longest_item string, longest_text string")
_STATE_TYPES = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int32(), pa.int32(),
                pa.string(), pa.string()]
_STATE_NAMES = [x.split()[0] for x in _STATE.split(", ")]


def _runs(flags: np.ndarray) -> np.ndarray:
    """[start, end, start, end, ...] of the runs of true flags."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).astype(np.int32)


def _pass(frame: DataFrame, columns: list, block: list, window: int, first: bool) -> DataFrame:
    """One block of test items against every document; adds to the state columns."""
    shared = frame.sparkSession.sparkContext.broadcast(block)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields
                       if f.name not in _STATE_NAMES) + ", " + _STATE
    text_at, made = frame.columns.index("text"), {}

    def run(batches):
        if not made:
            made["ids"] = [x[0] for x in shared.value]
            made["set"] = TestSet([x[1] for x in shared.value], window)
        ids, test = made["ids"], made["set"]
        for b in batches:
            buf, offs = text_buffer(b.column(text_at))
            for i, j in slices(offs):
                part, base = b.slice(i, j - i), offs[i]
                text = buf[base:offs[j]]
                n, wo, hit, doc, item, best, ws, we = scan_slice(text, offs[i:j + 1] - base, test)
                old = None if first else [part.column(b.schema.get_field_index(c)).to_pylist()
                                          for c in _STATE_NAMES]
                spans, items = [[] for _ in range(j - i)], [set() for _ in range(j - i)]
                for d, k in zip(doc.tolist(), item.tolist()):
                    if ids[k] is not None:
                        items[d].add(ids[k])
                long_, at, of, what = [0] * (j - i), [None] * (j - i), [None] * (j - i), [None] * (j - i)
                for e, (m, p, k, _) in best.items():
                    d = int(np.searchsorted(wo, p, side="right")) - 1
                    long_[d], at[d], of[d] = m, p - int(wo[d]), ids[k]
                    what[d] = take_utf8(text, int(ws[p]), int(we[p + m - 1]))
                any_hit = np.add.reduceat(np.append(hit, False).astype(np.int64), wo[:-1]) * (n > 0)
                for d in range(j - i):
                    flags = hit[wo[d]:wo[d + 1]] if any_hit[d] else None
                    if old is not None:
                        s = old[1][d]
                        if s:
                            flags = np.zeros(int(n[d]), bool) if flags is None else flags.copy()
                            for x, y in zip(s[::2], s[1::2]):
                                flags[x:y] = True
                        items[d] |= set(old[2][d])
                        if old[3][d] > long_[d]:
                            long_[d], at[d], of[d], what[d] = (old[q][d] for q in (3, 4, 5, 6))
                    if flags is not None:
                        spans[d] = _runs(flags)
                values = [n, spans, [sorted(x) for x in items], long_, at, of, what]
                keep = [c for k, c in enumerate(part.columns) if b.schema.names[k] not in _STATE_NAMES]
                yield pa.RecordBatch.from_arrays(
                    keep + [pa.array(v, t) for v, t in zip(values, _STATE_TYPES)],
                    [c for c in b.schema.names if c not in _STATE_NAMES] + _STATE_NAMES)

    return frame.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE,
                  block_bytes: int = BLOCK_BYTES, keep: tuple = ("doc_id",)) -> DataFrame:
    """Per document: the ``keep`` columns, n_words, spans (hit word runs as
    [start, end, ...]), n_hit, items (their ids as strings, sorted), the longest
    verbatim match (length in words, word position, item, text) and contaminated."""
    spark = docs.sparkSession
    tune(spark)
    checkpoint_root(spark)
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text")).where("text <> ''")
    size = bench.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    blocks = max(1, -(-size // block_bytes))
    bench = bench.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    frame = docs.select(*[F.col(c) for c in keep if c != "text"], "text")
    for k in range(blocks):
        block = [tuple(r) for r in bench.where(F.col("block") == k).select("item_id", "text").collect()]
        frame = _pass(frame, list(keep), block, window, first=k == 0)
        if k + 1 < blocks:
            frame = frame.checkpoint()
    n_hit = F.expr("aggregate(sequence(0, int(size(spans) / 2) - 1), 0L, (a, i) -> "
                   "a + spans[2 * i + 1] - spans[2 * i])")
    frame = frame.withColumn("n_hit", F.when(F.size("spans") > 0, n_hit).otherwise(F.lit(0).cast("long")))
    return frame.withColumn("contaminated", (F.col("n_hit") > 0)
                            & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    rest = [c for c in docs.columns if c != "text"]
    names = tuple(f"c{k}" for k in range(len(rest)))
    flat = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(rest, names)], "text")
    found = contamination(flat, benchmark, keep=names, **params).where("not contaminated")
    back = dict(zip(rest, names)) | {"text": "text"}
    return found.select(*[F.col(back[c]).alias(c) for c in docs.columns])


def items_digest(items) -> F.Column:
    """SHA-256 (lowercase hex) of the sorted item ids, comma-joined."""
    return F.sha2(F.concat_ws(",", items), 256)


