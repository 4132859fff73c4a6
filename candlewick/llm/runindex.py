"""Repeated byte strings by a run-length index.

A byte is removed when a ``window``-byte string that covers it also starts earlier:
in a document with a smaller id, or in the same document further to the left.

Dealing. The windows of a text are dealt by a ``gram``-byte anchor inside them, the
one with the smallest hash (the first of equals). Equal windows hold it at the same
place, so they meet; neighbouring windows share it, so one segment of text carries a
run of them (42 on average). Segments travel compressed, grouped by part; a part
holds about ``PART_BYTES`` of segments whatever the size of the corpus. An anchor with
more rows than ``hot_rows`` is lengthened to the whole window: its windows are dealt
one by one by their own hash. Equal segments are combined first in the task that
found them and again in their part: the earliest stays, later ones are settled.

Index. A part builds a run-compressed Burrows-Wheeler transform over the unlike
segments of its groups that can share a window: each window of 100 bytes holds its anchor
and 42 bytes to the left of it or to the right, so segments whose neighbourhoods occur
once are left out (suffixes by prefix doubling, every segment with a terminator of its
own). Groups of more than ``GROUP_BYTES`` are lengthened in their part, in two steps: to
pieces of 12 windows, and to single windows where the pieces' groups are still as large. Of the suffix order only the run heads are kept: the text position at
each head, the position just before it in the order, and their common prefix. That is
enough, as inside a run both positions only move on by one byte with their texts
(phi(i) = phi(s) + i - s and PLCP(i) = PLCP(s) - (i - s) for the sampled s before i).

Matching statistics. The segments are streamed over the samples: each window position
gets the length of its longest match with its predecessor in suffix order, and where
that is. Lengths of ``window`` or more chain equal windows together; of each chain the
earliest window stays and the others mark their bytes.

Defined results: a null text is empty; texts shorter than a window lose nothing; a
null doc_id counts as smaller than every other; rows with one doc_id are no earlier
than each other, so repeated rows keep the same bytes; kept bytes need not be whole
UTF-8 characters, hence a binary column; an empty table gives an empty result; other
columns are ignored whatever their names. doc_id is an integer and need not be unique
(results are joined by doc_id and a hash of the text).
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import mix64, slices, text_buffer, tune, word_hashes
from candlewick.session import checkpoint_root

WINDOW = 100
GRAM = 16
HOT_ROWS = 200_000
#: At most this many anchors can be hot (their list is broadcast).
HOT_KEYS = 1 << 20
PART_BYTES = 24 << 20
PARTITION_PARTS = 4
INDEX_BYTES = 256 << 10           # indexed at once, in cache; never less than a group
GROUP_BYTES = 2 << 20            # larger groups are lengthened in their part
NARROWER = (12, 1)               # windows a piece, at first and then
SLICE = 4 << 20
LOT_BYTES = 64 << 20             # text whose spans are held at a time, if the table is large
LEAST_LOTS = 256
SPANS = 1 << 18                  # spans packed at a time
LEVEL = 3                        # of zstandard: half the time of 6 and a twentieth more bytes
DEAL_BYTES = 32 << 20            # text dealt at once, and bytes hashed at once in cache
CACHE_BYTES = 128 << 10
_ALONE = 255                     # lead of a window that was dealt on its own
_LOWEST = -(1 << 63)
_U = np.uint64


def _words64(buf: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on, as little-endian numbers (a view)."""
    return np.ndarray((len(buf) - 7,), "<u8", np.ascontiguousarray(buf).data, 0, (1,))


def _gram_hash(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of 16 bytes given as two numbers."""
    x = low * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(29)
    x += high
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(32)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the ``width`` values from each position on (width >= 1)."""
    size, n = 1, len(key) - width + 1
    while 2 * size <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    return key[:n] if size == width else np.minimum(key[:n], key[width - size:width - size + n])


def anchors(buf, offs, window: int):
    """Segments of a slice: (anchor hash, document, first byte, anchor's place in the
    segment, windows in it)."""
    out = [_anchors(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window, i, int(offs[i]))
           for i, j in slices(offs, CACHE_BYTES)]
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, _U),) + (np.zeros(0, np.int64),) * 4


def _anchors(buf, offs, window, doc0, byte0):
    n, last = len(buf) - GRAM + 1, len(buf) - window + 1
    if last <= 0:
        return (np.zeros(0, _U),) + (np.zeros(0, np.int64),) * 4
    word = _words64(buf)
    g = _gram_hash(word[:n], word[8:8 + n])
    # the position stands in the low bits, so of equal hashes the first is least
    bits = max(n.bit_length(), 1)
    key = _least((g >> _U(bits) << _U(bits)) | np.arange(n, dtype=np.uint64), window - GRAM + 1)
    long = np.diff(offs) >= window
    # windows lie inside one document: +1 where they begin, -1 after the last
    edge = np.zeros(last + 1, np.int8)
    edge[offs[:-1][long]] = 1
    edge[offs[1:][long] - window + 1] -= 1
    ok = np.cumsum(edge, dtype=np.int8)[:-1] > 0
    new = ok.copy()
    new[1:] &= (key[1:] != key[:-1]) | ~ok[:-1]
    new[offs[:-1][long]] = True
    first = np.flatnonzero(new)
    upto = np.concatenate(([0], np.cumsum(ok)))
    count = upto[np.append(first[1:], last)] - upto[first]
    at = (key[first] & _U((1 << bits) - 1)).astype(np.int64)
    doc = np.searchsorted(offs, first, side="right") - 1
    return g[at], doc + doc0, first + byte0, at - first, count


def _gather(buf, start, size):
    """The byte ranges end to end, and their offsets."""
    to = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(to[-1], np.uint8)
    for i, j in slices(to, CACHE_BYTES):
        widest = int(size[i:j].max())
        if widest > len(buf) or widest * (j - i) > 4 * (to[j] - to[i]):
            at = np.repeat(start[i:j] - to[i:j], size[i:j]) + np.arange(to[i], to[j])
            out[to[i]:to[j]] = buf[at]
        elif widest:                               # items of one width, and of each its own part
            skip = np.maximum(start[i:j] + widest - len(buf), 0)
            items = np.ndarray((len(buf) - widest + 1,), f"V{widest}", buf.data, 0, (1,))[start[i:j] - skip]
            col = np.arange(widest)
            own = col < (skip + size[i:j])[:, None]
            if skip.any():
                own &= col >= skip[:, None]
            out[to[i]:to[j]] = items.view(np.uint8).reshape(j - i, widest)[own]
    return out, to


def _cut_alone(hot, cols):
    """The segments with their hot ones cut into single windows."""
    g, doc, first, lead, count = cols
    if not len(hot) or not len(g):
        return cols
    is_hot = hot[np.minimum(np.searchsorted(hot, g), len(hot) - 1)] == g
    if not is_hot.any():
        return cols
    n = count[is_hot]
    off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    one = [np.repeat(x[is_hot], n) for x in (g, doc, first)]
    cold = [x[~is_hot] for x in cols]
    cut = (one[0], one[1], one[2] + off, np.full(len(off), _ALONE), np.ones(len(off), np.int64))
    return tuple(np.concatenate(x) for x in zip(cold, cut))


def _settle(g, digest, doc, th, first):
    """Order and fate of segments with equal (g, digest): indices to keep, indices of
    later copies; a row that came twice is kept once."""
    order = np.lexsort((first, th, doc, digest, g))
    g, digest, doc, th, first = (x[order] for x in (g, digest, doc, th, first))
    head = np.ones(len(g), bool)
    head[1:] = (g[1:] != g[:-1]) | (digest[1:] != digest[:-1])
    same_row = np.zeros(len(g), bool)
    same_row[1:] = ~head[1:] & (doc[1:] == doc[:-1]) & (th[1:] == th[:-1])
    twice = same_row.copy()
    twice[1:] &= first[1:] == first[:-1]
    earliest = doc[np.maximum.accumulate(np.where(head, np.arange(len(g)), 0))]
    later = (doc > earliest) | same_row
    return order[~later], order[later & ~twice]


_HEAD = struct.Struct("<cII7I")


def _planes(x: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next, and so on."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _whole(raw: bytes, kind: str, n: int) -> np.ndarray:
    x = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(x.itemsize, n).T).view(x).reshape(n)


def _pack(docs, ths, didx, first, lead, count, text) -> bytes:
    """A blob of segments whose documents' numbers rise by one at most. Each column is
    compressed on its own: together they took a tenth more."""
    to = zstandard.ZstdCompressor(level=LEVEL)
    cols = [to.compress(x) for x in (
        _planes(np.diff(docs, prepend=0).astype("<i8")), ths.astype("<i8").tobytes(),
        np.diff(didx, prepend=0).astype(np.uint8).tobytes(), _planes(first.astype("<u4")),
        lead.astype(np.uint8).tobytes(), count.astype(np.uint8).tobytes(), text.tobytes())]
    return _HEAD.pack(b"p", len(docs), len(didx), *map(len, cols)) + b"".join(cols)


def _unpack(raw: bytes):
    _, k, n, *sizes = _HEAD.unpack_from(raw)
    at, out, by = _HEAD.size, [], zstandard.ZstdDecompressor()
    for size in sizes:
        out.append(by.decompress(raw[at:at + size]))
        at += size
    docs, ths = np.cumsum(_whole(out[0], "<i8", k)), np.frombuffer(out[1], "<i8")
    didx, first = np.cumsum(np.frombuffer(out[2], np.uint8), dtype=np.int64), _whole(out[3], "<u4", n).astype(np.int64)
    lead, count, text = (np.frombuffer(x, np.uint8) for x in out[4:])
    return docs[didx], ths[didx], first, lead.astype(np.int64), count.astype(np.int64), text


def _repeated(g: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(g)
    same = g[order[1:]] == g[order[:-1]]
    out = np.zeros(len(g), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _combined(buf, g, first, size, doc, th, at):
    """Segments to keep and later copies of them. ``first`` is ascending; only the
    anchors that occur twice need the segments' digests."""
    twice = np.flatnonzero(_repeated(g))
    if not len(twice):
        return np.arange(len(g)), twice
    f = first[twice]
    digest = word_hashes(buf, f, f + size[twice], lower=False)
    keep, later = _settle(g[twice], digest, doc[twice], th[twice], at[twice])
    alone = np.ones(len(g), bool)
    alone[twice] = False
    alone[twice[keep]] = True
    return np.flatnonzero(alone), twice[later]


def _may_share(text, to, lead, count, rows, window: int) -> np.ndarray:
    """Those of ``rows`` (segments with repeated anchors, ascending) that can have a window
    in common with another. A window that reaches ``lo`` to ``hi`` bytes to the left of its
    anchor holds all bytes from ``lo`` before the anchor to ``window - hi`` after its start;
    a segment stays if such a neighbourhood of one of its windows occurs in another. Equal
    windows have it alike, so none is lost. Segments that share little more than an anchor
    with others, the more of them the larger the table, need not be indexed."""
    for pieces in (2, 4):                          # the second pass sees what the first left
        own = rows[lead[rows] != _ALONE]
        buf, start = _gather(text, to[own], count[own] + window - 1)
        p, n = lead[own], count[own]
        start = start[:-1] + p
        stay = np.zeros(len(own), bool)
        edges = [(window - GRAM) * k // pieces for k in range(pieces + 1)]
        for lo, hi in zip(edges, edges[1:]):
            has = np.flatnonzero((p >= lo) & (p - n + 1 <= hi))
            stay[has[_repeated(word_hashes(buf, start[has] - lo, start[has] + window - hi, lower=False))]] = True
        rows = np.sort(np.concatenate((own[stay], rows[lead[rows] == _ALONE])))
    return rows


def _blobs(buf, offs, docs, ths, hot, parts: int, window: int):
    """(part, blob) rows of a slice, one after the other, and the spans of the copies
    settled in it."""
    g, doc, first, lead, count = _cut_alone(hot, anchors(buf, offs, window))
    if not len(g):
        return iter(()), None
    size = count + window - 1
    if len(hot):
        order = np.argsort(first, kind="stable")
        g, doc, first, lead, count, size = (x[order] for x in (g, doc, first, lead, count, size))
        cut = np.flatnonzero(lead == _ALONE)
        g = g.copy()
        g[cut] = word_hashes(buf, first[cut], first[cut] + window, lower=False)
    at = first - offs[doc]
    keep, later = _combined(buf, g, first, size, docs[doc], ths[doc], at)
    spans = (docs[doc[later]], ths[doc[later]], at[later], at[later] + size[later])
    part = ((g[keep] >> _U(20)) % _U(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    keep, part = keep[order], part[order]
    edges = np.flatnonzero(np.diff(part, prepend=-1))

    def rows():
        for a, z in zip(edges, np.append(edges[1:], len(keep))):
            k = keep[a:z]
            own, didx = np.unique(doc[k], return_inverse=True)
            text, _ = _gather(buf, first[k], size[k])
            yield int(part[a]), _pack(docs[own], ths[own], didx, at[k], lead[k], count[k], text)
    return rows(), spans


def _ordered(high: np.ndarray, low: np.ndarray, width: int):
    """Positions by (high, low, position), and where (high, low) is new in that order.
    Numbers and positions have ``width`` bits; positions ride in the low bits of what is
    sorted, so nothing is sorted by reference."""
    at, mask = np.arange(len(high), dtype=np.uint64), _U((1 << width) - 1)
    new = np.ones(len(high), bool)
    if 3 * width <= 64:
        key = (high << _U(width) | low) << _U(width) | at
        key.sort()
        order = (key & mask).astype(np.int64)
        key >>= _U(width)
        new[1:] = key[1:] != key[:-1]
        return order, new
    key = low << _U(width) | at
    key.sort()
    by_low = (key & mask).astype(np.int64)
    key = high[by_low].astype(np.uint64) << _U(width) | at
    key.sort()
    order = by_low[(key & mask).astype(np.int64)]
    key >>= _U(width)
    low = low[order]
    new[1:] = (key[1:] != key[:-1]) | (low[1:] != low[:-1])
    return order, new


def _ranks(t: np.ndarray, rem: np.ndarray, longest: int):
    """(bytes, rank) levels: ranks of all suffixes by their first h, 2h, 4h, ... bytes, h
    at most 7, until all differ or the longest is ranked; a suffix that ends sooner sorts
    first. Also the order of the suffixes, equal ones by position."""
    n = len(t)
    width = n.bit_length()
    used = np.zeros(256, bool)
    used[t] = True
    letter = np.cumsum(used).astype(np.uint64)[t]  # 0 stands for the end
    bits = int(used.sum()).bit_length()
    h = max(1, min(7, (64 - width) // bits))
    key = np.zeros(n, np.uint64)
    for k in range(min(h, n)):
        key <<= _U(bits)
        key[:n - k] |= letter[k:] * (rem[:n - k] > k)
    key <<= _U(max(h - n, 0) * bits)
    key = key << _U(width) | np.arange(n, dtype=np.uint64)
    key.sort()
    order = (key & _U((1 << width) - 1)).astype(np.int64)
    key >>= _U(width)
    new = np.concatenate(([True], key[1:] != key[:-1]))
    del key, letter
    levels = []
    while True:
        rank = np.empty(n, np.uint32)
        rank[order] = np.cumsum(new, dtype=np.uint32) - np.uint32(1)
        levels.append((h, rank))
        if h >= longest or new.all():
            return levels, order
        low = np.zeros(n, np.uint64)
        low[:n - h] = rank[h:]
        low[:n - h] += _U(1)
        low[:n - h] *= rem[:n - h] > h
        order, new = _ordered(rank.astype(np.uint64), low, width)
        h *= 2


_LOW = [_U((1 << 8 * k) - 1) for k in range(1, 7)]


def _common(levels, t, end, a, b):
    """Common bytes of the suffixes at a and b, up to the ends of their segments."""
    length = np.zeros(len(a), np.int64)
    last = len(t) - 1
    room = np.minimum(end[a] - a, end[b] - b)
    for h, rank in reversed(levels):               # at most h more bytes agree here
        same = (length < room) & (rank[np.minimum(a + length, last)] == rank[np.minimum(b + length, last)])
        length = np.minimum(length + h * same, room)
    word = _words64(np.concatenate((t, np.zeros(8, np.uint8))))
    unlike = word[np.minimum(a + length, last)] ^ word[np.minimum(b + length, last)]
    tail = np.zeros(len(a), np.int64)
    for mask in _LOW:
        tail += (unlike & mask) == 0
    return np.minimum(length + tail, room)


class RunIndex:
    """Run-compressed transform of texts with terminators, sampled at run heads."""

    def __init__(self, t: np.ndarray, to: np.ndarray):
        size = np.diff(to)
        end = np.repeat(to[1:], size)
        levels, order = _ranks(t, end - np.arange(len(t)), int(size.max()))
        before = np.where(order > 0, t[order - 1], 0).astype(np.int16)
        starts = np.zeros(len(t), bool)
        starts[to[:-1][size > 0]] = True
        before[starts[order]] = -1                 # each terminator is a letter of its own
        head = np.ones(len(t), bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] < 0)
        runs = np.flatnonzero(head)
        at, prev = order[runs], order[np.maximum(runs - 1, 0)]
        common = np.where(runs > 0, _common(levels, t, end, at, prev), 0)
        by = np.argsort(at)
        self.runs = len(runs)
        self.at, self.prev, self.common = at[by], prev[by], common[by]

    def statistics(self, positions: np.ndarray):
        """(length, source) of the longest match of the text at each position with its
        predecessor in suffix order."""
        k = np.searchsorted(self.at, positions, side="right") - 1
        ahead = positions - self.at[k]
        return self.common[k] - ahead, self.prev[k] + ahead


def _long_matches(t, to, count, doc, row, window: int):
    """Window positions (segment, offset) to mark in groups of unlike segments, which
    come in the order of their documents."""
    index = RunIndex(t, to)
    seg = np.repeat(np.arange(len(count)), count)
    off = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
    pos = to[seg] + off
    length, source = index.statistics(pos)
    place = np.full(len(t), -1)
    place[pos] = np.arange(len(pos))
    link = np.where(length >= window, place[np.clip(source, 0, len(t) - 1)], np.arange(len(pos)))
    while True:                                    # chains are short: their length halves
        further = link[link]
        if (further == link).all():
            break
        link = further
    order = np.argsort(link, kind="stable")        # within a chain by position
    chain, s = link[order], seg[order]
    head = np.ones(len(order), bool)
    head[1:] = chain[1:] != chain[:-1]
    earliest = doc[s[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]]
    same_row = np.zeros(len(order), bool)
    same_row[1:] = ~head[1:] & (row[s[1:]] == row[s[:-1]])
    marked = np.sort(order[(doc[s] > earliest) | same_row])
    return seg[marked], off[marked]


def _part_spans(blobs: list, window: int):
    """Spans (doc, th, start, end) of all repeats in a part."""
    cols = [_unpack(b) for b in blobs]
    doc, th, first, lead, count = (np.concatenate([c[k] for c in cols]) for k in range(5))
    text = np.concatenate([c[5] for c in cols])
    del cols
    size = count + window - 1
    to = np.concatenate(([0], np.cumsum(size)))
    alone = np.flatnonzero(lead == _ALONE)
    word = _words64(text)
    at = to[:-1] + np.where(lead == _ALONE, 0, lead)
    g = _gram_hash(word[at], word[at + 8])
    g[alone] = word_hashes(text, to[alone], to[alone] + window, lower=False)
    keep, later = _combined(text, g, to[:-1], size, doc, th, first)
    yield doc[later], th[later], first[later], first[later] + size[later]
    keep = _may_share(text, to[:-1], lead, count, keep[_repeated(g[keep])], window)
    yield from _group_spans(text, [x[keep] for x in (to[:-1], lead, count, doc, th, first, g)], window, NARROWER)


def _pieces(text, segments, width: int, window: int):
    """The segments (of one anchor, ascending) cut into the windows that reach ``lo`` to
    ``lo + width - 1`` bytes to the left of the anchor, for each ``lo``; pieces form a
    group if the bytes that all these windows hold are equal, too."""
    at, lead, count, doc, th, first, _ = segments
    out = []
    for lo in range(0, window - GRAM + 1, width):
        hi = min(lo + width - 1, window - GRAM)
        most, least = np.minimum(lead, hi), np.maximum(lead - count + 1, lo)
        k = np.flatnonzero(most >= least)
        skip, anchor = (lead - most)[k], (at + lead)[k]
        g = mix64(word_hashes(text, anchor - lo, anchor + window - hi, lower=False) + _U(lo))
        out.append((at[k] + skip, most[k], (most - least)[k] + 1, doc[k], th[k], first[k] + skip, g))
    cols = [np.concatenate(x) for x in zip(*out)]
    order = np.argsort(cols[0], kind="stable")
    return [x[order] for x in cols]


def _group_spans(text, segments, window: int, narrower: tuple):
    """Spans of the repeats in groups of unlike segments. As a hot anchor's, the windows of
    a large group are lengthened, step by step: its pieces that are equal are settled, the
    others are smaller groups."""
    order = np.lexsort([segments[k] for k in (5, 4, 3, 6)])
    at, lead, count, doc, th, first, group = (x[order] for x in segments)
    if not len(order):
        return
    size = count + window - 1
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    upto = np.concatenate(([0], np.cumsum(size)))
    a = 0
    while a < len(edge) - 1:                       # whole groups, about INDEX_BYTES of them
        z = max(int(np.searchsorted(upto[edge], upto[edge[a]] + INDEX_BYTES, side="right")) - 1, a + 1)
        k = slice(edge[a], edge[z])
        a = z
        if upto[k.stop] - upto[k.start] > GROUP_BYTES and narrower and lead[k].max() != _ALONE:
            by = np.argsort(at[k])
            part = _pieces(text, [x[k][by] for x in (at, lead, count, doc, th, first, group)], narrower[0], window)
            size_ = part[2] + window - 1
            keep, later = _combined(text, part[6], part[0], size_, part[3], part[4], part[5])
            yield part[3][later], part[4][later], part[5][later], part[5][later] + size_[later]
            if narrower[0] > 1:                    # else all equal windows have met
                keep = keep[_repeated(part[6][keep])]
                yield from _group_spans(text, [x[keep] for x in part], window, narrower[1:])
            continue
        t, own = _gather(text, at[k], size[k])
        row = np.concatenate(([0], np.cumsum((doc[k][1:] != doc[k][:-1]) | (th[k][1:] != th[k][:-1]))))
        seg, off = _long_matches(t, own, count[k], doc[k], row, window)
        if len(seg):
            new = np.concatenate(([True], (seg[1:] != seg[:-1]) | (off[1:] != off[:-1] + 1)))
            b, e = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(seg)) - 1
            yield doc[k][seg[b]], th[k][seg[b]], first[k][seg[b]] + off[b], first[k][seg[b]] + off[e] + window


def _hot_anchors(texts: DataFrame, size: int, window: int, hot_rows: int) -> np.ndarray:
    """Sorted hashes of the anchors with more than ``hot_rows`` segments. A task
    reports those it met three times or more. At most HOT_KEYS anchors can qualify, as
    the limit is at least the number of segments over HOT_KEYS."""
    def run(batches):
        seen, held = [], 0
        for b in batches:
            buf, offs = text_buffer(b.column(0))
            for i, j in slices(offs, SLICE):
                seen.append(anchors(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], window)[0])
                held += len(seen[-1])
        g, n = np.unique(np.concatenate(seen), return_counts=True) if held else (np.zeros(0, _U), np.zeros(0, int))
        many = n >= 3
        yield pa.RecordBatch.from_arrays([pa.array(g[many].view(np.int64)), pa.array(n[many].astype(np.int64))],
                                         ["g", "n"])

    least = max(hot_rows, size // HOT_KEYS)        # a segment starts at a byte of its own
    rows = texts.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")) \
        .where(F.col("n") > least).select("g").collect()
    return np.sort(np.array([r["g"] for r in rows], np.int64).view(_U))


def _gathered(batches):
    """Tables of about DEAL_BYTES of rows."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= DEAL_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _row_keys(doc, th) -> np.ndarray:
    return mix64(doc.view(_U) * _U(0x9E3779B97F4A7C15) + th.view(_U))


def _lots(doc, th, lots: int):
    """(lot, its rows) by the rows' ids and hashes."""
    lot = (_row_keys(doc, th) % _U(lots)).astype(np.int32)
    order = np.argsort(lot, kind="stable")
    lot = lot[order]
    edges = np.append(np.flatnonzero(np.diff(lot, prepend=-1)), len(lot))
    for a, z in zip(edges, edges[1:]):
        yield int(lot[a]), order[a:z]


_PART = pa.schema([("part", pa.int32()), ("blob", pa.binary())])
_LOT = pa.schema([("lot", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_LOT_COLUMNS = "lot int, kind int, blob binary"


def _batches(rows, schema):
    rows = iter(rows)
    while held := list(islice(rows, 50)):
        yield pa.record_batch(list(zip(*held)), schema=schema)


def _packed_spans(found, lots: int):
    """(lot, 0, blob) of spans, some at a time."""
    def packed():
        spans = np.concatenate([np.stack(x).astype("<i8") for x in held], axis=1)
        to = zstandard.ZstdCompressor(level=LEVEL)
        for lot, rows in _lots(spans[0], spans[1], lots):
            yield lot, 0, to.compress(spans[:, rows].tobytes())

    held, size = [], 0
    for x in found:
        if len(x[0]):
            held.append(x)
            size += len(x[0])
        if size >= SPANS:
            yield from packed()
            held, size = [], 0
    if held:
        yield from packed()


def repeats(docs: DataFrame, window: int = WINDOW, hot_rows: int = HOT_ROWS,
            part_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """(lot, 0, blob): byte spans (doc, th, start, stop) of the texts that repeat earlier
    ones; doc is the id (the lowest long for null), th the hash of the text. Also the
    number of lots."""
    spark = docs.sparkSession
    tune(spark)
    checkpoint_root(spark)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("doc"),
                        F.xxhash64("text").alias("th"), "text").where(F.octet_length("text") >= window)
    size = int(keyed.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0)
    parts = max(8, -(-size * 7 // 2 // part_bytes))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions, lots = max(shuffles, -(-parts // PARTITION_PARTS)), max(min(shuffles, LEAST_LOTS), -(-size // LOT_BYTES))
    hot = spark.sparkContext.broadcast(_hot_anchors(keyed.select("text"), size, window, hot_rows))

    def deal(batches):
        for t in _gathered(batches):
            buf, offs = text_buffer(t.column("text"))
            rows, spans = _blobs(buf, offs, t.column("doc").to_numpy(), t.column("th").to_numpy(), hot.value,
                                 parts, window)
            if spans is not None and len(spans[0]):    # settled here: they go along as they are
                raw = zstandard.ZstdCompressor().compress(np.stack(spans).astype("<i8").tobytes())
                rows = chain([(zlib.crc32(raw) % parts, b"s" + raw)], rows)
            yield from _batches(rows, _PART)

    def index(batches):
        now, held = None, []
        for b in batches:
            for part, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if blob[:1] == b"s":
                    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), "<i8")
                    yield tuple(flat.reshape(4, -1))
                    continue
                if part != now and held:
                    yield from _part_spans(held, window)
                    held = []
                now = part
                held.append(blob)
        if held:
            yield from _part_spans(held, window)

    found = keyed.mapInArrow(deal, "part int, blob binary").repartition(partitions, "part") \
        .sortWithinPartitions("part")
    return found.mapInArrow(lambda b: _batches(_packed_spans(index(b), lots), _LOT), _LOT_COLUMNS), lots


def _cut(buf, offs, doc, start, stop):
    """(bytes, removed, runs, kept bytes) of each text, less the spans given by the
    text's number (ascending) and their bytes in it."""
    n, docs = len(buf), len(offs) - 1
    start, stop = start + offs[doc], stop + offs[doc]
    order = np.argsort(start, kind="stable")       # texts stay in order
    start, stop = start[order], np.maximum.accumulate(stop[order])
    opens = np.ones(len(doc), bool)
    opens[1:] = (start[1:] > stop[:-1]) | (doc[1:] != doc[:-1])
    a, doc = start[opens], doc[opens]
    z = stop[np.append(np.flatnonzero(opens)[1:], len(stop)) - 1] if len(a) else a
    size, gone = np.diff(offs), np.zeros(docs, np.int64)
    np.add.at(gone, doc, z - a)
    edge = np.concatenate(([0], np.stack((a, z), axis=1).ravel(), [n]))
    stays = np.repeat(np.arange(len(edge) - 1) % 2 == 0, np.diff(edge))
    to = np.concatenate(([0], np.cumsum(size - gone))).astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), docs, [None, pa.py_buffer(to), pa.py_buffer(buf[stays])])
    return size, gone, np.bincount(doc, minlength=docs), kept


class _Spans:
    """Spans of a lot, found by their rows."""

    def __init__(self, blobs: list):
        cols = [np.frombuffer(zstandard.ZstdDecompressor().decompress(b), "<i8").reshape(4, -1) for b in blobs]
        doc, th, start, stop = np.concatenate(cols, axis=1) if cols else np.zeros((4, 0), np.int64)
        key = _row_keys(doc, th)
        order = np.lexsort((th, doc, key))
        doc, th, key, self.start, self.stop = (x[order] for x in (doc, th, key, start, stop))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])
        self.edge = np.append(np.flatnonzero(new), len(new))
        self.doc, self.th, self.key = doc[new], th[new], key[new]

    def of(self, doc, th):
        """(row, start, stop) of the spans of rows given by id and hash."""
        key, m = _row_keys(doc, th), len(self.key)
        at = np.searchsorted(self.key, key)
        row = np.arange(len(key))
        while True:                                # keys are hardly ever equal by chance
            row = row[(at[row] < m) & (self.key[np.minimum(at[row], m - 1)] == key[row])] if m else row[:0]
            other = row[(self.doc[at[row]] != doc[row]) | (self.th[at[row]] != th[row])]
            if not len(other):
                break
            at[other] += 1
        first, many = self.edge[at[row]], np.diff(self.edge)[at[row]]
        k = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.repeat(row, many), self.start[k], self.stop[k]


def remove_repeats(docs: DataFrame, **params) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs)
    and kept (the remaining bytes). Texts and spans meet packed in lots, as Spark's own
    rows of all the texts take nearly twice the disk."""
    found, lots = repeats(docs.select("doc_id", "text"), **params)
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("doc"),
                       F.xxhash64("text").alias("th"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def texts(batches):
        codec = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))

        def packed():
            for t in _gathered(batches):
                dealt, at = list(_lots(t.column("doc").to_numpy(), t.column("th").to_numpy(), lots)), 0
                t = t.take(np.concatenate([k for _, k in dealt])).combine_chunks()
                for lot, k in dealt:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, t.schema, options=codec) as to:
                        to.write_table(t.slice(at, len(k)))
                    at += len(k)
                    yield lot, 1, sink.getvalue().to_pybytes()
        yield from _batches(packed(), _LOT)

    def cut(batches):
        now, held, found = None, [], None
        for b in batches:
            for lot, is_text, blob in zip(*(c.to_pylist() for c in b.columns)):
                if lot != now:
                    now, held, found = lot, [], None
                if not is_text:                    # a lot's spans come before its texts
                    held.append(blob)
                    continue
                found = found or _Spans(held)
                for part in pa.ipc.open_stream(blob).read_all().combine_chunks().to_batches():
                    buf, offs = text_buffer(part.column(3))
                    row, start, stop = found.of(part.column(1).to_numpy(), part.column(2).to_numpy())
                    for i, j in slices(offs, SLICE):
                        a, z = np.searchsorted(row, (i, j))
                        n, gone, runs, kept = _cut(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i], row[a:z] - i,
                                                   start[a:z], stop[a:z])
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).slice(i, j - i), pa.array(n), pa.array(gone), pa.array(runs), kept],
                            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return rows.mapInArrow(texts, _LOT_COLUMNS).union(found) \
        .repartition(max(shuffles, lots), "lot").sortWithinPartitions("lot", "kind") \
        .mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
