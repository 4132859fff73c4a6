"""Whole-text helpers for Arrow batches: byte slices, words and word hashes.

Texts are handled as the UTF-8 bytes that Arrow already holds, so a pass over a
batch is a handful of numpy operations instead of a Python loop over words.
Every helper sees whole texts; a slice boundary always falls between documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_HASH_BYTES = 1 << 20

_U = np.uint64


def tune(spark) -> None:
    """Arrow batches small enough for long documents (row and byte bound)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def text_buffer(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("") if col.null_count else col
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges [i, j) of documents holding at most ``limit`` bytes (or one document)."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def byte_class(ranges) -> np.ndarray:
    """Boolean table of the bytes in the inclusive ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return t


#: Word bytes of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
#: (the latter after lower-casing A-Z, so A-Z count as word bytes).
NON_SPACE = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def words(buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """(starts, ends, word offsets per document) of the words in ``buf``.

    ``offs`` are document boundaries relative to ``buf``; no word crosses one.
    """
    m = is_word[buf]
    n = len(m)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    inner = offs[(offs > 0) & (offs < n)]
    first[inner] = m[inner]
    last[inner - 1] = m[inner - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n (wrapping 64-bit), grown on demand."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        n = max(n, _HASH_BYTES + 1)
        with np.errstate(over="ignore"):
            p = np.full(n, _BASE, _U)
            q = np.full(n, _INV, _U)
            p[0] = q[0] = 1
            _POWERS["p"], _POWERS["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POWERS["p"], _POWERS["q"]


_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(_U)
_CODES_LOWER = _CODES[LOWER]


def word_hashes(buf, starts, ends, lower: bool) -> np.ndarray:
    """64-bit hash of each word's bytes (A-Z folded when ``lower``).

    Works through the words in runs of about 1 MB so that the power tables and
    temporaries stay small whatever the length of a document.
    """
    out = np.empty(len(starts), _U)
    codes = _CODES_LOWER if lower else _CODES
    i, n = 0, len(starts)
    while i < n:
        j = max(int(np.searchsorted(ends, starts[i] + _HASH_BYTES, side="right")), i + 1)
        a, b = int(starts[i]), int(ends[j - 1])
        p, q = _powers(b - a + 1)
        acc = np.zeros(b - a + 1, _U)
        np.cumsum(codes[buf[a:b]] * p[:b - a], out=acc[1:])
        s = starts[i:j] - a
        out[i:j] = (acc[ends[i:j] - a] - acc[s]) * q[s]
        i = j
    return mix64(out)


_GRAM = _U(0xD6E8FEB86659FD93)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` values from each position on (``len(h) - k + 1`` of them).

    Built by doubling: a gram of 2m values is two grams of m values.
    """
    if len(h) < k:
        return np.zeros(0, _U)
    parts, size, mult, done, acc = h, 1, int(_GRAM), 0, None
    rest, scale = k, 1
    mask = (1 << 64) - 1
    while rest:
        if rest & 1:
            piece = parts[done:]
            if acc is None:
                acc = piece
            else:
                n = min(len(acc), len(piece))
                acc = acc[:n] + piece[:n] * _U(scale)
            scale = scale * pow(int(_GRAM), size, 1 << 64) & mask
            done += size
        rest >>= 1
        if rest:
            parts = parts[:-size] + parts[size:] * _U(mult)
            size *= 2
            mult = mult * mult & mask
    return mix64(acc[:len(h) - k + 1])


def take_utf8(buf, start, end) -> str:
    """The text between two byte positions."""
    return buf[start:end].tobytes().decode("utf-8")
