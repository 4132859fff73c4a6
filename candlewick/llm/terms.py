"""Hashed terms of whole texts, and the labelled sample that classifiers learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import (ALNUM, LOWER, NON_SPACE, _CODES_LOWER, _HASH_BYTES, _powers,
                                      mix64, word_hashes, words)

_U = np.uint64

# byte classes of a word's outline: lower case, upper case, digit, signs
_OUTLINE = np.full(256, ord("#"), np.uint8)
for _a, _z, _c in ((0x61, 0x7A, "a"), (0x80, 0xFF, "a"), (0x41, 0x5A, "A"), (0x30, 0x39, "0")):
    _OUTLINE[_a:_z + 1] = ord(_c)
for _c in ".,;:!?'-":
    _OUTLINE[ord(_c)] = ord(_c)


def doc_of(wo: np.ndarray) -> np.ndarray:
    """Document of each word, from word offsets."""
    return np.repeat(np.arange(len(wo) - 1), np.diff(wo))


def outline_terms(buf, offs) -> tuple[np.ndarray, np.ndarray]:
    """(document, term hash) of every occurrence of: a lower-cased word, the
    outline of a word (its byte classes, runs collapsed), the outlines of two
    neighbours, and a word equal to the one before it."""
    starts, ends, wo = words(buf, offs, NON_SPACE)
    doc = doc_of(wo)
    word = word_hashes(buf, starts, ends, lower=True)
    kind = _OUTLINE[buf]
    first = np.zeros(len(buf), bool)
    first[starts] = True
    first[1:] |= kind[1:] != kind[:-1]
    first &= NON_SPACE[buf]
    small = kind[first]                                   # outlines, end to end
    at = np.concatenate(([0], np.cumsum(first)))
    shape = word_hashes(small, at[starts], at[ends], lower=False)
    near = np.flatnonzero(doc[1:] == doc[:-1])
    pair = mix64(shape[near] * _U(3) + shape[near + 1])
    same = near[word[near] == word[near + 1]]
    again = np.full(len(same), 0x5851F42D4C957F2D, _U)
    return (np.concatenate((doc, doc, doc[near], doc[same])),
            np.concatenate((word, mix64(shape + _U(1)), pair, again)))


def stem_terms(buf, offs, sizes=(4, 5, 6)) -> tuple[np.ndarray, np.ndarray]:
    """(document, term hash) of every lower-cased word and of its first 4, 5 and
    6 bytes where the word is longer."""
    starts, ends, wo = words(buf, offs, ALNUM)
    doc = doc_of(wo)
    size = ends - starts
    docs, terms = [], []
    i, n = 0, len(starts)
    while i < n:                       # as word_hashes, with several ends to a word
        j = max(int(np.searchsorted(ends, starts[i] + _HASH_BYTES, side="right")), i + 1)
        a, b = int(starts[i]), int(ends[j - 1])
        p, q = _powers(b - a + 1)
        acc = np.zeros(b - a + 1, _U)
        np.cumsum(_CODES_LOWER[buf[a:b]] * p[:b - a], out=acc[1:])
        s = starts[i:j] - a
        base, back = acc[s], q[s]
        docs.append(doc[i:j])
        terms.append(mix64((acc[ends[i:j] - a] - base) * back))
        for k in sizes:
            longer = np.flatnonzero(size[i:j] > k)
            docs.append(doc[i:j][longer])
            terms.append(mix64((acc[s[longer] + k] - base[longer]) * back[longer] + _U(k)))
        i = j
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(docs), np.concatenate(terms)


def held_out(doc_id: str = "doc_id"):
    """True for the rows whose labels may not be learned."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents that are not held
    out, one row of each id, picked by a hash of the id.

    Only ids that ``docs`` holds are counted against ``rows``. An id with several
    labels has the larger one; an id with several texts has the least of them by bytes
    (a null text only if there is no other)."""
    here = docs.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    pool = (labels.select("doc_id", F.col(label).cast("int").alias("label"))
            .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.max("label").alias("label"))
            .join(here, "doc_id", "left_semi")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return (docs.select("doc_id", "text").join(F.broadcast(pool), "doc_id")      # at most ``rows`` ids
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")))
