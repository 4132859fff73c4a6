"""Toxicity by a factorization machine over hashed terms.

Terms are 64-bit hashes of lower-cased words and of their first 4, 5 and 6 bytes.
From a bounded sample of labelled documents (``sample_rows``) the ``terms`` most
telling ones are chosen by a chi-square statistic; the machine then learns a bias, a
weight per term and ``factors`` latent factors per term, so that pairs of terms
(an insult and a group mention) weigh more or less than their sum. Its input is the
presence of each chosen term in the whole text; the other terms have weight zero,
so length alone moves no score. The model (a few thousand floats, bounded by
``terms`` and ``factors``) is broadcast, scoring is one narrow pass.

Defined results: a text without chosen terms (null and empty ones too) gets the
bias alone; without any label to learn from every score is 0.5; repeated rows
score alike; ties between terms go to the smaller hash; an empty table gives an
empty result. Only the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import slices, text_buffer, tune
from candlewick.llm.terms import held_out, labelled_sample, stem_terms

SAMPLE_ROWS = 16_000
TERMS = 1024
FACTORS = 8
MIN_DOCS = 4
THRESHOLD = 0.7


class FactorizationMachine:
    """sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), x in {0, 1}."""

    def __init__(self, terms: np.ndarray, factors: int = FACTORS, seed: int = 11):
        self.terms = np.sort(terms)
        rng = np.random.default_rng(seed)
        self.b = 0.0
        self.w = np.zeros(len(terms))
        self.v = rng.normal(0, 0.02, (len(terms), factors))
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self.terms >> np.uint64(44)] = True

    def find(self, doc, term) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (document, chosen term) pairs, sorted."""
        may = np.flatnonzero(self.bits[term >> np.uint64(44)])
        if not len(may):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.terms, term[may]), len(self.terms) - 1)
        ok = self.terms[at] == term[may]
        pair = np.unique(doc[may[ok]] * len(self.terms) + at[ok])
        return pair // len(self.terms), pair % len(self.terms)

    def logits(self, doc, at, n: int) -> np.ndarray:
        z = np.full(n, self.b)
        if len(doc):
            z += np.bincount(doc, self.w[at], n)
            for f in range(self.v.shape[1]):
                s = np.bincount(doc, self.v[at, f], n)
                z += 0.5 * (s * s - np.bincount(doc, self.v[at, f] ** 2, n))
        return z

    def fit(self, doc, at, y, steps: int = 300, rate: float = 0.05, decay: float = 1e-4):
        """Full-batch Adam on the logistic loss."""
        n = len(y)
        p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.b = float(np.log(p0 / (1 - p0)))
        x = np.zeros((n, len(self.terms)), np.float32)
        x[doc, at] = 1
        state = [np.zeros_like(g) for g in (np.zeros(1), self.w, self.v)]
        second = [np.zeros_like(g) for g in state]
        for t in range(1, steps + 1):
            s = x @ self.v.astype(np.float32)
            z = self.b + x @ self.w + 0.5 * (s * s - x @ (self.v ** 2).astype(np.float32)).sum(axis=1)
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
            xe = x.T @ e.astype(np.float32)
            grads = [np.array([e.sum()]), xe + decay * self.w,
                     x.T @ (s * e[:, None].astype(np.float32)) - self.v * xe[:, None] + decay * self.v]
            for g, m, r, p in zip(grads, state, second, ("b", "w", "v")):
                m += 0.1 * (g - m)
                r += 0.001 * (g * g - r)
                step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(r / (1 - 0.999 ** t)) + 1e-8)
                setattr(self, p, self.b - float(step[0]) if p == "b" else getattr(self, p) - step)
        return self


def choose_terms(sample: DataFrame, terms: int, min_docs: int) -> np.ndarray:
    """Hashes of the terms that tell the labels apart best (at most ``terms``)."""
    def run(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(0))
            label = b.column(1).to_numpy().astype(np.int64)
            for i, j in slices(offs):
                doc, term = stem_terms(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                order = np.lexsort((term, doc))
                d, t = doc[order], term[order]
                new = np.flatnonzero((np.diff(d, prepend=-1) != 0) | (np.diff(t.view(np.int64), prepend=0) != 0)
                                     | (np.arange(len(d)) == 0))
                t, y = t[new], label[i + d[new]]
                u, at = np.unique(t, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(np.bincount(at, y, len(u)).astype(np.int64)),
                     pa.array(np.bincount(at, minlength=len(u)).astype(np.int64))], ["term", "a", "n"])

    size = sample.agg(F.count("*").alias("n"), F.sum("label").alias("a")).first()
    n, a = float(size["n"]), float(size["a"] or 0)
    if not 0 < a < n:
        return np.zeros(0, np.uint64)
    by = sample.select("text", "label").mapInArrow(run, "term long, a long, n long") \
               .groupBy("term").agg(F.sum("a").alias("a"), F.sum("n").alias("n")) \
               .where(F.col("n") >= min_docs)
    expect = F.col("n") * F.lit(a / n)
    chi = (F.col("a") - expect) * (F.col("a") - expect) / (expect * F.lit(1 - a / n))
    rows = by.orderBy(chi.desc(), "term").limit(terms).collect()
    return np.array([r["term"] for r in rows], np.int64).view(np.uint64)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS,
        terms: int = TERMS, factors: int = FACTORS, min_docs: int = MIN_DOCS):
    """The machine, or None when the labels have only one value."""
    from candlewick.session import checkpoint_root
    tune(docs.sparkSession)
    checkpoint_root(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, sample_rows).select("text", "label").checkpoint()
    chosen = choose_terms(sample, terms, min_docs)
    if not len(chosen):
        return None
    fm = FactorizationMachine(chosen, factors)

    def run(batches):
        for b in batches:
            buf, offs = text_buffer(b.column(0))
            for i, j in slices(offs):
                doc, at = fm.find(*stem_terms(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))
                cut = np.searchsorted(doc, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(cut), pa.array(at)), b.column(1).slice(i, j - i)],
                    ["terms", "label"])

    rows = sample.mapInArrow(run, "terms array<long>, label int").collect()    # at most sample_rows
    size = [len(r["terms"]) for r in rows]
    doc = np.repeat(np.arange(len(rows)), size)
    at = np.array([t for r in rows for t in r["terms"]], np.int64)
    return fm.fit(doc, at, np.array([r["label"] for r in rows], np.float64))


def score(docs: DataFrame, fm) -> DataFrame:
    """(doc_id, score) of every document."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(fm)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        fm = shared.value
        for b in batches:
            buf, offs = text_buffer(b.column(1))
            for i, j in slices(offs):
                z = np.zeros(j - i)
                if fm is not None:
                    pairs = fm.find(*stem_terms(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))
                    z = fm.logits(*pairs, j - i)
                p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(p)],
                                                 ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **params) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return score(docs, fit(docs, labels, **params)).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
