"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms (words, word outlines, neighbouring outlines, repeats) are hashed into
``buckets``; inverse document frequencies are counted over all documents. A
bounded sample of labelled documents (``sample_rows``, at most) gives the latent
space by a randomised truncated SVD of its weighted term matrix. The labelled
vectors (``sample_rows`` x ``dims`` floats, a few MB by those two parameters) are
broadcast; each document is projected and compared with every one of them in
blocked cosine products, and its ``neighbours`` nearest vote with their
similarity (to the power ``sharpen``) as weight.

Defined results: a text without terms (null, empty) is scored with the share of
label 1 in the sample, as is every document when no label can be learned (then
0.5); repeated rows score alike; equal similarities count by sample order;
an empty table gives an empty result. Only the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.arrowtext import slices, text_buffer, tune
from candlewick.llm.terms import held_out, labelled_sample, outline_terms
from candlewick.session import checkpoint_root

SAMPLE_ROWS = 6000
BUCKETS = 4096
DIMS = 64
NEIGHBOURS = 25
SHARPEN = 4
THRESHOLD = 0.5


def term_counts(buf, offs, buckets: int) -> np.ndarray:
    """Documents x buckets counts of one slice."""
    doc, term = outline_terms(buf, offs)
    cell = doc * buckets + (term % np.uint64(buckets)).astype(np.int64)
    n = len(offs) - 1
    return np.bincount(cell, minlength=n * buckets).reshape(n, buckets).astype(np.float32)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit rows of log-counts times idf (zero rows stay zero); works in place."""
    x = np.log1p(counts, out=counts)
    x *= idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
    return np.divide(x, norm, out=x, where=norm > 0)


def _unit(x):
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-6)


def _per_slice(batches, column, f):
    for b in batches:
        buf, offs = text_buffer(b.column(column))
        for i, j in slices(offs):
            yield b.slice(i, j - i), f(buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i])


def document_frequency(docs: DataFrame, buckets: int) -> tuple[np.ndarray, int]:
    """In how many documents each bucket occurs, and their number (all rows)."""
    def run(batches):
        df, n = np.zeros(buckets, np.int64), 0
        for part, c in _per_slice(batches, 0, lambda a, o: term_counts(a, o, buckets)):
            df += (c > 0).sum(axis=0)
            n += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets + 1)), pa.array(np.append(df, n))],
                                         ["bucket", "n"])

    rows = docs.select("text").mapInArrow(run, "bucket long, n long") \
               .groupBy("bucket").agg(F.sum("n").alias("n")).collect()   # buckets + 1 rows
    out = np.zeros(buckets + 1, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out[:-1], int(out[-1])


def latent_space(x: np.ndarray, dims: int, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x dims) by subspace iteration."""
    rng = np.random.default_rng(seed)
    k = min(dims + 16, *x.shape)
    q = rng.standard_normal((x.shape[1], k)).astype(np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ vt.T[:, :dims]).astype(np.float32)


class Voter:
    """Labelled latent vectors and the vote over the nearest of them."""

    def __init__(self, space, vectors, labels, neighbours, sharpen, idf):
        self.space, self.vectors, self.labels = space, vectors, labels
        self.neighbours, self.sharpen, self.idf = neighbours, sharpen, idf
        self.prior = float(labels.mean()) if len(labels) else 0.5

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        z = _unit(weighted(counts, self.idf) @ self.space)
        out = np.full(len(z), self.prior)
        k = min(self.neighbours, len(self.labels))
        for i in range(0, len(z), 256):                        # exact, block by block
            sim = z[i:i + 256] @ self.vectors.T
            near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            w = np.maximum(np.take_along_axis(sim, near, axis=1), 0).astype(np.float64) ** self.sharpen
            total = w.sum(axis=1)
            vote = (w * self.labels[near]).sum(axis=1)
            np.divide(vote, total, out=out[i:i + 256], where=total > 0)
        return np.clip(out, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS,
        buckets: int = BUCKETS, dims: int = DIMS, neighbours: int = NEIGHBOURS,
        sharpen: int = SHARPEN) -> Voter:
    """Learn from a bounded sample of the labels that are not held out."""
    tune(docs.sparkSession)
    checkpoint_root(docs.sparkSession)

    def run(batches):
        for part, c in _per_slice(batches, 0, lambda a, o: term_counts(a, o, buckets)):
            rows = [np.flatnonzero(r).astype(np.int32) for r in c]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k.tobytes() for k in rows], pa.binary()),
                 pa.array([r[k].tobytes() for r, k in zip(c, rows)], pa.binary()), part.column(1)],
                ["bucket", "count", "label"])

    sample = labelled_sample(docs, labels, label, sample_rows) \
        .select("text", "label").mapInArrow(run, "bucket binary, count binary, label int")
    rows = sample.collect()                                    # at most sample_rows
    df, n = document_frequency(docs, buckets)
    idf = np.log((n + 1) / (df + 1)).astype(np.float32) + np.float32(0.1)
    x = np.zeros((len(rows), buckets), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["bucket"], np.int32)] = np.frombuffer(r["count"], np.float32)
    y = np.array([r["label"] for r in rows], np.float64)
    del rows
    x = weighted(x, idf)
    used = x.any(axis=1)
    if not used.all():
        x, y = x[used], y[used]
    if not len(y):
        return Voter(None, None, y, neighbours, sharpen, idf)
    space = latent_space(x, dims)
    return Voter(space, _unit(x @ space), y, neighbours, sharpen, idf)


def score(docs: DataFrame, voter: Voter, keep: tuple = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the score of every document."""
    tune(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(voter)
    names = [f"c{k}" for k in range(len(keep))]
    flat = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)],
                       F.col("text").alias("s_text"))
    schema = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for c, n in zip(keep, names))

    def run(batches):
        v = shared.value
        buckets = len(v.idf)
        for part, c in _per_slice(batches, len(names), lambda a, o: term_counts(a, o, buckets)):
            yield pa.RecordBatch.from_arrays(part.columns[:-1] + [pa.array(v.score(c))],
                                             names + ["score"])

    return flat.mapInArrow(run, schema + "score double").select(
        *[F.col(n).alias(c) for c, n in zip(keep, names)], "score")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **params) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    return score(docs, fit(docs, labels, **params)).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **params) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    names = [f"k{i}" for i in range(len(docs.columns))]
    flat = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], "text")
    scored = score(flat, fit(docs, labels, **params), keep=tuple(names))
    return scored.where(F.col("score") >= threshold).select(
        *[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
