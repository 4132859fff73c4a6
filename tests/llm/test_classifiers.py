import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from candlewick.llm import quality, toxicity
from candlewick.sources.tables import load
from tests.conftest import SF01
from tests.llm.common import AWKWARD, table, with_extras

SF1 = "/root/testdata/sf0.1"


def held_out_accuracy(scored, labels, label):
    return scored.where("held_out").join(labels, "doc_id") \
        .agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]


def contract(scored):
    for r in scored.collect():
        assert 0 <= r.score <= 1
        want = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == want


def test_quality_held_out(spark):
    docs, labels = load(spark, SF01, "documents"), load(spark, SF01, "labels")
    out = quality.classify(docs, labels).cache()
    assert out.count() == docs.count()
    contract(out)
    assert held_out_accuracy(out, labels, "quality") > 0.95


def insults(n, seed=0):
    """Toxic: an insult and a group mention together; either alone is not."""
    rnd = random.Random(seed)
    filler = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    rows, labels = [], []
    for i in range(n):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        words = [rnd.choice(filler) for _ in range(30)] + ["insultxx"] * a + ["groupxx"] * b
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(a and b)))
    return rows, labels


def test_factorization_machine_learns_pairs(spark):
    rows, labels = insults(900)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.classify(table(spark, rows), lab, terms=64).cache()
    contract(out)
    assert held_out_accuracy(out, lab, "toxic") > 0.97


def test_machine_equals_its_formula():
    rng = np.random.default_rng(0)
    fm = toxicity.FactorizationMachine(np.arange(5, dtype=np.uint64) * np.uint64(10**17), 3)
    fm.b, fm.w, fm.v = 0.3, rng.normal(size=5), rng.normal(size=(5, 3))
    x = rng.integers(0, 2, (40, 5))
    doc, at = np.nonzero(x)
    want = [0.3 + x[i] @ fm.w + sum(fm.v[a] @ fm.v[b] * x[i, a] * x[i, b]
                                    for a in range(5) for b in range(a)) for i in range(40)]
    assert np.allclose(fm.logits(doc, at, 40), want)


def test_toxicity_on_the_tables(spark):
    docs, labels = load(spark, SF1, "documents"), load(spark, SF1, "labels")
    out = toxicity.classify(docs, labels).cache()
    assert out.count() == docs.count()
    contract(out)
    assert held_out_accuracy(out, labels, "toxic") > 0.95
    clean = out.where("held_out").join(labels.where("toxic = 0"), "doc_id")
    assert clean.agg(F.avg(F.col("predicted").cast("double"))).first()[0] < 0.01


def test_vote_equals_brute_force():
    rng = np.random.default_rng(3)
    counts = rng.poisson(0.4, (60, 32)).astype(np.float32)
    idf = rng.random(32).astype(np.float32) + 0.5
    x = quality.weighted(counts[:40].copy(), idf)
    space = quality.latent_space(x, 8)
    y = rng.integers(0, 2, 40).astype(float)
    voter = quality.Voter(space, quality._unit(x @ space), y, 5, 4, idf)
    z = quality._unit(quality.weighted(counts.copy(), idf) @ space)
    for got, q in zip(voter.score(counts.copy()), z):
        sim = voter.vectors @ q
        near = np.argsort(-sim)[:5]
        w = np.maximum(sim[near], 0) ** 4
        assert abs(got - (w @ y[near] / w.sum() if w.sum() else y.mean())) < 1e-4


def test_latent_space_is_the_truncated_svd():
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(80, 6)) @ rng.normal(size=(6, 40))).astype(np.float32)
    space = quality.latent_space(x, 6)
    assert np.allclose(x @ space @ space.T, x, atol=1e-2)


def test_awkward_rows(spark):
    rows = list(enumerate(AWKWARD)) + [(None, "no id"), (3, "a"), (3, "a")]
    docs = with_extras(table(spark, rows))
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)] + [(None, 1, 1), (4, None, 5)],
                                   "doc_id long, quality int, toxic int")
    for classify in (quality.classify, toxicity.classify):
        out = classify(docs, labels)
        assert out.count() == len(rows)
        contract(out)
    kept = quality.keep_good(docs, labels)
    assert kept.dtypes == docs.dtypes


def test_no_labels_and_no_rows(spark):
    docs, none = table(spark, [(1, "a b"), (2, None)]), table(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for classify in (quality.classify, toxicity.classify):
        assert [r.score for r in classify(docs, labels).collect()] == [0.5, 0.5]
        assert classify(none, labels).count() == 0


def test_the_sample_bound_counts_documents_not_labels(spark):
    """Labels of ids that the table does not hold take no place in the sample; the
    bound holds, and an id with several texts or labels has a stated one."""
    from candlewick.llm.terms import labelled_sample
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    docs = table(spark, [(i, f"text {i}") for i in range(0, 200, 4)])
    eligible = {i for i in range(0, 200, 4) if zlib.crc32(str(i).encode()) % 3 != 1}
    got = labelled_sample(docs, labels, "quality", 20).collect()
    assert len(got) == 20 and {r.doc_id for r in got} <= eligible
    assert {r.doc_id for r in labelled_sample(docs, labels, "quality", 500).collect()} == eligible
    one = sorted(eligible)[0]
    many = table(spark, [(one, t) for t in ("b", "a", None, "é", "a", "B")] + [(None, "x")])
    both = labels.unionByName(spark.createDataFrame([(one, 1), (one, 7), (None, 1)], labels.schema))
    got = labelled_sample(many.repartition(4), both, "quality", 5).collect()
    assert [(r.doc_id, r.text, r.label) for r in got] == [(one, "B", 1)]
