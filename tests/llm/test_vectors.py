import numpy as np
import pytest

from candlewick.llm import vectors
from tests.llm.common import smallest_reachable


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(25, 8))
    x = [(base[rng.integers(25)] + rng.normal(size=8) * s).tolist() for s in rng.uniform(0, 0.5, 300)]
    x += [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [None] + [1.0] * 7, [float("inf")] + [1.0] * 7]
    x += [x[0]] * 15 + [(np.array(x[1]) * 1e200).tolist(), [1.0, 0.0], [1.0, 0.0]]
    return list(enumerate(x))


def brute(rows, threshold=0.9):
    unit = []
    for _, v in rows:
        ok = bool(v) and all(a is not None and np.isfinite(a) for a in v) and any(v)
        unit.append(np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if ok else None)

    def linked(i, j):
        a, b = unit[i], unit[j]
        return a is not None and b is not None and len(a) == len(b) and a @ b >= threshold

    comp = smallest_reachable([i for i, _ in rows], linked)
    n = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    return {i: (k, c, i == c) for (i, _), k, c in zip(rows, n, comp)}


@pytest.mark.parametrize("params", [{}, {"shard_rows": 48}])
def test_against_brute_force(spark, rows, params):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = vectors.near_duplicates(df, **params)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()} == brute(rows)
    assert vectors.recall(df.where("size(embedding) = 8"), out, every=3) == 1.0


def test_null_and_repeated_ids(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(None, v), (4, v), (4, v), (9, [-1.0, 0.0, 0.0]), (None, None)],
                               "vec_id long, embedding array<double>")
    out = sorted((tuple(r) for r in vectors.near_duplicates(df).collect()), key=str)
    assert out == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (9, 0, 9, True),
                          (None, 0, None, False)], key=str)


def test_pruned_lists_are_short_and_reach_their_neighbours():
    rng = np.random.default_rng(2)
    x = vectors.unit_rows(rng.normal(size=(400, 12)))
    lists = vectors.robust_prune(x, 64, 32, 1.5)
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    assert (lists[:, 0] == sim.argmax(axis=1)).all()
    assert (lists < 400).all() and lists.shape == (400, 32)
    q, v = vectors.search_all(x, np.arange(400), x, lists, 0.6, 16, 0.1)
    true = (sim >= 0.6).sum()
    assert (sim[q, v] >= 0.6).all() and len(q) >= 0.9 * true


def test_links_between_tight_groups(spark):
    rng = np.random.default_rng(4)
    n, dim = 800, 64
    x = rng.normal(size=(n, dim)) * (0.01 / dim) ** 0.5
    x[:, 0] += 0.93 ** 0.5
    x[np.arange(n), 1 + np.arange(n) % 4] += 0.07 ** 0.5
    unit = vectors.unit_rows(x)
    true = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    out = vectors.near_duplicates(df).collect()
    assert min(true) > 700
    assert {r.vec_id: r.n_links for r in out} == dict(enumerate(true.tolist()))
    assert {r.component_id for r in out} == {0}


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert vectors.near_duplicates(df).count() == 0


def fresh_pairs(n, dim, cos, seed):
    """``n`` unit vectors and for each a partner at cosine ``cos``, nothing else near."""
    rng = np.random.default_rng(seed)
    a = vectors.unit_rows(rng.normal(size=(n, dim)))
    o = rng.normal(size=(n, dim))
    o = vectors.unit_rows(o - np.einsum("ij,ij->i", o, a)[:, None] * a)
    return a, cos * a + (1 - cos * cos) ** 0.5 * o


@pytest.mark.parametrize("params", [{"shard_rows": 64}, {"shard_rows": 64, "overlap": 1, "probes": 6}])
def test_pairs_that_straddle_shards(spark, params):
    """Over 200 centres: partners mostly have different nearest centres."""
    a, b = fresh_pairs(2200, 32, 0.905, 1)
    rows = [(2 * i, x.tolist()) for i, x in enumerate(a)] + [(2 * i + 1, x.tolist()) for i, x in enumerate(b)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    out = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(df, **params).collect()}
    found = sum(out[2 * i][1] == out[2 * i + 1][1] for i in range(len(a)))
    assert found >= 0.95 * len(a)
    unit = np.concatenate((a, b))
    true = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    got = [out[2 * i][0] for i in range(len(a))] + [out[2 * i + 1][0] for i in range(len(b))]
    assert (np.array(got) <= true).all() and sum(got) >= 0.95 * true.sum()


def test_hot_cluster_and_its_guests(spark):
    """A cluster far beyond a shard's size, in parts, with outsiders near its edge."""
    rng = np.random.default_rng(7)
    hub = rng.normal(size=16)
    x = np.concatenate((hub + rng.normal(size=(500, 16)) * 0.15, rng.normal(size=(200, 16)),
                        hub + rng.normal(size=(60, 16)) * 0.45))
    unit = vectors.unit_rows(x)
    true = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(5)
    out = vectors.near_duplicates(df, shard_rows=128)
    got = np.array([n for _, n in sorted((r.vec_id, r.n_links) for r in out.collect())])
    assert (got <= true).all() and got.sum() >= 0.97 * true.sum()
    assert vectors.recall(df, out, every=5) >= 0.97


def test_extra_columns_and_no_links(spark):
    from tests.llm.common import with_extras
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    out = vectors.near_duplicates(with_extras(df).withColumnRenamed("score", "digest").withColumnRenamed("fp", "v")
                                  .withColumnRenamed("c0", "node"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert vectors.recall(df, out, every=1) is None
