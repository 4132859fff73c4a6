from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import graph, simhash
from candlewick.sources.tables import load
from tests.conftest import SF001
from tests.llm.common import AWKWARD, NON_SPACE, low, smallest_reachable, table, with_extras


def brute_fp(text):
    w = [x.encode() for x in NON_SPACE.findall(low(text))]
    sh = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def expected(rows, bits=4):
    fps = [brute_fp(t) for _, t in rows]
    comp = smallest_reachable([i for i, _ in rows], lambda a, b: (fps[a] ^ fps[b]).bit_count() <= bits)
    return Counter((i, f, c) for (i, _), f, c in zip(rows, fps, comp))


def got(df):
    return Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in df.collect())


def test_whole_table_against_brute_force(spark):
    docs = load(spark, SF001, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


def test_awkward_rows_and_grid_cells(spark):
    near = "one two three four five six seven eight nine ten eleven twelve " * 3
    rows = list(enumerate(AWKWARD)) + [(50 + i, near + f"tail{i}") for i in range(6)]
    rows += [(None, near), (None, None), (3, "a"), (3, "a")]
    docs = with_extras(table(spark, rows))
    assert got(simhash.near_duplicates(docs)) == expected(rows)
    assert got(simhash.near_duplicates(docs, cell_rows=2)) == expected(rows)


def test_keep_one(spark):
    rows = [(5, "p q r s t"), (2, "p q r s t"), (2, "p q r s t"), (None, "p q r s t"),
            (None, "lone words without any id at all"), (None, "lone words without any id at all"), (9, None)]
    docs = with_extras(table(spark, rows))
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter([2, None, 9])


def test_keep_one_with_shared_ids(spark):
    a, b = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 6,
            "one two three four five six seven eight nine ten eleven twelve " * 6)
    b2 = b + "tail"
    assert 0 < (brute_fp(b) ^ brute_fp(b2)).bit_count() <= 4 < (brute_fp(a) ^ brute_fp(b)).bit_count()
    rows = [(5, a), (5, b), (3, b2)] + [(7, f"text {i} of its own kind {i * i}") for i in range(40)]
    rows += [(7, rows[9][1]), (7, None), (7, None)]
    near = "red orange yellow green blue indigo violet black white grey " * 6
    rows += [(None, near + "tail"), (None, near), (None, near), (8, "lone " * 9), (8, "lone " * 9 + " ")]
    docs = with_extras(table(spark, rows)).repartition(4)
    best = {}
    fps = [brute_fp(t) for _, t in rows]
    comp = smallest_reachable(list(range(len(rows))), lambda x, y: (fps[x] ^ fps[y]).bit_count() <= 4)
    for c, (i, t) in zip(comp, rows):
        k = (i is None, i or 0, t is None, t or "")
        best[c] = min(best.get(c, (k, i, t)), (k, i, t), key=lambda x: x[0])
    out = simhash.keep_one(docs)
    assert out.dtypes == docs.dtypes
    got_rows = Counter((r.doc_id, r.text) for r in out.collect())
    assert got_rows == Counter((i, t) for _, i, t in best.values())
    assert got_rows[5, a] == 1 and got_rows[5, b] == 0 and got_rows[3, b2] == 1


def test_empty_table(spark):
    assert simhash.near_duplicates(table(spark, [])).count() == 0


def test_golay_anchors_cover_and_meet():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 300, dtype=np.int64).view(np.uint64)
    y = x.copy()
    for k in range(4):
        y ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    for a, b in zip(x[:100], y[:100]):
        ca, _, ha = simhash.anchor_rows(np.array([a]))
        cb, _, _ = simhash.anchor_rows(np.array([b]))
        assert ha.sum() == 3 and len(ca) <= 18
        assert set(ca[ha].tolist()) & set(cb.tolist())


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(40)] + [(7, 7), (500, 400)]
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    out = {r.node: r.root for r in graph.components(df).collect()}
    assert out == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 500: 400, 400: 400}
    assert graph.components(df.where(F.lit(False))).count() == 0


def test_keep_one_keeps_columns_of_any_name(spark):
    rows = [(1, "alpha beta gamma " * 5), (2, "alpha beta gamma " * 5), (3, None)]
    docs = table(spark, rows)
    for name in ("__digest", "digest", "root", "n", "row", "row_id", "a b", "texts"):
        docs = docs.withColumn(name, F.lit(name))
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]
    assert {r["__digest"] for r in out.collect()} == {"__digest"}
