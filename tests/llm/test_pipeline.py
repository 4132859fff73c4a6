import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm import decontam, quality, registry, simhash, substrings
from candlewick.sources.tables import load
from tests.conftest import SF001
from tests.llm.common import AWKWARD, table, with_extras
from tests.llm.test_decontam import brute as brute_contamination
from tests.llm.test_packing import brute_bins
from tests.llm.test_simhash import expected as brute_components
from tests.llm.test_substrings import brute as brute_repeats


def test_stages_follow_one_another(spark):
    """Each stage of a run against the brute-force rule on its own input."""
    docs = load(spark, SF001, "documents")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF001).cache()
        assert out.dtypes == docs.dtypes
        kept.append([tuple(r) for r in out.select("doc_id", "text").collect()])
        docs = out
    start = [tuple(r) for r in load(spark, SF001, "documents").select("doc_id", "text").collect()]
    good = quality.classify(load(spark, SF001, "documents"), load(spark, SF001, "labels"))
    assert sorted(i for i, _ in kept[0]) == sorted(r.doc_id for r in good.where("predicted = 1").collect())
    assert sorted(i for i, _ in kept[1]) == sorted({c for _, _, c in brute_components(kept[0])})
    gone = {d: n for d, _, n, _ in brute_repeats(kept[1], 35)}
    before = dict(kept[1])
    assert [i for i, _ in sorted(kept[2])] == [i for i, _ in sorted(kept[1])]
    for i, t in kept[2]:
        assert (t == before[i]) == (gone[i] == 0)
    bench = [tuple(r) for r in load(spark, SF001, "benchmark").select("item_id", "text").collect()]
    clean = [r[0] for r in brute_contamination(kept[2], bench, 13) if not r[-1]]
    assert sorted(i for i, _ in kept[3]) == sorted(clean)
    pieces = corpus_pipeline.run(spark, SF001).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in kept[3]} <= {i for i, _ in start}
    assert len({p.sequence_id for p in pieces}) == brute_bins([p.length for p in pieces], 2048)[0]


def test_stages_take_awkward_and_empty_tables(spark):
    docs = with_extras(table(spark, list(enumerate(AWKWARD)) + [(None, "no id"), (3, "a"), (3, "a")]))
    for rows in (docs, docs.where(F.lit(False))):
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, rows, SF001)
            assert out.dtypes == docs.dtypes
            assert out.count() <= rows.count()
        corpus_pipeline.STAGES[4][1](spark, rows, SF001).count()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = registry.QUERIES[name](spark, SF001)
    rel = con.sql(registry.ORACLES[name])
    order = sorted(df.columns)
    assert sorted(rel.columns) == order
    rows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted([tuple(r[c] for c in order) for r in df.collect()], key=str) == \
        sorted([tuple(r[c] for c in order) for r in rows], key=str)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
    assert decontam and simhash and substrings
