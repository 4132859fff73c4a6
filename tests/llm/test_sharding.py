import zlib
from collections import Counter

from pyspark.sql import functions as F

from candlewick.llm import sharding
from tests.llm.common import AWKWARD, table, with_extras


def slots(rows):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    return {k: len(v) for k, v in by.items()}


def test_awkward_rows_hot_keys_and_ranges(spark):
    rows = [(None if i % 5 == 0 else i % 7 if i % 3 else 1, AWKWARD[i % len(AWKWARD)]) for i in range(400)]
    out = sharding.assign(with_extras(table(spark, rows).repartition(5)), rank_rows=2).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    slots(out)
    assert len({(r.doc_id, r.shard, r.grown_shard) for r in out}) == len({d for d, _ in rows})


def test_weights_and_growth(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    out = sharding.assign(docs, weights=[1.0, 2.0, 5.0], new_weight=2.0).collect()
    sizes = slots(out)
    for shard, share in ((0, 1 / 8), (1, 2 / 8), (2, 5 / 8)):
        assert abs(sizes[shard] / 20000 - share) < 0.02
    moved = [r for r in out if r.grown_shard != r.shard]
    assert {r.grown_shard for r in moved} == {3} and abs(len(moved) / 20000 - 0.2) < 0.02
    grown = sharding.assign(docs, weights=[1.0, 2.0, 5.0, 2.0]).collect()
    assert {r.doc_id: r.shard for r in grown} == {r.doc_id: r.grown_shard for r in out}


def test_slots_do_not_depend_on_ranges_or_partitions(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    one = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(docs).collect()}
    two = {r.doc_id: (r.shard, r.slot) for r in sharding.assign(docs.repartition(9), rank_rows=5).collect()}
    assert one == two


def test_empty_table(spark):
    assert sharding.assign(table(spark, [])).count() == 0
