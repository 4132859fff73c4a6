"""Byte-bounded retention against a running sum per partition."""

import random

import pytest
from pyspark.sql import functions as F

from candlewick.sources.streams import retain_bytes, since


def brute(rows, limit):
    out = []
    for p in {r[0] for r in rows if r[0] is not None}:
        by = {}
        for q, o, size in rows:
            if q == p and o is not None:
                by.setdefault(o, []).append(size)
        total = 0
        for o in sorted(by, reverse=True):
            total += sum(s or 0 for s in by[o])
            if total > limit:
                break
            out += [(p, o, s) for s in by[o]]
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [0, 1, 50, 3000, 40_000, 10 ** 9])
def test_newest_records_within_the_bound(spark, limit):
    rnd = random.Random(limit)
    rows = [(rnd.choice([0, 1, 2, None]), rnd.randint(0, 2_000_000), rnd.choice([None, 0, 1, 7, 200]))
            for _ in range(1500)]
    rows += [(3, 5, 100), (4, 10 ** 15, 10), (4, 3, 10), (5, 7, limit + 1), (5, 6, 0), (None, None, 1)]
    rows += [(6, 1000 + i, 1) for i in range(200)] + [(6, 1000, 1)] * 3
    df = spark.createDataFrame(rows, "partition int, offset long, size int").repartition(4)
    got = sorted((tuple(r) for r in retain_bytes(df, limit, F.col("size")).collect()), key=str)
    assert got == brute(rows, limit)


def test_no_rows(spark):
    df = spark.createDataFrame([], "partition int, offset long, size int")
    assert retain_bytes(df, 10, F.col("size")).count() == 0


def test_the_time_bound_reaches_the_scan(spark):
    from tests.conftest import SF001
    df = since(spark.read.parquet(f"{SF001}/events.parquet"), 60, "ts")
    df.collect()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,ScalarSubquery" in \
        df._jdf.queryExecution().executedPlan().toString()
