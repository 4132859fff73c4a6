"""Merged interval sketches against exact quantiles."""

import random

from pyspark.sql import functions as F

from candlewick.operators.quantiles import exact_quantiles
from candlewick.operators.sketches import RANK_ERROR, interval_sketches, range_quantiles, rank_error


def test_merged_sketches_stay_within_their_rank_error(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), 10_000_000 * rnd.randint(0, 99), rnd.lognormvariate(0, 2)) for _ in range(30_000)]
    rows += [("c", 0, 1.0), ("c", 5, None), ("d", 0, 2.0)] + [("e", 10_000_000 * i, 7.0) for i in range(100)]
    df = spark.createDataFrame(rows, "symbol string, us long, v double").repartition(6)
    stored = interval_sketches(df, "v", F.col("us"), 10)
    assert stored.where("symbol = 'c'").collect()[0].n == 1
    for first, last in ((0, 99), (20, 40), (7, 7)):
        inside = df.where(F.floor(F.col("us") / 10_000_000).between(first, last))
        est = range_quantiles(stored, first, last)
        for r in rank_error(inside, "v", est).collect():
            assert r.error <= RANK_ERROR, r
        counts = {r.symbol: r.n for r in est.collect()}
        assert counts == {r.symbol: r["count"] for r in inside.where("v is not null").groupBy("symbol").count().collect()}
    exact = exact_quantiles(df.where("symbol = 'e'"), "v").first()
    est = range_quantiles(stored.where("symbol = 'e'"), 0, 99).first()
    assert (est.p50, est.p99) == (exact.p50, exact.p99) == (7.0, 7.0)
    assert range_quantiles(stored, 1000, 2000).count() == 0
