"""Quantiles over any time range from stored sketches.

A sketch of fixed size per (series, scrape interval) is stored once; the quantiles of
any range of whole intervals are read off the merged sketches of its intervals, without
going back to the rows. KLL sketches are mergeable: the rank error of a merged sketch
is that of one built over all rows (about 1.33 % at k = 200, and falling with k).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SKETCH_K = 400
#: Rank error that a sketch of SKETCH_K stays within (99 % of the time; twice its bound).
RANK_ERROR = 0.015


def interval_sketches(df: DataFrame, value: str, time_us: Column, step_s: int, keys=("symbol",),
                      k: int = SKETCH_K) -> DataFrame:
    """(keys, interval, n, sketch): interval i holds times in [i * step, (i + 1) * step).
    NULL values are left out; a partial sketch per task is merged after the shuffle, so
    a hot series sends one sketch per task and interval."""
    i = F.floor(time_us / F.lit(step_s * 1_000_000)).cast("long")
    return (df.where(F.col(value).isNotNull()).groupBy(*keys, i.alias("interval"))
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value), k).alias("sketch")))


def range_quantiles(sketches: DataFrame, first: int, last: int, qs=(0.5, 0.95, 0.99), keys=("symbol",)) -> DataFrame:
    """(keys, n, p50, ...) over the intervals first..last of stored sketches; the range
    is a filter that reaches the scan."""
    inside = sketches.where(F.col("interval").between(first, last))
    merged = inside.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*keys, "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(f"p{int(round(q * 100))}") for q in qs])


def rank_error(df: DataFrame, value: str, estimates: DataFrame, qs=(0.5, 0.95, 0.99), keys=("symbol",)) -> DataFrame:
    """(keys, q, n, error): how far each estimate's rank among the rows is from q (0
    where the rows equal to it span q)."""
    keys = list(keys)
    each = estimates.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(float(q)).alias("q"), F.col(f"p{int(round(q * 100))}").alias("_at")) for q in qs])))
    x = F.col(value)
    g = df.where(x.isNotNull()).join(each, keys).groupBy(*keys, "q").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(x < F.col("_at")).alias("_lt"), F.count_if(x <= F.col("_at")).alias("_le"))
    gap = F.greatest(F.col("_lt") / F.col("n") - F.col("q"), F.col("q") - F.col("_le") / F.col("n"), F.lit(0.0))
    return g.select(*keys, "q", "n", gap.alias("error"))
