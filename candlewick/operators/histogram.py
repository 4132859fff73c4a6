"""Histograms and quantiles of row-level values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

INF = float("inf")


def histogram(df: DataFrame, value: str, bounds, keys=("symbol",)) -> DataFrame:
    """Cumulative buckets ``value <= le`` (with +Inf), sum and count per key.

    Counts are computed wide - one conditional count per bound in a single
    partial/final hash aggregation - and unpivoted afterwards, so rows are
    never multiplied by the number of buckets. Output is long:
    (keys..., le, bucket_count, sum, count).
    """
    les = [float(b) for b in bounds] + [INF]
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(les[:-1])]
    aggs += [F.count(v).alias(f"_b{len(les) - 1}"), F.sum(v).alias("sum"),
             F.count(v).alias("count")]
    wide = df.groupBy(*keys).agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(le).alias("le"), F.col(f"_b{i}").alias("bucket_count"))
                      for i, le in enumerate(les)])
    return wide.select(*keys, F.inline(pairs), "sum", "count")


def quantiles(df: DataFrame, value: str, qs=(0.5, 0.95, 0.99), keys=("symbol",),
              accuracy: int = 10_000) -> DataFrame:
    """Per-key quantiles: the smallest value whose cumulative share reaches q.

    Uses Spark's mergeable quantile summary (``percentile_approx``): memory
    per group is bounded by ``accuracy`` whatever the group size, and it is
    exact while a group holds fewer values than the summary keeps.
    """
    arr = F.percentile_approx(value, list(qs), accuracy)
    out = df.groupBy(*keys).agg(arr.alias("_q"))
    return out.select(*keys, *[F.col("_q")[i].alias(f"p{int(round(q * 100))}")
                               for i, q in enumerate(qs)])


def series_summary(df: DataFrame, value: str = "value", time: str = "t", keys=("series",)) -> DataFrame:
    """Legend reducers over each series: mean, median, population stdDev, min, max
    and the last value in time, in one aggregate. NaN points are left out. The exact
    median holds one series' values, at most one per point of the grid."""
    v = F.col(value)
    clean = df.where(v.isNotNull() & ~F.isnan(v))
    return clean.groupBy(*keys).agg(
        F.avg(v).alias("mean"), F.percentile(v, F.lit(0.5)).alias("median"), F.stddev_pop(v).alias("std_dev"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.max_by(v, time).alias("last"))
