"""Counters over message tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def counts_by(df: DataFrame, keys, name: str = "messages") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def error_counts(rejects: DataFrame) -> DataFrame:
    return counts_by(rejects, "error_type", "errors")


def throughput(df: DataFrame, time_us: str = "binance_timestamp", keys=("symbol",)) -> DataFrame:
    """Messages per second: count over the covered span (max - min time)."""
    span = (F.max(time_us) - F.min(time_us)) / F.lit(1_000_000.0)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("messages"),
        span.alias("span_seconds"),
        F.try_divide(F.count(F.lit(1)).cast("double"), span).alias("msg_per_sec"),
    )


def consumer_lag(records: DataFrame, committed_before, time_col: str = "event_time",
                 partition_col: str = "partition", offset_col: str = "offset") -> DataFrame:
    """Per partition, in one aggregation: end offset, committed offset (last
    offset consumed before ``committed_before``), offset lag = end - committed
    (end + 1 when nothing was committed, offsets start at 0) and the number
    of messages not yet consumed."""
    t = F.col(time_col)
    # The cut-off (often a scalar subquery) is compared once per row.
    flagged = records.select(partition_col, offset_col,
                             F.coalesce(t < committed_before, F.lit(False)).alias("_consumed"))
    consumed = F.col("_consumed")
    agg = flagged.groupBy(partition_col).agg(
        F.max(offset_col).alias("end_offset"),
        F.max(F.when(consumed, F.col(offset_col))).alias("committed_offset"),
        F.count_if(~consumed).alias("pending"),
    )
    return agg.withColumn(
        "lag", F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.lit(-1)))


def total_lag(lag_df: DataFrame) -> DataFrame:
    return lag_df.agg(F.sum("lag").alias("lag"))


def coverage(samples: DataFrame, metric: str = "metric", ts: str = "ts") -> DataFrame:
    """Distinct metrics seen and distinct timestamps (one row)."""
    return samples.agg(F.count_distinct(metric).alias("metrics"),
                       F.count_distinct(ts).alias("timestamps"))
