"""Sliding ranges over raw ticks, live or in batch: (t - range, t] every ``step``.

Ticks are first added up in panes of ``step`` (one row per key and pane, map-side
combined), and only panes are copied into the range / step windows that cover them.
Both levels are event-time windows, so the same plan runs on a watermarked stream in
append mode: a point is released once the watermark has passed it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sliding_totals(ticks: DataFrame, range_s: int, step_s: int, *, keys: tuple[str, ...] = ("symbol",),
                   time_col: str = "event_time", sums: tuple[str, ...] = (), watermark: str | None = None) -> DataFrame:
    """Per key and point t = j * step with at least one tick in (t - range, t]: keys, t
    (timestamp), n and the sum of each column of ``sums``.

    Event-time windows are closed on the left and open on the right; a microsecond
    taken off every time turns them round. ``range_s`` must be a multiple of
    ``step_s``. ``watermark`` is the delay of a streaming frame."""
    if range_s % step_s:
        raise ValueError("the range must be a multiple of the step")
    seen = ticks.withColumn("_at", F.col(time_col) - F.expr("INTERVAL '0.000001' SECOND"))
    if ticks.isStreaming:
        seen = seen.withWatermark("_at", watermark)
    pane = seen.groupBy(F.window("_at", f"{step_s} seconds").alias("_pane"), *keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums])
    # window_time is the last microsecond of a pane, so a pane falls whole into a range
    wide = pane.groupBy(F.window(F.window_time("_pane"), f"{range_s} seconds", f"{step_s} seconds").alias("_range"),
                        *keys).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums])
    return wide.select(*keys, F.col("_range.end").alias("t"), "n", *sums)


def sliding_rates(ticks: DataFrame, range_s: int, step_s: int, **kw) -> DataFrame:
    """``sliding_totals`` with ``per_second``, the ticks of a range over its length."""
    return sliding_totals(ticks, range_s, step_s, **kw).withColumn("per_second", F.col("n") / F.lit(float(range_s)))
