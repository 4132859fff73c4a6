"""Live metric increments from the price feed (D2 D5 in streaming).

The consumer counts valid messages and observes their latencies as they arrive:
end to end, on the network, in the system, and in its own processing where the
records say when that began. Here that is one windowed aggregation per (scrape
interval, symbol) under the event-time watermark, with fixed-width state: each
closed scrape interval appends its increments (message counter, and per latency
buckets, sum in integer µs, count) in the long form that
``sources.samples.fill_grid`` turns into cumulative samples. The same function
runs on a static frame, which is how the stream is checked against batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.config import (BOUNDS_E2E_LATENCY, BOUNDS_NETWORK_LATENCY, BOUNDS_PRICE_PROCESSING,
                               BOUNDS_SYSTEM_LATENCY, WATERMARK_DELAY)
from candlewick.functions import normalize as N
from candlewick.operators.sliding import sliding_rates

INF = float("inf")
#: Histogram family, the two times (µs) between which it observes, its bounds.
LATENCIES = (
    ("e2e_latency_seconds", "binance_timestamp", "stored_timestamp", BOUNDS_E2E_LATENCY),
    ("network_latency_seconds", "binance_timestamp", "received_timestamp", BOUNDS_NETWORK_LATENCY),
    ("system_latency_seconds", "received_timestamp", "stored_timestamp", BOUNDS_SYSTEM_LATENCY),
    ("processing_latency_seconds", "processing_start", "stored_timestamp", BOUNDS_PRICE_PROCESSING),
)


def tick_increments(records: DataFrame, step_seconds: int, origin: int = 0, latencies=LATENCIES,
                    watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Valid price records -> increments per closed scrape interval.

    Scrape k covers event times in [t_(k-1), t_k), t_k = origin + k*step
    (tumbling windows aligned to ``origin``). A latency is observed where both its
    times are there and not zero; one whose columns the records lack is left out.
    Output columns match ``sources.samples.increments`` (kind 'c')."""
    ok = N.good(N.classify_price_records(records))
    ok = ok.withColumn("event_time", F.timestamp_micros("binance_timestamp"))
    if records.isStreaming:
        ok = ok.withWatermark("event_time", watermark)
    latencies = [x for x in latencies if {x[1], x[2]} <= set(ok.columns)]
    us = [(F.nullif(F.col(b), F.lit(0)) - F.nullif(F.col(a), F.lit(0))).alias(f"_us{j}")
          for j, (_, a, b, _) in enumerate(latencies)]
    ok = ok.select("symbol", "event_time", *us)
    offset = f"{origin % step_seconds} seconds"
    w = F.window("event_time", f"{step_seconds} seconds", startTime=offset)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for j, (_, _, _, bounds) in enumerate(latencies):
        v = F.col(f"_us{j}") / F.lit(1e6)
        aggs += [F.count_if(v <= F.lit(float(b))).alias(f"_b{j}_{i}") for i, b in enumerate(bounds)]
        aggs += [F.coalesce(F.sum(f"_us{j}"), F.lit(0)).alias(f"_sum{j}"), F.count(f"_us{j}").alias(f"_cnt{j}")]
    g = ok.groupBy(w.alias("w"), "symbol").agg(*aggs)
    k = ((F.unix_micros(F.col("w.end")) - F.lit(origin * 1_000_000)) / F.lit(step_seconds * 1_000_000)).cast("long")
    lab = F.create_map(F.lit("symbol"), F.col("symbol")).cast("map<string,string>")
    none_d, none_l = F.lit(None).cast("double"), F.lit(None).cast("long")

    def entry(family, part, le, col, scale=1.0):
        return F.struct(F.lit("c").alias("kind"), F.lit(family).alias("family"), F.lit(part).alias("part"),
                        lab.alias("labels"), F.lit(le).cast("double").alias("le"),
                        F.col(col).cast("long").alias("inc"), F.lit(float(scale)).alias("scale"),
                        none_d.alias("value"), none_l.alias("obs"), F.lit(None).cast("string").alias("mode"))
    entries = [entry("ticks_total", "", None, "_n")]
    for j, (fam, _, _, bounds) in enumerate(latencies):
        entries += [entry(fam, "bucket", float(b), f"_b{j}_{i}") for i, b in enumerate(bounds)]
        entries += [entry(fam, "bucket", INF, f"_cnt{j}"), entry(fam, "sum", None, f"_sum{j}", 1e6),
                    entry(fam, "count", None, f"_cnt{j}")]
    return g.select(k.alias("k"), F.inline(F.array(*entries)))


def live_rates(records: DataFrame, range_s: int, step_s: int, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Valid price records -> (symbol, t, n, per_second) over (t - range, t]: the
    message rate of the dashboard, live."""
    ok = N.good(N.classify_price_records(records)).withColumn("event_time", F.timestamp_micros("binance_timestamp"))
    return sliding_rates(ok.select("symbol", "event_time"), range_s, step_s,
                         watermark=watermark if records.isStreaming else None)


def start_rates_job(records: DataFrame, checkpoint: str, path: str, range_s: int, step_s: int, *,
                    available_now: bool = False, processing_time: str = "0 seconds") -> StreamingQuery:
    """Append the rate at every evaluation point that the watermark has closed."""
    w = (live_rates(records, range_s, step_s).writeStream.outputMode("append")
         .option("checkpointLocation", checkpoint).format("parquet"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start(path)


def start_metrics_job(records: DataFrame, checkpoint: str, path: str, step_seconds: int, *,
                      origin: int = 0, available_now: bool = False,
                      processing_time: str = "0 seconds") -> StreamingQuery:
    """Append closed scrape intervals' increments to a family-partitioned table."""
    inc = tick_increments(records, step_seconds, origin)
    w = (inc.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
         .partitionBy("family").format("parquet"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start(path)
