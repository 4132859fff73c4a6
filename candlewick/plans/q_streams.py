"""Streaming replays of the feed, registered as queries.

Each call replays the whole tape through the streaming job from a fresh
folder under the session's checkpoint root and returns the sink's content.
No oracle statement is given for the log/latest replays beyond the batch
one they must equal; the tests compare them with brute force as well.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from candlewick.config import (BOUNDS_E2E_LATENCY, BOUNDS_NETWORK_LATENCY, BOUNDS_PRICE_PROCESSING,
                               BOUNDS_SYSTEM_LATENCY, FIXTURE_RANGE, FIXTURE_STEP, MAX_ALERTS_STORED)
from candlewick.plans import sql as S
from candlewick.plans.common import finish, register, ticks
from candlewick.plans.planted import consumer_records, started_us
from candlewick.plans.q_candles import T_CTE
from candlewick.plans.q_prices import LATEST_SQL
from candlewick.schemas import ALERT_SCHEMA
from candlewick.session import checkpoint_root
from candlewick.sources.streams import read_topic, replay_in_slices
from candlewick.sources.ticks import price_records
from candlewick.streaming.jobs import (decode_alert_records, start_alert_job, start_alert_log_job,
                                       start_distinct_alerts_job, start_latest_price_job)
from candlewick.streaming.sinks import read_latest_version

SLICE_ROWS = 5_000_000


def _slices(df) -> int:
    """Slices of a replay: of bounded size, and enough to carry state across them."""
    return max(4, -(-df.count() // SLICE_ROWS))


_CLOSED = S.alerts_sql(S.candles_sql(S.HOUR_US), 0.0025) + \
    " AND window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 SECOND"


def _state_partitions(spark) -> int:
    """State partitions for a replay: the cluster's default parallelism."""
    return spark.sparkContext.defaultParallelism


def _run_dir(spark, what: str) -> str:
    return f"{checkpoint_root(spark)}/replay-{what}-{uuid.uuid4().hex[:12]}"


def replay_alerts(spark, sf_dir, window="1 hour", late: float = 0.0):
    """Replay the price tape through the alert job, slice by slice in time order;
    between two slices the job stops and starts again from its checkpoint, so open
    windows are carried over. ``late``: deliver that first share of the tape once
    more at the end, behind the watermark. Returns the alerts topic folder."""
    root = _run_dir(spark, "alerts")
    records = price_records(ticks(spark, sf_dir))

    def run():
        src = read_topic(spark, "prices", source="files", path=f"{root}/prices")
        start_alert_job(src, f"{root}/ckpt", sink="files", path=f"{root}/alerts", window=window,
                        available_now=True, state_partitions=_state_partitions(spark)).awaitTermination()

    replay_in_slices(records, f"{root}/prices", run, _slices(records))
    if late:
        upto = records.approxQuantile("offset", [late], 0.001)[0]
        records.where(F.col("offset") <= upto).write.mode("append").parquet(f"{root}/prices")
        run()
    return root


def _alert_columns(a):
    return finish(a.select("symbol", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                           F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                           "open_price", "close_price", "percent_change", "alert_type"))


def _alert_rows(spark, root):
    recs = spark.read.parquet(f"{root}/alerts").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    return decode_alert_records(recs)


@register("streamed_alerts", T_CTE + (_CLOSED))
def streamed_alerts(spark, sf_dir):
    """The replay with a restart after each slice."""
    return _alert_columns(_alert_rows(spark, replay_alerts(spark, sf_dir)))


@register("streamed_alerts_late", T_CTE + (_CLOSED))
def streamed_alerts_late(spark, sf_dir):
    """A third of the tape comes again after the end: it is behind the watermark,
    so no window opens twice and the alerts stay the same (I6)."""
    return _alert_columns(_alert_rows(spark, replay_alerts(spark, sf_dir, late=1 / 3)))


@register("streamed_latest", LATEST_SQL + f"""
  SELECT symbol, price, binance_timestamp, received_timestamp FROM latest""")
def streamed_latest(spark, sf_dir):
    """Several batches, each merged into the table of the one before."""
    root = _run_dir(spark, "latest")
    records = consumer_records(ticks(spark, sf_dir))

    def run():
        src = spark.readStream.schema(records.schema).parquet(f"{root}/prices")
        start_latest_price_job(src, f"{root}/ckpt", f"{root}/latest", available_now=True).awaitTermination()

    replay_in_slices(records, f"{root}/prices", run, _slices(records))
    t = read_latest_version(spark, f"{root}/latest")
    return finish(t.select("symbol", "price", "binance_timestamp", "received_timestamp"))


@register("streamed_two_jobs", LATEST_SQL + f"""
  SELECT 'alerts' AS job, CAST(count(*) AS BIGINT) AS results FROM (WITH t AS ({S.TICKS}) {_CLOSED})
  UNION ALL SELECT 'latest', CAST(count(*) AS BIGINT) FROM latest""")
def streamed_two_jobs(spark, sf_dir):
    """Both branches at once, over feeds of their own with their own checkpoints (I8)."""
    root = _run_dir(spark, "two")
    price_records(ticks(spark, sf_dir)).write.parquet(f"{root}/prices")
    consumed = consumer_records(ticks(spark, sf_dir))
    consumed.write.parquet(f"{root}/consumed")
    one = start_alert_job(read_topic(spark, "prices", source="files", path=f"{root}/prices"), f"{root}/ckpt-a",
                          sink="files", path=f"{root}/alerts", window="1 hour", available_now=True,
                          state_partitions=_state_partitions(spark))
    two = start_latest_price_job(spark.readStream.schema(consumed.schema).parquet(f"{root}/consumed"),
                                 f"{root}/ckpt-l", f"{root}/latest", available_now=True)
    one.awaitTermination()
    two.awaitTermination()
    n = F.count(F.lit(1)).alias("results")
    return _alert_rows(spark, root).agg(n).select(F.lit("alerts").alias("job"), "results").unionByName(
        read_latest_version(spark, f"{root}/latest").agg(n).select(F.lit("latest").alias("job"), "results"))


@register("streamed_alert_log", T_CTE + (
    f"SELECT * FROM ({_CLOSED}) ORDER BY window_end DESC, symbol LIMIT {MAX_ALERTS_STORED}"))
def streamed_alert_log(spark, sf_dir):
    root = replay_alerts(spark, sf_dir)
    # the whole topic is delivered twice: an alert that comes again is stored once
    spark.read.schema("key binary, value binary").parquet(f"{root}/alerts").write.parquet(f"{root}/topic")
    for _ in range(2):
        src = spark.readStream.schema("key binary, value binary").parquet(f"{root}/topic")
        start_alert_log_job(src, f"{root}/log-ckpt", f"{root}/log", MAX_ALERTS_STORED,
                            available_now=True).awaitTermination()
        spark.read.parquet(f"{root}/alerts").select("key", "value").write.mode("append").parquet(f"{root}/topic")
    return _alert_columns(read_latest_version(spark, f"{root}/log"))


@register("streamed_alerts_once", T_CTE + _CLOSED)
def streamed_alerts_once(spark, sf_dir):
    """The alerts topic without its repeats, in the stream (I9): each slice of it is
    delivered twice in one run, and at the end all of it comes once more."""
    root = replay_alerts(spark, sf_dir)
    topic = spark.read.schema("key binary, value binary").parquet(f"{root}/alerts")
    ends = F.from_json(F.col("value").cast("string"), ALERT_SCHEMA)["window_end"]
    topic = topic.withColumn("offset", F.unix_micros(ends))

    def run():
        src = spark.readStream.schema("key binary, value binary").parquet(f"{root}/topic")
        start_distinct_alerts_job(src, f"{root}/once-ckpt", f"{root}/once", delay="1 day", available_now=True,
                                  state_partitions=_state_partitions(spark)).awaitTermination()

    replay_in_slices(topic.unionAll(topic), f"{root}/topic", run, 4)
    topic.write.mode("append").parquet(f"{root}/topic")
    run()
    recs = spark.read.parquet(f"{root}/once").select(F.col("key").cast("binary"), F.col("value").cast("binary"))
    return _alert_columns(decode_alert_records(recs))


# a tape whose trade times are cut to six hours: most are equal, offsets tell them apart
_TIED_US = 6 * S.HOUR_US
_TIED = f"(SELECT symbol, price, (bts // {_TIED_US}) * {_TIED_US} AS bts, offs FROM t)"


@register("streamed_alerts_ties", T_CTE + S.alerts_sql(
    S.candles_sql(S.DAY_US, _TIED, order="CAST(bts AS HUGEINT) * 10000000000000000 + offs"), 0.0025)
    + f" AND window_end <= (SELECT make_timestamp((max(epoch_us(ts)) // {_TIED_US}) * {_TIED_US}) FROM events)"
      " - INTERVAL 1 SECOND")
def streamed_alerts_ties(spark, sf_dir):
    """Equal trade times on a stream are ordered by offset."""
    root = _run_dir(spark, "ties")
    t = ticks(spark, sf_dir)
    cut = (F.floor(F.col("binance_timestamp") / F.lit(_TIED_US)) * F.lit(_TIED_US)).cast("long")
    records = price_records(t.withColumn("binance_timestamp", cut))

    def run():
        src = read_topic(spark, "prices", source="files", path=f"{root}/prices")
        start_alert_job(src, f"{root}/ckpt", sink="files", path=f"{root}/alerts", window="1 day",
                        available_now=True, state_partitions=_state_partitions(spark)).awaitTermination()

    replay_in_slices(records, f"{root}/prices", run, _slices(records))
    return _alert_columns(_alert_rows(spark, root))


@register("streamed_progress", """SELECT CAST(count(*) AS BIGINT) AS input_rows,
  CAST(greatest(4, ceil(count(*) / 5000000.0)) AS BIGINT) AS batches_with_data, CAST(0 AS BIGINT) AS dropped_rows
  FROM events""")
def streamed_progress(spark, sf_dir):
    """Micro-batch progress of a replay as the listener stored it (D16, I7): rows
    read, batches that carried data, and rows dropped by the watermark (none: the
    tape is replayed in time order)."""
    from candlewick.streaming.listener import ProgressListener
    root = _run_dir(spark, "progress")
    records = price_records(ticks(spark, sf_dir))
    listener = ProgressListener(spark, f"{root}/progress", flush_rows=3)
    spark.streams.addListener(listener)

    def run():
        src = read_topic(spark, "prices", source="files", path=f"{root}/prices")
        start_alert_job(src, f"{root}/ckpt", sink="files", path=f"{root}/alerts", window="1 hour",
                        available_now=True, state_partitions=_state_partitions(spark)).awaitTermination()

    replay_in_slices(records, f"{root}/prices", run, _slices(records))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    spark.streams.removeListener(listener)
    listener.flush()
    prog = spark.read.parquet(f"{root}/progress")
    return prog.agg(F.sum("input_rows").cast("long").alias("input_rows"),
                    F.count_if(F.col("input_rows") > 0).cast("long").alias("batches_with_data"),
                    F.sum("dropped_rows").cast("long").alias("dropped_rows"))


_VALID_M = f"""WITH t AS ({S.TICKS}), m AS (
  SELECT symbol, bts, sts FROM t
  WHERE NOT (event_id % 71 = 0 OR symbol IS NULL OR symbol = '') AND NOT (event_id % 67 = 0 OR bts IS NULL))"""


_POINTS = f"(SELECT unnest(range(min(bts) // {S.HOUR_US}, max(bts) // {S.HOUR_US} + 14)) * {S.HOUR_US} AS p FROM m)"


@register("streamed_rates", _VALID_M + f"""
  SELECT symbol, make_timestamp(p) AS t, count(*) AS messages, {S.r6(f'count(*) / {FIXTURE_RANGE}.0')} AS per_second
  FROM {_POINTS} g JOIN m ON bts > p - {FIXTURE_RANGE * 1_000_000} AND bts <= p
  WHERE make_timestamp(p) <= (SELECT make_timestamp(max(bts)) FROM m) - INTERVAL 1 SECOND
  GROUP BY symbol, p""")
def streamed_rates(spark, sf_dir):
    """Live message rates over a sliding range, at every closed point."""
    from candlewick.streaming.metrics import start_rates_job
    root = _run_dir(spark, "rates")
    records = consumer_records(ticks(spark, sf_dir))

    def run():
        src = spark.readStream.schema(records.schema).parquet(f"{root}/prices")
        start_rates_job(src, f"{root}/ckpt", f"{root}/rates", FIXTURE_RANGE, FIXTURE_STEP,
                        available_now=True).awaitTermination()

    replay_in_slices(records, f"{root}/prices", run, _slices(records))
    r = spark.read.parquet(f"{root}/rates")
    return finish(r.select("symbol", F.col("t").cast("timestamp_ntz").alias("t"), F.col("n").alias("messages"),
                           "per_second"), ("per_second",))


@register("streamed_tick_counts", _VALID_M + f"""
  SELECT symbol, make_timestamp((bts // 3600000000 + 1) * 3600000000) AS scrape_end,
         count(*) AS messages, sum(sts - bts) / 1e6 AS e2e_sum_seconds
  FROM m GROUP BY 1, 2
  HAVING make_timestamp((bts // 3600000000 + 1) * 3600000000)
         <= (SELECT make_timestamp(max(bts)) FROM m) - INTERVAL 1 SECOND""")
def streamed_tick_counts(spark, sf_dir):
    """The live metrics job over the consumer tape (a slice per run):
    messages and summed end-to-end latency per symbol and closed scrape hour."""
    from candlewick.streaming.metrics import start_metrics_job
    root = _run_dir(spark, "metrics")
    records = consumer_records(ticks(spark, sf_dir))

    def run():
        src = spark.readStream.schema(records.schema).parquet(f"{root}/prices")
        start_metrics_job(src, f"{root}/ckpt", f"{root}/inc", 3600, available_now=True).awaitTermination()

    replay_in_slices(records, f"{root}/prices", run, _slices(records))
    inc = spark.read.parquet(f"{root}/inc").where(F.col("family").isin("ticks_total", "e2e_latency_seconds"))
    sym = F.col("labels")["symbol"]
    g = inc.groupBy(sym.alias("symbol"), "k").agg(
        F.sum(F.when(F.col("family") == "ticks_total", F.col("inc"))).alias("messages"),
        F.sum(F.when(F.col("part") == "sum", F.col("inc"))).alias("_us"))
    end = F.timestamp_seconds(F.col("k") * F.lit(3600)).cast("timestamp_ntz")
    return finish(g.select("symbol", end.alias("scrape_end"), F.col("messages").cast("long").alias("messages"),
                           (F.col("_us") / F.lit(1e6)).alias("e2e_sum_seconds")))


_LIVE = {"e2e_latency_seconds": ("sts - bts", BOUNDS_E2E_LATENCY),
         "network_latency_seconds": ("rts - bts", BOUNDS_NETWORK_LATENCY),
         "system_latency_seconds": ("sts - rts", BOUNDS_SYSTEM_LATENCY),
         "processing_latency_seconds": ("took", BOUNDS_PRICE_PROCESSING)}
_LIVE_LES = ", ".join(f"('{f}', {b!r})" for f, (_, bounds) in _LIVE.items() for b in bounds)
_LIVE_US = ", ".join(f"('{f}', {us})" for f, (us, _) in _LIVE.items())


@register("streamed_latencies", f"""WITH t AS ({S.TICKS}), m AS (
  SELECT symbol, bts, sts, CASE WHEN event_id % 61 <> 0 THEN rts END AS rts,
         (sts - rts) * (5 + event_id * 11 % 30) // 100 AS took FROM t
  WHERE NOT (event_id % 71 = 0 OR symbol IS NULL OR symbol = '') AND NOT (event_id % 67 = 0 OR bts IS NULL)),
closed AS (SELECT * FROM m WHERE make_timestamp((bts // {S.HOUR_US} + 1) * {S.HOUR_US})
             <= (SELECT make_timestamp(max(bts)) FROM m) - INTERVAL 1 SECOND),
seen AS (SELECT symbol, CAST(make_timestamp(bts // {S.HOUR_US} * {S.HOUR_US}) AS DATE) AS "day", v.family, v.us
         FROM closed, LATERAL (VALUES {_LIVE_US}) v(family, us)),
les AS (SELECT * FROM (VALUES {_LIVE_LES}) l(family, le)
        UNION ALL SELECT DISTINCT family, 'inf'::DOUBLE FROM seen),
totals AS (SELECT symbol, "day", family, coalesce(sum(us), 0) / 1e6 AS sum_seconds FROM seen GROUP BY ALL)
  SELECT s.symbol, s."day", s.family, le, count(us) FILTER (WHERE us / 1e6 <= le) AS observations,
         any_value(sum_seconds) AS sum_seconds
  FROM seen s JOIN les USING (family) JOIN totals USING (symbol, "day", family)
  GROUP BY s.symbol, s."day", s.family, le""")
def streamed_latencies(spark, sf_dir):
    """The live metrics job over the consumer tape: the histograms of all four
    latencies, added up per symbol and day over the closed scrape hours."""
    from candlewick.streaming.metrics import start_metrics_job
    root = _run_dir(spark, "latencies")
    timed = ticks(spark, sf_dir).withColumn("processing_start", started_us())
    records = consumer_records(timed, "processing_start")

    def run():
        src = spark.readStream.schema(records.schema).parquet(f"{root}/prices")
        start_metrics_job(src, f"{root}/ckpt", f"{root}/inc", 3600, available_now=True).awaitTermination()

    replay_in_slices(records, f"{root}/prices", run, _slices(records))
    start = F.timestamp_seconds((F.col("k") - 1) * F.lit(3600)).cast("timestamp_ntz")
    inc = spark.read.parquet(f"{root}/inc").where("family <> 'ticks_total'").select(
        F.col("labels")["symbol"].alias("symbol"), start.cast("date").alias("day"), "family", "part", "le", "inc")
    keys = ["symbol", "day", "family"]
    buckets = inc.where("part = 'bucket'").groupBy(*keys, "le").agg(F.sum("inc").alias("observations"))
    sums = inc.where("part = 'sum'").groupBy(*keys).agg((F.sum("inc") / F.lit(1e6)).alias("sum_seconds"))
    return finish(buckets.join(sums, keys))
