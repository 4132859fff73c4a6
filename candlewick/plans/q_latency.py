"""Latency family, clock probes, lag, throughput and replay horizon
(B20-B25 C8 D5 D11 D13 D15 A16)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from candlewick.config import BOUNDS_E2E_LATENCY
from candlewick.functions import latency as L
from candlewick.operators.counts import consumer_lag, throughput, total_lag
from candlewick.operators.histogram import histogram
from candlewick.plans import sql as S
from candlewick.plans.common import finish, register, ticks
from candlewick.plans.q_messages import MSG_CTE
from candlewick.plans.q_prices import valid_prices
from candlewick.session import checkpoint_root
from candlewick.sources.streams import retain_bytes, since
from candlewick.sources.tables import load
from candlewick.sources.ticks import epoch_micros

LAT_CTE = MSG_CTE + """, lat AS (
  SELECT offs, symbol,
         CASE WHEN rts <> 0 THEN (rts - bts) / 1e6 END AS network_seconds,
         CASE WHEN rts <> 0 THEN (sts - rts) / 1e6 END AS system_seconds,
         (sts - bts) / 1e6 AS e2e_seconds
  FROM m WHERE error_type IS NULL)"""


def latency_table(spark, sf_dir):
    v = valid_prices(spark, sf_dir)
    rts = F.col("received_timestamp")
    return v.select(
        "offset", "symbol",
        F.when(F.coalesce(rts, F.lit(0)) != 0,
               L.network_latency(rts, "binance_timestamp")).alias("network_seconds"),
        L.system_latency("stored_timestamp", rts).alias("system_seconds"),
        L.e2e_latency("stored_timestamp", "binance_timestamp").alias("e2e_seconds"),
    )


@register("latency_rows", LAT_CTE + f"""
  SELECT offs AS "offset", symbol, network_seconds,
         system_seconds, e2e_seconds FROM lat""")
def latency_rows(spark, sf_dir):
    return finish(latency_table(spark, sf_dir))


@register("latency_summary", LAT_CTE + f"""
  SELECT symbol, count(*) AS messages, {S.r6('avg(e2e_seconds)')} AS avg_e2e,
         {S.r6('avg(network_seconds)')} AS avg_network, {S.r6('avg(system_seconds)')} AS avg_system,
         min(e2e_seconds) AS min_e2e, max(e2e_seconds) AS max_e2e
  FROM lat GROUP BY symbol""")
def latency_summary(spark, sf_dir):
    t = latency_table(spark, sf_dir)
    return finish(t.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("messages"), F.avg("e2e_seconds").alias("avg_e2e"),
        F.avg("network_seconds").alias("avg_network"), F.avg("system_seconds").alias("avg_system"),
        F.min("e2e_seconds").alias("min_e2e"), F.max("e2e_seconds").alias("max_e2e")),
        computed=("avg_e2e", "avg_network", "avg_system"))


@register("latency_quantiles", LAT_CTE + f"""
  SELECT symbol, quantile_disc(e2e_seconds, 0.5) AS p50,
         quantile_disc(e2e_seconds, 0.95) AS p95,
         quantile_disc(e2e_seconds, 0.99) AS p99
  FROM lat GROUP BY symbol""")
def latency_quantiles(spark, sf_dir):
    """Exact per-symbol quantiles at any scale (``exact_quantiles``); the
    bounded sketch (``quantiles``) stays available for approximate use."""
    from candlewick.operators.quantiles import exact_quantiles
    return finish(exact_quantiles(latency_table(spark, sf_dir), "e2e_seconds"))


@register("latency_quantiles_bracketed", LAT_CTE + f"""
  SELECT symbol, quantile_disc(e2e_seconds, 0.5) AS p50,
         quantile_disc(e2e_seconds, 0.95) AS p95,
         quantile_disc(e2e_seconds, 0.99) AS p99
  FROM lat GROUP BY symbol""")
def latency_quantiles_bracketed(spark, sf_dir):
    """Exact at any scale: bracketing rounds, then a window over at most
    ``limit`` candidates per (symbol, q). The limit is set low here so that the
    refinement rounds run on the test tables too."""
    from candlewick.operators.quantiles import exact_quantiles
    return finish(exact_quantiles(latency_table(spark, sf_dir), "e2e_seconds", limit=500))


# days 3 to 20 of the tape, in whole hours
_FROM_H, _TO_H = 3 * 24, 20 * 24


@register("sketched_quantiles", MSG_CTE + f"""
  SELECT symbol, CAST(q * 100 AS INTEGER) AS percent, count(*) AS n, true AS within_bound
  FROM m, (SELECT min(epoch_us(ts)) // 3600000000 AS h FROM events), (VALUES (0.5), (0.95), (0.99)) v(q)
  WHERE error_type IS NULL AND sts IS NOT NULL AND bts // 3600000000 BETWEEN h + {_FROM_H} AND h + {_TO_H} GROUP BY symbol, q""")
def sketched_quantiles(spark, sf_dir):
    """Quantiles over a range from stored hourly sketches, held against the rows: the
    rank of each is within the stated error (D11)."""
    from candlewick.operators import sketches as K
    t = valid_prices(spark, sf_dir).select("symbol", "binance_timestamp", L.e2e_latency(
        "stored_timestamp", "binance_timestamp").alias("e2e_seconds"))
    hour = F.floor(F.col("binance_timestamp") / F.lit(3600_000_000))
    path = f"{checkpoint_root(spark)}/sketches-{uuid.uuid4().hex[:12]}"
    K.interval_sketches(t, "e2e_seconds", F.col("binance_timestamp"), 3600).write.parquet(path)
    first = load(spark, sf_dir, "events").agg(F.min(epoch_micros("ts"))).first()[0]
    a, z = (first // 3600_000_000 + h if first is not None else 0 for h in (_FROM_H, _TO_H))
    est = K.range_quantiles(spark.read.parquet(path), a, z)
    err = K.rank_error(t.where(hour.between(a, z)), "e2e_seconds", est)
    return err.select("symbol", F.round(F.col("q") * 100).cast("int").alias("percent"), "n",
                      (F.col("error") <= K.RANK_ERROR).alias("within_bound"))


@register("latency_share", LAT_CTE + f"""
  SELECT symbol, {S.r6('avg(system_seconds) / avg(e2e_seconds)')} AS system_share,
         {S.r6('avg(network_seconds) / avg(e2e_seconds)')} AS network_share
  FROM lat GROUP BY symbol""")
def latency_share(spark, sf_dir):
    t = latency_table(spark, sf_dir)
    g = t.groupBy("symbol").agg(F.avg("system_seconds").alias("s"), F.avg("network_seconds").alias("n"),
                                F.avg("e2e_seconds").alias("e"))
    return finish(g.select("symbol", F.try_divide("s", "e").alias("system_share"),
                           F.try_divide("n", "e").alias("network_share")),
                  computed=("system_share", "network_share"))


_LES = ", ".join(f"({b!r})" for b in BOUNDS_E2E_LATENCY) + ", ('inf'::DOUBLE)"


@register("latency_histogram", LAT_CTE + f"""
  SELECT symbol, b.le, count(e2e_seconds) FILTER (WHERE e2e_seconds <= b.le) AS bucket_count,
         {S.r6('sum(e2e_seconds)')} AS "sum", count(e2e_seconds) AS "count"
  FROM lat, (VALUES {_LES}) b(le) GROUP BY symbol, b.le""")
def latency_histogram(spark, sf_dir):
    return finish(histogram(latency_table(spark, sf_dir), "e2e_seconds", BOUNDS_E2E_LATENCY), computed=("sum",))


@register("clock_skew", f"""WITH c AS (
  SELECT event_id, epoch_us(ts) / 1000.0 AS before_ms,
         epoch_us(ts) / 1000.0 + 5 + event_id % 40 AS after_ms,
         floor(epoch_us(ts) / 1000.0) + (event_id * 31) % 20 AS server_ms
  FROM events)
  SELECT event_id, (before_ms + (after_ms - before_ms) / 2.0 - server_ms) / 1000.0 AS skew_seconds,
         (after_ms - before_ms) / 1000.0 AS round_trip_seconds
  FROM c""")
def clock_skew(spark, sf_dir):
    t = ticks(spark, sf_dir)
    before = F.col("binance_timestamp") / F.lit(1000.0)
    probes = t.select("event_id", before.alias("before_ms"),
                      (before + F.lit(5) + F.col("event_id") % 40).alias("after_ms"),
                      (F.floor(before) + (F.col("event_id") * 31) % 20).alias("server_ms"))
    return finish(probes.select(
        "event_id", L.clock_skew("before_ms", "after_ms", "server_ms").alias("skew_seconds"),
        L.round_trip("before_ms", "after_ms").alias("round_trip_seconds")))


_LAG_SQL = f"""WITH t AS ({S.TICKS})
  SELECT part AS "partition", max(offs) AS end_offset,
         max(offs) FILTER (WHERE event_time < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR) AS committed_offset,
         count(*) FILTER (WHERE NOT (event_time < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)
                          OR event_time IS NULL) AS pending
  FROM t GROUP BY 1"""


def _lag(spark, sf_dir):
    t = ticks(spark, sf_dir)
    cut = t.select(F.max("event_time") - F.expr("INTERVAL 1 HOUR")).scalar()
    return consumer_lag(t, cut)


@register("consumer_lag", f"""SELECT "partition", end_offset, committed_offset, pending,
  end_offset - coalesce(committed_offset, -1) AS lag FROM ({_LAG_SQL})""")
def q_consumer_lag(spark, sf_dir):
    return _lag(spark, sf_dir)


@register("consumer_lag_total", f"""SELECT CAST(sum(end_offset - coalesce(committed_offset, -1)) AS BIGINT) AS lag
  FROM ({_LAG_SQL})""")
def q_consumer_lag_total(spark, sf_dir):
    return total_lag(_lag(spark, sf_dir))


@register("throughput", f"""WITH t AS ({S.TICKS})
  SELECT symbol, count(*) AS messages, (max(bts) - min(bts)) / 1e6 AS span_seconds,
         CASE WHEN max(bts) = min(bts) THEN NULL ELSE count(*) / ((max(bts) - min(bts)) / 1e6) END
           AS msg_per_sec
  FROM t GROUP BY symbol""")
def q_throughput(spark, sf_dir):
    return finish(throughput(ticks(spark, sf_dir)))


# bytes a partition keeps; a record counts its props, its symbol and 24 bytes of numbers
RETAINED = 65_536


@register("replay_bytes", f"""WITH t AS ({S.TICKS}), r AS (
  SELECT t.*, sum(strlen(coalesce(e.props, '')) + strlen(coalesce(symbol, '')) + 24) OVER (
    PARTITION BY part ORDER BY offs DESC) AS upto FROM t JOIN events e USING (event_id))
  SELECT part AS "partition", offs AS "offset", symbol, price FROM r WHERE upto <= {RETAINED}""")
def replay_bytes(spark, sf_dir):
    """What a replay sees of partitions that keep a bounded number of bytes."""
    events = load(spark, sf_dir, "events")
    t = ticks(spark, sf_dir).join(events.select("event_id", "props"), "event_id")
    size = F.octet_length(F.coalesce("props", F.lit(""))) + F.octet_length(F.coalesce("symbol", F.lit(""))) + F.lit(24)
    return finish(retain_bytes(t, RETAINED, size).select("partition", "offset", "symbol", "price"))


for _name, _mins in (("replay_15m", 15), ("replay_1d", 1440)):
    def _q(spark, sf_dir, _mins=_mins):
        t = ticks(spark, sf_dir)
        return finish(since(t, _mins).select("event_id", "symbol", "price", "binance_timestamp"))
    register(_name, f"""WITH t AS ({S.TICKS})
  SELECT event_id, symbol, price, bts AS binance_timestamp FROM t
  WHERE event_time >= (SELECT max(ts) FROM events) - INTERVAL {_mins} MINUTE""")(_q)
