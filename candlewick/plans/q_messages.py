"""Feed and consumer message handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.functions import normalize as N
from candlewick.operators.counts import counts_by, error_counts
from candlewick.plans import sql as S
from candlewick.plans.common import finish, register, ticks
from candlewick.plans.planted import consumer_records, trade_envelopes
from candlewick.sources.ticks import price_records

# Expected classification, stated on event_id alone (independent of any JSON).
ENV_CTE = """WITH e AS (
  SELECT event_id, value AS price, epoch_us(ts) AS bts,
    CASE WHEN event_id % 97 = 0 THEN 'json_decode'
         WHEN event_id % 89 = 0 THEN 'processing'
         WHEN event_id % 83 = 0 THEN 'processing'
         WHEN event_id % 79 = 0 THEN 'ignored'
         WHEN value IS NULL OR ts IS NULL THEN 'processing'
    END AS error_type,
    CASE WHEN event_id % 73 = 0 OR event_type IS NULL THEN 'unknown' ELSE lower(event_type) END AS symbol
  FROM events)"""

MSG_CTE = f"""WITH t AS ({S.TICKS}), m AS (
  SELECT offs, symbol, price, bts, sts,
    CASE WHEN event_id % 61 = 0 THEN 0 ELSE rts END AS rts,
    CASE WHEN event_id % 71 = 0 OR symbol IS NULL OR symbol = '' THEN 'invalid_message'
         WHEN event_id % 67 = 0 OR bts IS NULL THEN 'missing_timestamp'
    END AS error_type
  FROM t)"""


def envelopes(spark, sf_dir):
    return N.classify_envelopes(trade_envelopes(ticks(spark, sf_dir)))


def consumed(spark, sf_dir):
    return N.classify_price_records(consumer_records(ticks(spark, sf_dir)))


@register("normalized_ticks", ENV_CTE + f"""
  SELECT event_id, symbol, price, bts AS binance_timestamp
  FROM e WHERE error_type IS NULL""")
def normalized_ticks(spark, sf_dir):
    good = N.good(envelopes(spark, sf_dir))
    return finish(good.select("event_id", "symbol", "price", "binance_timestamp"))


@register("rejects", ENV_CTE + """
  SELECT event_id, error_type FROM e WHERE error_type IS NOT NULL AND error_type <> 'ignored'""")
def rejects(spark, sf_dir):
    return N.rejects(envelopes(spark, sf_dir)).select("event_id", "error_type")


@register("reject_counts", ENV_CTE + """
  SELECT error_type, count(*) AS errors FROM e
  WHERE error_type IS NOT NULL AND error_type <> 'ignored' GROUP BY 1""")
def reject_counts(spark, sf_dir):
    return error_counts(N.rejects(envelopes(spark, sf_dir)))


@register("message_counts", ENV_CTE + """
  SELECT symbol, count(*) AS received FROM e WHERE error_type IS NULL GROUP BY 1""")
def message_counts(spark, sf_dir):
    return counts_by(N.good(envelopes(spark, sf_dir)), "symbol", "received")


@register("consumer_valid", MSG_CTE + f"""
  SELECT offs AS "offset", symbol, price, bts AS binance_timestamp,
         rts AS received_timestamp
  FROM m WHERE error_type IS NULL""")
def consumer_valid(spark, sf_dir):
    ok = N.good(consumed(spark, sf_dir))
    return finish(ok.select("offset", "symbol", "price", "binance_timestamp", "received_timestamp"))


@register("consumer_rejects", MSG_CTE + """
  SELECT offs AS "offset", error_type FROM m WHERE error_type IS NOT NULL""")
def consumer_rejects(spark, sf_dir):
    return N.rejects(consumed(spark, sf_dir)).select("offset", "error_type")


@register("consumer_counts", MSG_CTE + """
  SELECT symbol, count(*) AS processed FROM m WHERE error_type IS NULL GROUP BY 1""")
def consumer_counts(spark, sf_dir):
    return counts_by(N.good(consumed(spark, sf_dir)), "symbol", "processed")


@register("decoded_ticks", f"WITH t AS ({S.TICKS})" + f"""
  SELECT symbol, price, bts AS binance_timestamp, rts AS received_timestamp,
         make_timestamp(bts) AS event_time, part AS "partition", offs AS "offset"
  FROM t""")
def decoded_ticks(spark, sf_dir):
    dec = N.decode_price_records(price_records(ticks(spark, sf_dir)))
    return finish(dec.select("symbol", "price", "binance_timestamp", "received_timestamp",
                             F.col("event_time").cast("timestamp_ntz").alias("event_time"),
                             "partition", "offset"))
