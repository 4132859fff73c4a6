"""Alerts from candles, their serialisation, counts and bounded views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.config import ALERT_THRESHOLD, MAX_ALERTS_SHOWN, MAX_ALERTS_STORED

ALERT_COLUMNS = ("symbol", "window_start", "window_end", "open_price", "close_price",
                 "percent_change", "alert_type")


def alert_type(change: Column) -> Column:
    """Contrarian label: a rise is a SELL signal, anything else a BUY."""
    return F.when(change > 0, F.lit("SELL")).otherwise(F.lit("BUY"))


def alerts(candle_df: DataFrame, threshold: float = ALERT_THRESHOLD, *,
           with_timestamp: bool = False) -> DataFrame:
    """Keep windows whose |change| is strictly above ``threshold``.

    A NULL or NaN change (zero or missing open, no number) never alerts. ``alert_timestamp``
    (generation time, constant per micro-batch) is optional so batch results
    stay deterministic.
    """
    chg = F.col("percent_change")
    out = candle_df.where((F.abs(chg) > F.lit(threshold)) & ~F.isnan(chg)).withColumn("alert_type", alert_type(chg))
    cols = [F.col(c) for c in ALERT_COLUMNS]
    if with_timestamp:
        cols.append(F.current_timestamp().alias("alert_timestamp"))
    return out.select(*cols)


def alert_messages(alert_df: DataFrame) -> DataFrame:
    """Kafka-shaped alert records: key = symbol, value = JSON of the alert fields."""
    fields = [c for c in alert_df.columns if c in ALERT_COLUMNS + ("alert_timestamp",)]
    return alert_df.select(
        F.col("symbol").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in fields])).alias("value"),
    )


def alert_counts(alert_df: DataFrame) -> DataFrame:
    """Alerts stored by (alert_type, symbol)."""
    return alert_df.groupBy("alert_type", "symbol").agg(F.count(F.lit(1)).alias("alerts"))


def buy_sell_counts(alert_df: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Conditional counts of BUY and SELL alerts."""
    t = F.col("alert_type")
    return alert_df.groupBy(*keys).agg(
        F.count_if(t == "BUY").alias("buy_alerts"),
        F.count_if(t == "SELL").alias("sell_alerts"),
        F.count(F.lit(1)).alias("all_alerts"),
    )


def newest_alerts(alert_df: DataFrame, n: int = MAX_ALERTS_SHOWN,
                  order: tuple[str, ...] = ("window_end", "symbol")) -> DataFrame:
    """The ``n`` newest alerts, newest first (TakeOrderedAndProject: a
    per-partition top-n then one bounded merge, never a full sort)."""
    first, *rest = order
    return alert_df.orderBy(F.col(first).desc(), *[F.col(c).asc() for c in rest]).limit(n)


def alert_log(alert_df: DataFrame, n: int = MAX_ALERTS_STORED) -> DataFrame:
    """The bounded alert log: only the ``n`` most recent alerts are kept. A window
    that was delivered twice counts once."""
    return newest_alerts(alert_df.dropDuplicates(["symbol", "window_start"]), n)

