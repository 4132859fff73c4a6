"""Event-time open/close candles per symbol (tumbling windows)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.config import CANDLE_WINDOW


def percent_change(open_col: Column, close_col: Column) -> Column:
    """(close - open) / open as a fraction; NULL when open is 0 or NULL."""
    return F.try_divide(close_col - open_col, open_col)


#: Offsets below this stand under their time in a packed order key.
MAX_OFFSET = Decimal(10) ** 19


def tick_order(time_us: str = "binance_timestamp", offset: str = "offset") -> Column:
    """(time, offset) as one number of fixed width, in the order of the pair: equal
    times are told apart by the record's place in its topic partition. A decimal keeps
    a fixed-width aggregation buffer, so candles stay a hash aggregate."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return ((wide(time_us) * F.lit(MAX_OFFSET)).cast("decimal(38,0)") + wide(offset)).cast("decimal(38,0)")


def candles(ticks: DataFrame, window: str = CANDLE_WINDOW, *, time_col: str = "event_time",
            order_col: str = "binance_timestamp", price_col: str = "price",
            keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Open = price at the smallest ``order_col``, close = price at the largest,
    per key and epoch-aligned ``[start, end)`` window of ``time_col``.

    ``order_col`` must be a number (long, or ``tick_order``) so both aggregates keep a
    fixed-width buffer: Spark plans partial + final HashAggregate and a hot symbol is
    collapsed map-side before the shuffle on (symbol, window). Works on a
    watermarked stream unchanged. Rows with a NULL time never reach a window.
    """
    w = F.window(F.col(time_col), window)
    agg = ticks.groupBy(*keys, w.alias("window")).agg(
        F.min_by(price_col, order_col).alias("open_price"),
        F.max_by(price_col, order_col).alias("close_price"),
    )
    return agg.select(
        *keys,
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "open_price",
        "close_price",
        percent_change(F.col("open_price"), F.col("close_price")).alias("percent_change"),
    )
