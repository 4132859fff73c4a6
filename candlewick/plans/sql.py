"""Reusable DuckDB fragments for the oracle statements.

They restate the fixture rules of FIXTURES.md directly on the driver
tables, independently of the Spark code paths.
"""

TICKS = """
  SELECT event_id, event_type AS symbol, value AS price, epoch_us(ts) AS bts,
         epoch_us(ts) + 1000 + (event_id * 7919) % 400000 AS rts,
         epoch_us(ts) + 1000 + (event_id * 7919) % 400000 + 500 + (event_id * 104729) % 60000 AS sts,
         ts AS event_time, CAST(length(event_type) % 3 AS INTEGER) AS part, event_id AS offs
  FROM events
"""


def r6(expr: str) -> str:
    x = f"(({expr})::DOUBLE)"
    return f"(CASE WHEN NOT isnan({x}) THEN round_even({x} * 1e6 - 0.08578644, 0) / 1e6 END)"


def candles_sql(width_us: int, source: str = "t", order: str = "bts", time_us: str = "bts") -> str:
    """Open/close per (symbol, epoch-aligned window) over CTE ``source``."""
    return f"""
  SELECT symbol,
         make_timestamp(({time_us} // {width_us}) * {width_us}) AS window_start,
         make_timestamp(({time_us} // {width_us}) * {width_us} + {width_us}) AS window_end,
         arg_min(price, {order}) AS open_price,
         arg_max(price, {order}) AS close_price
  FROM {source} WHERE {time_us} IS NOT NULL
  GROUP BY 1, 2, 3
"""


def with_change(candles: str) -> str:
    return f"""
  SELECT symbol, window_start, window_end, open_price, close_price,
         CASE WHEN open_price = 0 THEN NULL ELSE (close_price - open_price) / open_price END AS percent_change
  FROM ({candles})
"""


def alerts_sql(candles: str, threshold: float) -> str:
    return f"""
  SELECT symbol, window_start, window_end, open_price, close_price, percent_change,
         CASE WHEN percent_change > 0 THEN 'SELL' ELSE 'BUY' END AS alert_type
  FROM ({with_change(candles)}) WHERE abs(percent_change) > {threshold!r}
"""


MINUTE_US = 60 * 1_000_000
HOUR_US = 3600 * 1_000_000
DAY_US = 86400 * 1_000_000
