"""Latency and clock arithmetic on µs / ms epoch columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MICROS = 1_000_000.0


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def network_latency(received_us, trade_us) -> Column:
    """Trade time -> producer receive, seconds."""
    return (_c(received_us) - _c(trade_us)) / F.lit(MICROS)


def system_latency(stored_us, received_us) -> Column:
    """Producer receive -> consumer done, seconds; only when a receive time exists."""
    r = _c(received_us)
    return F.when(F.coalesce(r, F.lit(0)) != 0, (_c(stored_us) - r) / F.lit(MICROS))


def e2e_latency(stored_us, trade_us) -> Column:
    """Trade time -> consumer done, seconds (= network + system)."""
    return (_c(stored_us) - _c(trade_us)) / F.lit(MICROS)


def step_latency(end, start) -> Column:
    """Duration of one processing step carried on the row as two timestamps/µs."""
    return (_c(end) - _c(start)) / F.lit(MICROS)


def clock_skew(before_ms, after_ms, server_ms) -> Column:
    """Local minus server clock, seconds; the request is assumed to take half
    the round trip each way. Positive means the local clock is ahead."""
    b, a = _c(before_ms), _c(after_ms)
    return (b + (a - b) / F.lit(2.0) - _c(server_ms)) / F.lit(1000.0)


def round_trip(before_ms, after_ms) -> Column:
    return (_c(after_ms) - _c(before_ms)) / F.lit(1000.0)
