"""Latest price per symbol and the ordered price board."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.functions.symbols import symbol_list
from candlewick.session import BROADCAST_ROW_LIMIT, bounded_broadcast

PRICE_FIELDS = ("price", "binance_timestamp", "received_timestamp")


def latest_price(ticks: DataFrame, by: str = "offset", fields=PRICE_FIELDS,
                 key: str = "symbol") -> DataFrame:
    """Last write wins per symbol.

    ``by="offset"`` follows arrival order (a symbol stays in one partition, so
    its offsets are totally ordered); ``by="binance_timestamp"`` takes the
    latest trade time instead. One scalar ``max_by`` per field keeps a
    fixed-width buffer (partial HashAggregate collapses a hot symbol map-side).
    """
    present = [f for f in fields if f in ticks.columns]
    return ticks.groupBy(key).agg(*[F.max_by(f, by).alias(f) for f in present])


def configured_symbols(spark: SparkSession, pairs: str) -> DataFrame:
    """A configuration string of pairs -> (pos, symbol), first position kept.

    The list comes from configuration: at most ``max_configured(pairs)`` rows."""
    one = spark.range(1).select(F.posexplode(symbol_list(F.lit(pairs))).alias("pos", "symbol"))
    return one.groupBy("symbol").agg(F.min("pos").alias("pos"))


def max_configured(pairs: str) -> int:
    return pairs.count(",") + 1


def current_prices(latest: DataFrame, symbols: DataFrame, max_symbols: int | None = None) -> DataFrame:
    """Configured symbols joined to their latest price, in configuration order;
    symbols without a price are left out. The configured list is broadcast
    when its size bound (``max_symbols``, known from the configuration) is
    within the broadcast limit; the price table is never moved for it."""
    rows = BROADCAST_ROW_LIMIT + 1 if max_symbols is None else max_symbols
    return (latest.join(bounded_broadcast(symbols, rows), "symbol", "inner")
            .select("pos", "symbol", *[c for c in latest.columns if c != "symbol"])
            .orderBy("pos"))
