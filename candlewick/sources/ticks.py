"""Tick tapes derived from the driver tables, and their message encodings.

The fixture rules (FIXTURES.md part 2) turn ``events`` rows into trades:
symbol = event_type, price = value, trade time = ts in epoch µs, with a
received and a stored time derived from ``event_id``; a symbol always maps
to one of three topic partitions and the offset is ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.config import TOPIC_PARTITIONS

EPOCH_NTZ = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_micros(ts: Column | str) -> Column:
    """Epoch microseconds of a timestamp_ntz (exact; no time-zone shift)."""
    name = ts if isinstance(ts, str) else None
    if name is None:
        raise TypeError("epoch_micros takes a column name")
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, `{name}`)")


def ticks_from_events(events: DataFrame) -> DataFrame:
    """Fixture T: one trade per event row.

    Columns: event_id, symbol, price, binance_timestamp, received_timestamp,
    stored_timestamp (µs), event_time (timestamp_ntz), partition, offset, user_id.
    """
    bts = epoch_micros("ts")
    eid = F.col("event_id")
    rts = bts + F.lit(1000) + (eid * F.lit(7919)) % F.lit(400000)
    sts = rts + F.lit(500) + (eid * F.lit(104729)) % F.lit(60000)
    return events.select(
        eid.alias("event_id"),
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        bts.alias("binance_timestamp"),
        rts.alias("received_timestamp"),
        sts.alias("stored_timestamp"),
        F.col("ts").alias("event_time"),
        (F.length("event_type") % F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        eid.alias("offset"),
        F.col("user_id"),
    )


def ticks_from_orders(orders: DataFrame) -> DataFrame:
    """Second, day-grained tape: symbol = priority, price = total price.

    Many orders share a day, so the order key packs (day, orderkey) into one
    long that is exact for order keys below 10^12: ties in time are broken by
    the order key without leaving hash aggregation.
    """
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date"))
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_totalprice").alias("price"),
        epoch_micros("o_orderdate").alias("binance_timestamp"),
        F.col("o_orderdate").alias("event_time"),
        (day.cast("long") * F.lit(10 ** 12) + F.col("o_orderkey")).alias("tick_order"),
    )


def price_value() -> Column:
    """The JSON value of a price message."""
    return F.to_json(F.struct("price", "binance_timestamp", "received_timestamp"))


def price_records(ticks: DataFrame, topic: str = "prices", key: Column | None = None,
                  value: Column | None = None) -> DataFrame:
    """Encode ticks as Kafka-shaped price records (key = symbol, value = JSON)."""
    return ticks.select(
        (F.col("symbol") if key is None else key).cast("binary").alias("key"),
        (price_value() if value is None else value).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.timestamp_micros("received_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def envelope(stream: Column, data: dict[str, Column] | None) -> Column:
    """Combined-stream envelope text; ``data`` None leaves the key out."""
    fields = [] if data is None else [F.struct(*[c.alias(k) for k, c in data.items()]).alias("data")]
    return F.to_json(F.struct(stream.alias("stream"), *fields))


def trade_fields() -> dict[str, Column]:
    """s, p and T of a trade."""
    return {"s": F.upper("symbol"), "p": F.col("price").cast("string"), "T": F.col("binance_timestamp")}


def trade_envelope() -> Column:
    """The raw feed message of a tick."""
    return envelope(F.concat("symbol", F.lit("@aggTrade")), trade_fields())
