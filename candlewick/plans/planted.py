"""Faults that the registered queries plant into the test tapes (FIXTURES.md part 2).

The engine derives clean messages and samples; these rules spoil some of them, so
that the queries have something to reject, to bridge and to restart from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.operators.series import Grid
from candlewick.sources import samples as SA
from candlewick.sources.ticks import envelope, epoch_micros, trade_fields

RESET_SYMBOL = "click"
GAP_SYMBOL = "view"
# Alert records of windows that end at such an hour arrive without a key.
BAD_ALERT_HOURS = 53


def consumer_key() -> Column:
    """Fixture M key: the symbol, NULL when event_id % 71 = 0."""
    return F.when(F.col("event_id") % 71 == 0, F.lit(None).cast("string")).otherwise(F.col("symbol"))


def consumer_value() -> Column:
    """Fixture M value: price JSON with binance_timestamp 0 when event_id % 67 = 0
    and received_timestamp 0 when event_id % 61 = 0."""
    eid = F.col("event_id")
    bts = F.when(eid % 67 == 0, F.lit(0).cast("long")).otherwise(F.col("binance_timestamp"))
    rts = F.when(eid % 61 == 0, F.lit(0).cast("long")).otherwise(F.col("received_timestamp"))
    return F.to_json(F.struct(F.col("price"), bts.alias("binance_timestamp"), rts.alias("received_timestamp")))


def consumer_records(ticks: DataFrame, *more: str) -> DataFrame:
    """Fixture M: price records with consumer-side faults. ``stored_timestamp`` is the
    time the consumer finished the write; ``more`` columns of the ticks are added."""
    return ticks.select(
        consumer_key().cast("binary").alias("key"), consumer_value().cast("binary").alias("value"),
        F.lit("prices").alias("topic"), F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"), F.col("stored_timestamp"), *more)


def envelope_json() -> Column:
    """Fixture E: raw feed envelopes with faults (first match wins): %97 bad JSON; %89
    trade time in ms; %83 no price; %79 no ``data`` key; %73 no symbol; else whole."""
    eid = F.col("event_id")
    stream = F.concat("symbol", F.lit("@aggTrade"))
    whole = trade_fields()

    def without(name):
        return {k: c for k, c in whole.items() if k != name}

    return (F.when(eid % 97 == 0, F.lit("{bad"))
            .when(eid % 89 == 0, envelope(stream, whole | {"T": F.floor(whole["T"] / 1000)}))
            .when(eid % 83 == 0, envelope(stream, without("p")))
            .when(eid % 79 == 0, envelope(stream, None))
            .when(eid % 73 == 0, envelope(stream, without("s")))
            .otherwise(envelope(stream, whole)))


def trade_envelopes(ticks: DataFrame) -> DataFrame:
    """Fixture E as rows: event_id, event_time, value (envelope text)."""
    return ticks.select(F.col("event_id"), F.col("event_time"), envelope_json().alias("value"))


def _hour():
    return F.floor(epoch_micros("window_end") / F.lit(3600_000_000))


def _share(percent: Column) -> Column:
    """A percentage of the time between the producer's receipt and the consumer's write, µs."""
    return F.call_function("div", (F.col("stored_timestamp") - F.col("received_timestamp")) * percent, F.lit(100))


def sent_us() -> Column:
    """Fixture T: the producer has sent a message after 10 to 49 % of its way."""
    return F.col("received_timestamp") + _share(F.lit(10) + F.col("event_id") * 7 % 40)


def started_us() -> Column:
    """Fixture T: the consumer works on a message for the last 5 to 34 % of its way."""
    return F.col("stored_timestamp") - _share(F.lit(5) + F.col("event_id") * 11 % 30)


def alert_us() -> Column:
    """Fixture T: an alert takes 40 µs to 60 ms, by the hour of its window's end."""
    return F.lit(40) + _hour() * 7919 % 60000


MESSAGES = SA.Messages(envelope_json, consumer_key, consumer_value, lambda: F.col("event_id") % 40 >= 38,
                       lambda: _hour() % BAD_ALERT_HOURS == 0, sent_us, started_us, alert_us)


def spoiled(exact: DataFrame) -> DataFrame:
    """Fixture S: the counters of ``click`` restart from zero at every scrape divisible
    by 100, and scrapes 1..6 of every 50 are missing for ``view``."""
    who = F.coalesce(F.col("labels")["symbol"], F.col("labels")["name"])
    since = Window.partitionBy("_sk", F.floor(F.col("k") / F.lit(100)))      # the scrapes from a restart on
    base = F.max(F.when(F.col("k") % 100 == 0, F.col("cum"))).over(since)
    x = exact.withColumn("_who", who)
    x = x.withColumn("cum", F.when(F.col("_who") == RESET_SYMBOL, F.col("cum") - F.coalesce(base, F.lit(0)))
                     .otherwise(F.col("cum")))
    return x.where(F.col("_who").isNull() | (F.col("_who") != GAP_SYMBOL) | ~(F.col("k") % 50).between(1, 6))


def source_samples(events: DataFrame, alerts_df: DataFrame | None, grid: Grid | None = None) -> DataFrame:
    """The derived samples of the spoiled tapes."""
    grid = grid or SA.scrape_grid(events)
    return SA.as_samples(spoiled(SA.cumulative(SA.increments(events, alerts_df, grid, MESSAGES), grid)), grid)
