"""Presentation helpers for price and alert cards.

All formatting is expressed with built-in functions and integer arithmetic
so that it is deterministic and stays inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.config import ERROR_STATUS_STEPS


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def plain_number(x) -> Column:
    """Shortest decimal text of a double with grouped thousands: ``12.31``,
    ``95,000.0``; from 1e16 up and below 1e-4 in exponent form (``1e+30``,
    ``1.23e-11``)."""
    x = _c(x)
    size = F.abs(x)
    # 17 significant digits of a value in [1e-4, 1e16) need 16 + 21 places
    dec = F.regexp_replace(F.when(size < 1e16, size).try_cast("decimal(38,21)").cast("string"), "0+$", "")
    frac = F.substring_index(dec, ".", -1)
    grouped = F.format_number(F.substring_index(dec, ".", 1).cast("decimal(38,0)"), 0)
    plain = F.concat(grouped, F.lit("."), F.when(frac == "", F.lit("0")).otherwise(frac))
    text = size.cast("string")
    power = F.substring_index(text, "E", -1).try_cast("int")
    exponent = F.concat(
        F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", ""), F.lit("e"),
        F.when(power < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
    body = (F.when(F.isnan(x), F.lit("nan")).when(size == float("inf"), F.lit("inf"))
            .when((size >= 1e16) | ((size < 1e-4) & (size > 0)), exponent).otherwise(plain))
    return F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), body)


def money(x) -> Column:
    """``$`` followed by the grouped number; NULL stays NULL."""
    return F.concat(F.lit("$"), plain_number(x))


def signed_fixed2(x) -> Column:
    """Signed text with two decimals (``+1.25``, ``-0.40``): the exact binary value
    rounded to the nearest cent, exact ties to even."""
    x = _c(x)
    units = F.floor(F.abs(x))
    part = F.abs(x) - units.cast("double")               # exact
    cents = part * F.lit(100.0)
    # the error of that product, exactly: the halves of ``part`` have few bits
    split = part * F.lit(134217729.0)
    high = split - (split - part)
    error = (high * F.lit(100.0) - cents) + (part - high) * F.lit(100.0)
    near = F.rint(cents)
    tie = F.abs(cents - near) == 0.5
    whole = (F.when(tie & (error > 0), F.ceil(cents).cast("double"))
             .when(tie & (error < 0), F.floor(cents).cast("double")).otherwise(near)).cast("long") \
        + units.cast("decimal(20,0)") * 100
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit("+"))
    text = F.lpad(whole.cast("string"), F.greatest(F.length(whole.cast("string")), F.lit(3)), F.lit("0"))
    return F.concat(sign, F.substring(text, F.lit(1), F.length(text) - 2), F.lit("."),
                    F.substring(text, F.length(text) - 1, F.lit(2)))


def alert_colour(alert_type) -> Column:
    t = _c(alert_type)
    return (F.when(t == "BUY", F.lit("green")).when(t == "SELL", F.lit("red"))
            .otherwise(F.lit("gray")))


def trade_time_text(trade_us) -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` of a µs trade time, always UTC."""
    return F.date_format(F.timestamp_micros(_c(trade_us)), "yyyy-MM-dd HH:mm:ss.SSS")


def status_of(v, steps=ERROR_STATUS_STEPS) -> Column:
    """Threshold colour of a value: the last step whose bound is <= v."""
    v = _c(v)
    expr = None
    for bound, colour in reversed(steps[1:]):
        expr = (F.when(v >= F.lit(bound), F.lit(colour)) if expr is None
                else expr.when(v >= F.lit(bound), F.lit(colour)))
    base = steps[0][1]
    return expr.otherwise(F.lit(base)) if expr is not None else F.lit(base)


def metric_name(component, metric) -> Column:
    """Flattened catalogue name ``component_metric``."""
    return F.concat_ws("_", _c(component), _c(metric))


def present_alerts(alert_df: DataFrame) -> DataFrame:
    """Alert cards: upper-case symbol, signed change in percent with two
    decimals, colour class by type, "$open -> $close"; missing fields read as
    UNKNOWN / 0 as on the dashboard."""
    chg = F.coalesce(F.col("percent_change"), F.lit(0.0)) * F.lit(100.0)
    return alert_df.select(
        F.upper(F.coalesce("symbol", F.lit("unknown"))).alias("symbol"),
        F.coalesce("alert_type", F.lit("UNKNOWN")).alias("alert_type"),
        alert_colour("alert_type").alias("colour"),
        F.concat(signed_fixed2(chg), F.lit("%")).alias("change_text"),
        F.concat(money(F.coalesce("open_price", F.lit(0.0))), F.lit(" -> "),
                 money(F.coalesce("close_price", F.lit(0.0)))).alias("price_text"),
        "window_start", "window_end",
    )


def present_prices(board: DataFrame) -> DataFrame:
    """Price cards from the ordered board: label, "$price" and the last trade
    time to the millisecond (UTC)."""
    return board.select(
        "pos", F.upper("symbol").alias("label"), money("price").alias("price_text"),
        F.concat(F.lit("Last trade time (UTC): "), trade_time_text("binance_timestamp")).alias("caption"))


def valid_micros(trade_time) -> Column:
    """A trade time must be written with exactly 16 digits (epoch µs)."""
    from candlewick.config import MICROS_DIGITS
    return F.length(_c(trade_time).cast("string")) == MICROS_DIGITS
