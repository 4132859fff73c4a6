"""Message parsing and validation (no UDFs: one JSON parse chain + a `when` chain).

Error classes, as the modelled services count them:
  json_decode        the raw feed message is not JSON
  processing         a trade lacks a usable price or a 16-digit µs time
  invalid_message    a consumed record has no key or a non-object value
  missing_timestamp  a consumed price has no (or a zero) trade time
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.config import UNKNOWN_SYMBOL
from candlewick.functions.present import valid_micros
from candlewick.schemas import ALERT_SCHEMA, PRICE_SCHEMA

_MAP = "map<string,string>"


def _fence(*fields: Column) -> Column:
    """Emit derived fields through a one-row generator.

    A filter on generator output is never pushed below the generator, so
    later filters on these fields (good / rejects) cannot inline - and so
    re-evaluate - the JSON parsing they are derived from."""
    return F.inline(F.array(F.struct(*fields)))


def with_envelope_maps(df: DataFrame, value: Column, prefix: str = "_env") -> DataFrame:
    """Parse envelope text once into two map columns (``<prefix>_top``,
    ``<prefix>_data``). Each parse is its own projection, so Catalyst keeps it
    materialised instead of re-parsing it for every field that reads it."""
    df = df.withColumn(f"{prefix}_top", F.from_json(value, _MAP))
    return df.withColumn(f"{prefix}_data", F.from_json(F.col(f"{prefix}_top")["data"], _MAP))


def envelope_fields(top: Column, data: Column):
    """(error, symbol, price, trade_time) from parsed envelope maps.

    error: NULL (good), 'json_decode', 'processing', or 'ignored' for a
    message without a ``data`` key."""
    has_s = F.map_contains_key(data, "s")
    trade_time = data["T"].try_cast("bigint")
    price = data["p"].try_cast("double")
    error = (F.when(top.isNull(), F.lit("json_decode"))
             .when(~F.map_contains_key(top, "data"), F.lit("ignored"))
             .when(data.isNull(), F.lit("processing"))
             .when(has_s & data["s"].isNull(), F.lit("processing"))
             .when(price.isNull() | F.isnan(price) | (F.abs(price) == float("inf")), F.lit("processing"))
             .when(trade_time.isNull(), F.lit("processing"))
             .when(~valid_micros(trade_time), F.lit("processing")))
    symbol = F.lower(F.when(has_s, data["s"]).otherwise(F.lit(UNKNOWN_SYMBOL)))
    return error, symbol, price, trade_time


def classify_envelopes(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Parse feed envelopes and attach ``error_type`` (NULL for good rows).

    Messages without a ``data`` key are dropped silently, as the feed
    handler ignores them. Good rows carry symbol (lower-cased, default
    'unknown'), price (double) and binance_timestamp (µs).
    """
    keep = [c for c in raw.columns if c != value_col]
    parsed = with_envelope_maps(raw, F.col(value_col))
    error, symbol, price, trade_time = envelope_fields(F.col("_env_top"), F.col("_env_data"))
    parsed = parsed.select(*keep, _fence(error.alias("error_type"), symbol.alias("_s"), price.alias("_p"),
                                         trade_time.alias("_t")))
    ok = F.col("error_type").isNull()
    return parsed.where(F.coalesce(F.col("error_type"), F.lit("")) != "ignored").select(
        *keep,
        F.when(ok, F.col("_s")).alias("symbol"),
        F.when(ok, F.col("_p")).alias("price"),
        F.when(ok, F.col("_t")).alias("binance_timestamp"),
        "error_type",
    )


def good(df: DataFrame) -> DataFrame:
    return df.where(F.col("error_type").isNull()).drop("error_type")


def rejects(df: DataFrame) -> DataFrame:
    return df.where(F.col("error_type").isNotNull())


def decode_price_records(records: DataFrame) -> DataFrame:
    """Kafka price records -> typed ticks; malformed values give NULL fields.

    ``event_time`` is the trade time as a TimestampType (required by
    watermarks); a NULL time never reaches a window.
    """
    data = F.from_json(F.col("value").cast("string"), PRICE_SCHEMA)
    extras = [c for c in ("partition", "offset") if c in records.columns]
    if "timestamp" in records.columns:
        kafka_ts = [F.col("timestamp").alias("kafka_timestamp")]
    else:
        kafka_ts = []
    return records.select(
        F.col("key").cast("string").alias("symbol"),
        data.alias("_d"), *extras, *kafka_ts,
    ).select(
        "symbol",
        F.col("_d.price").alias("price"),
        F.col("_d.binance_timestamp").alias("binance_timestamp"),
        F.col("_d.received_timestamp").alias("received_timestamp"),
        F.timestamp_micros(F.col("_d.binance_timestamp")).alias("event_time"),
        *extras, *(["kafka_timestamp"] if kafka_ts else []),
    )


def price_record_error(key: Column, obj: Column) -> Column:
    """Prices-consumer validation from the key and the value parsed as a map
    (``from_json(value, 'map<string,string>')``): 'invalid_message' for an
    empty/absent key or a value that is not a JSON object, 'missing_timestamp'
    for an absent or zero binance_timestamp, NULL for a valid record."""
    k = key.cast("string")
    bts = obj["binance_timestamp"].try_cast("bigint")
    return (F.when((F.coalesce(k, F.lit("")) == "") | obj.isNull(), F.lit("invalid_message"))
            .when(F.coalesce(bts, F.lit(0)) == 0, F.lit("missing_timestamp")))


def with_value_map(df: DataFrame, value: Column, name: str = "_obj") -> DataFrame:
    """Parse a JSON value once into a map column (kept as its own projection)."""
    return df.withColumn(name, F.from_json(value.cast("string"), _MAP))


def classify_price_records(records: DataFrame) -> DataFrame:
    """Prices-consumer validation of Kafka records; adds ``error_type``."""
    keep = [c for c in records.columns if c not in ("key", "value")]
    parsed = with_value_map(records, F.col("value"))
    obj = F.col("_obj")
    return parsed.select(*keep, _fence(
        F.col("key").cast("string").alias("symbol"),
        obj["price"].try_cast("double").alias("price"),
        obj["binance_timestamp"].try_cast("bigint").alias("binance_timestamp"),
        obj["received_timestamp"].try_cast("bigint").alias("received_timestamp"),
        price_record_error(F.col("key"), obj).alias("error_type"),
    ))


def classify_alert_records(records: DataFrame) -> DataFrame:
    """Alerts-consumer validation: key non-empty and value a JSON object."""
    keep = [c for c in records.columns if c not in ("key", "value")]
    parsed = with_value_map(records, F.col("value"))
    key = F.col("key").cast("string")
    error = F.when((F.coalesce(key, F.lit("")) == "") | F.col("_obj").isNull(), F.lit("invalid_message"))
    alert = F.from_json(F.col("value").cast("string"), ALERT_SCHEMA)
    return parsed.select(*keep, _fence(key.alias("key"), alert.alias("alert"), error.alias("error_type")))

