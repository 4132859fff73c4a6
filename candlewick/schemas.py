"""Explicit schemas of the messages the engine reads and writes."""

from pyspark.sql import types as T

# Price message value (JSON), keyed by lower-case symbol.
PRICE_SCHEMA = T.StructType([
    T.StructField("price", T.DoubleType(), True),
    T.StructField("binance_timestamp", T.LongType(), True),
    T.StructField("received_timestamp", T.LongType(), True),
])

# Raw trade envelope from the exchange feed.
TRADE_SCHEMA = T.StructType([
    T.StructField("s", T.StringType(), True),
    T.StructField("p", T.StringType(), True),
    T.StructField("T", T.LongType(), True),
])
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("stream", T.StringType(), True),
    T.StructField("data", TRADE_SCHEMA, True),
])

# Alert message value (JSON), keyed by symbol.
ALERT_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("window_start", T.TimestampType(), True),
    T.StructField("window_end", T.TimestampType(), True),
    T.StructField("open_price", T.DoubleType(), True),
    T.StructField("close_price", T.DoubleType(), True),
    T.StructField("percent_change", T.DoubleType(), True),
    T.StructField("alert_type", T.StringType(), True),
    T.StructField("alert_timestamp", T.TimestampType(), True),
])

# Records as a Kafka source delivers them.
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Long-form metric sample: one value per (metric, labels, le, ts).
SAMPLE_SCHEMA = T.StructType([
    T.StructField("metric", T.StringType(), False),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("le", T.DoubleType(), True),
    T.StructField("ts", T.LongType(), False),          # epoch seconds
    T.StructField("value", T.DoubleType(), True),
])

# Metric catalogue file: component -> metric -> {query, description, unit}.
CATALOG_FILE_SCHEMA = T.MapType(
    T.StringType(),
    T.MapType(T.StringType(), T.StructType([
        T.StructField("query", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("unit", T.StringType(), True),
    ])),
)

# Exchange symbol metadata.
SYMBOLS_FILE_SCHEMA = T.StructType([
    T.StructField("symbols", T.ArrayType(T.StructType([
        T.StructField("symbol", T.StringType(), True),
        T.StructField("isSpotTradingAllowed", T.BooleanType(), True),
    ])), True),
])
