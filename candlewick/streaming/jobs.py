"""The two streaming branches over one price feed.

alert job   : price records -> decode -> watermark (1 s) -> 1-minute open/close
              per symbol -> |change| > threshold -> alert records (append)
latest job  : price records -> consumer validation -> foreachBatch upsert of
              the latest price per symbol
alert log   : alert records -> validation -> foreachBatch append + keep newest n

Both branches are independent queries with their own checkpoints (I8). State
partitions are set by ``state_partitions`` (else the session's shuffle
partitions) at a query's first start and fixed by its checkpoint afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewick.config import ALERT_THRESHOLD, CANDLE_WINDOW, MAX_ALERTS_STORED, WATERMARK_DELAY
from candlewick.functions import normalize as N
from candlewick.operators.alerts import ALERT_COLUMNS, alert_messages, alerts
from candlewick.operators.candles import candles, tick_order
from candlewick.schemas import ALERT_SCHEMA
from candlewick.streaming.sinks import append_trim, upsert_latest


def alert_stream(records: DataFrame, window: str = CANDLE_WINDOW, threshold: float = ALERT_THRESHOLD,
                 watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Alerts from a (streaming or batch) frame of price records.

    Records without a symbol are rejected before grouping. Event time is the
    trade time (TimestampType, as watermarks require); the watermark is the
    global maximum event time minus ``watermark``. Append mode emits a window
    once the watermark passes its end; later rows for it are dropped. Equal trade
    times are ordered by offset where the records carry one.
    """
    ticks = N.decode_price_records(records)
    order = "binance_timestamp"
    if "offset" in ticks.columns:
        ticks, order = ticks.withColumn("tick_order", tick_order()), "tick_order"
    ticks = ticks.where(F.coalesce(F.col("symbol"), F.lit("")) != "")
    if records.isStreaming:
        ticks = ticks.withWatermark("event_time", watermark)
    return alerts(candles(ticks, window, order_col=order), threshold, with_timestamp=True)


def _start(writer, spark, state_partitions: int | None, *args):
    """Start a query with ``state_partitions`` state/shuffle partitions.

    Streaming fixes the number of state partitions at a query's first start
    (it is kept in the checkpoint), so the setting is applied only while the
    query starts and the session's own value is restored afterwards."""
    if not state_partitions:
        return writer.start(*args)
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(int(state_partitions)))
    try:
        return writer.start(*args)
    finally:
        spark.conf.set(key, old)


def _trigger(writer, available_now: bool, processing_time: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)


def start_alert_job(records: DataFrame, checkpoint: str, *, sink: str = "files", path: str | None = None,
                    topic: str = "alerts", bootstrap: str | None = None, window: str = CANDLE_WINDOW,
                    threshold: float = ALERT_THRESHOLD, available_now: bool = False,
                    processing_time: str = "0 seconds", name: str | None = None,
                    state_partitions: int | None = None) -> StreamingQuery:
    """Start the alert query; the sink receives key = symbol, value = alert JSON.
    ``state_partitions`` fixes the state store partitions (the modelled job
    used the topic's partition count)."""
    spark = records.sparkSession
    out = alert_messages(alert_stream(records, window, threshold))
    w = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = _trigger(w, available_now, processing_time)
    if sink == "kafka":
        w = w.format("kafka").option("kafka.bootstrap.servers", bootstrap or "localhost:9092").option("topic", topic)
        return _start(w, spark, state_partitions)
    if sink == "files":
        return _start(w.format("parquet"), spark, state_partitions, path)
    if sink == "memory":
        return _start(w.format("memory"), spark, state_partitions)
    raise ValueError(f"unknown sink {sink!r}")


def start_latest_price_job(records: DataFrame, checkpoint: str, table: str, *, available_now: bool = False,
                           processing_time: str = "0 seconds", name: str | None = None) -> StreamingQuery:
    """Consumer validation, then the latest price per symbol as a versioned table."""
    valid = N.good(N.classify_price_records(records))
    w = valid.writeStream.option("checkpointLocation", checkpoint).foreachBatch(upsert_latest(table))
    if name:
        w = w.queryName(name)
    return _trigger(w, available_now, processing_time).start()


def decode_alert_records(records: DataFrame) -> DataFrame:
    """Alert records -> alert columns (invalid records dropped)."""
    a = N.good(N.classify_alert_records(records))
    return a.select(*[F.col("alert")[c].alias(c) for c in ALERT_SCHEMA.fieldNames()])


def distinct_alerts(alert_df: DataFrame, delay: str) -> DataFrame:
    """Each alert (symbol, window_start) once, however often the topic delivers it.

    On a stream the keys seen are state until the watermark (latest window end minus
    ``delay``) has passed them, so state holds the alerts of about ``delay``, not of all
    time; an alert that comes again after that is behind the watermark and dropped as
    late. A first delivery later than ``delay`` is dropped with them."""
    keys = ["symbol", "window_start"]
    if not alert_df.isStreaming:
        return alert_df.dropDuplicates(keys)
    return alert_df.withWatermark("window_end", delay).dropDuplicatesWithinWatermark(keys)


def start_distinct_alerts_job(records: DataFrame, checkpoint: str, path: str, *, delay: str = "1 hour",
                              available_now: bool = False, processing_time: str = "0 seconds",
                              state_partitions: int | None = None) -> StreamingQuery:
    """The alerts topic without its repeats, as alert records under ``path``."""
    out = alert_messages(distinct_alerts(decode_alert_records(records).select(*ALERT_COLUMNS), delay))
    w = out.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet")
    return _start(_trigger(w, available_now, processing_time), records.sparkSession, state_partitions, path)


def start_alert_log_job(records: DataFrame, checkpoint: str, table: str, n: int = MAX_ALERTS_STORED, *,
                        available_now: bool = False, processing_time: str = "0 seconds",
                        name: str | None = None, distinct_delay: str | None = None) -> StreamingQuery:
    """The bounded alert log fed by the alerts topic. ``distinct_delay`` drops repeats
    in the stream already (``distinct_alerts``); the sink drops them in any case."""
    a = decode_alert_records(records).select(*ALERT_COLUMNS)
    if distinct_delay:
        a = distinct_alerts(a, distinct_delay)
    w = a.writeStream.option("checkpointLocation", checkpoint).foreachBatch(append_trim(table, n))
    if name:
        w = w.queryName(name)
    return _trigger(w, available_now, processing_time).start()


def write_ticks(records: DataFrame, *, sink: str = "files", path: str | None = None, topic: str = "prices",
                bootstrap: str | None = None, checkpoint: str | None = None, available_now: bool = False):
    """Price sink (A4): records keyed by symbol. For Kafka the key picks the
    topic partition; for files the rows are hash-partitioned by key so that a
    symbol's messages stay together, as on the topic. Batch or streaming."""
    if sink == "files":
        records = records.repartition("key")
    if records.isStreaming:
        w = records.writeStream.option("checkpointLocation", checkpoint)
        w = _trigger(w, available_now, "0 seconds")
        if sink == "kafka":
            return (w.format("kafka").option("kafka.bootstrap.servers", bootstrap or "localhost:9092")
                    .option("topic", topic).start())
        return w.format("parquet").start(path)
    if sink == "kafka":
        return (records.select("key", "value").write.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap or "localhost:9092").option("topic", topic).save())
    return records.write.mode("append").parquet(path)


def write_alerts(alert_df: DataFrame, *, sink: str = "files", path: str | None = None, topic: str = "alerts",
                 bootstrap: str | None = None, checkpoint: str | None = None, available_now: bool = False):
    """Alert sink (A5): key = symbol, value = alert JSON; append. Batch or stream."""
    return write_ticks(alert_messages(alert_df), sink=sink, path=path, topic=topic, bootstrap=bootstrap,
                       checkpoint=checkpoint, available_now=available_now)
