"""Streaming: watermark timing, late rows, restart, two queries on one feed, sinks."""

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from candlewick.sources.streams import read_topic
from candlewick.streaming.jobs import start_alert_job, start_latest_price_job
from candlewick.streaming.listener import ProgressListener, progress_frame, progress_metrics
from candlewick.streaming.sinks import append_trim, read_latest_version, upsert_latest

BASE_US = 1704067200 * 1_000_000


def write_batch(spark, folder, rows, idx):
    """rows: (symbol, seconds, price, offset) -> one Kafka-shaped parquet file."""
    recs = [(s.encode(), json.dumps({"price": p, "binance_timestamp": BASE_US + int(sec * 1e6),
                                     "received_timestamp": BASE_US + int(sec * 1e6) + 1000}).encode(),
             "prices", 0, off, dt.datetime(2024, 1, 1), 0) for s, sec, p, off in rows]
    df = spark.createDataFrame(recs, "key binary, value binary, topic string, partition int, offset long, "
                                     "timestamp timestamp, timestampType int")
    df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/b{idx:03d}")


def alerts_in(spark, path):
    from candlewick.schemas import ALERT_SCHEMA
    try:
        df = spark.read.parquet(path)
    except Exception:  # noqa: BLE001 - no output yet
        return []
    a = df.select(F.from_json(F.col("value").cast("string"), ALERT_SCHEMA).alias("a")).select("a.*")
    return sorted((r.symbol, r.window_start.replace(tzinfo=None), r.open_price, r.close_price)
                  for r in a.collect())


def run(spark, folder, out, ckpt, threshold=0.0):
    src = read_topic(spark, "prices", source="files", path=f"{folder}/*", files_per_trigger=1)
    q = start_alert_job(src, ckpt, sink="files", path=out, threshold=threshold, available_now=True)
    q.awaitTermination()
    return q


def test_late_rows_and_watermark_equality(spark, scratch):
    folder, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    batches = [[("btc", 1.0, 100.0, 1), ("btc", 58.0, 101.0, 2)],
               [("btc", 61.5, 50.0, 3)],
               [("btc", 59.0, 102.0, 4)],     # late but above the previous watermark: kept
               [("btc", 0.5, 1.0, 5)]]        # below the watermark: dropped
    for i, b in enumerate(batches):
        write_batch(spark, folder, b, i)
    q = run(spark, folder, out, ckpt)
    got = alerts_in(spark, out)
    assert got == [("btc", dt.datetime(2024, 1, 1, 0, 0), 100.0, 102.0)]
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p["stateOperators"])
    assert dropped == 1


def test_window_released_when_watermark_equals_end(spark, scratch):
    folder, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    write_batch(spark, folder, [("eth", 10.0, 10.0, 1), ("eth", 20.0, 11.0, 2)], 0)
    write_batch(spark, folder, [("eth", 61.0, 12.0, 3)], 1)   # watermark = 60.0 s = window end
    run(spark, folder, out, ckpt)
    assert alerts_in(spark, out) == [("eth", dt.datetime(2024, 1, 1, 0, 0), 10.0, 11.0)]


def test_restart_keeps_state_and_does_not_repeat(spark, scratch):
    folder, out, ckpt = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    write_batch(spark, folder, [("x", 1.0, 1.0, 1), ("x", 70.0, 2.0, 2)], 0)
    run(spark, folder, out, ckpt)
    first = alerts_in(spark, out)
    assert first == []    # window 0 has one row (no change), window 1 still open
    write_batch(spark, folder, [("x", 100.0, 3.0, 3), ("x", 125.0, 4.0, 4)], 1)
    run(spark, folder, out, ckpt)
    got = alerts_in(spark, out)
    # the window [60, 120) got rows from before and after the restart
    assert got == [("x", dt.datetime(2024, 1, 1, 0, 1), 2.0, 3.0)]
    run(spark, folder, out, ckpt)
    assert alerts_in(spark, out) == got   # nothing repeated


def test_stream_equals_batch_on_closed_windows(spark, scratch):
    import __spark_entry__ as E
    from tests.conftest import SF001
    s = {tuple(r) for r in E.queries()["streamed_alerts"](spark, SF001).collect()}
    b = E.queries()["alerts_1h"](spark, SF001)
    top = spark.read.parquet(f"{SF001}/events.parquet").agg(F.max("ts")).first()[0]
    closed = {tuple(r) for r in b.where(F.col("window_end") <= F.lit(top - dt.timedelta(seconds=1))).collect()}
    assert s == closed


def test_two_queries_one_feed_and_listener(spark, scratch):
    folder = f"{scratch}/in"
    write_batch(spark, folder, [("a", 1.0, 1.0, 1), ("b", 2.0, 5.0, 2), ("a", 3.0, 2.0, 3)], 0)
    write_batch(spark, folder, [("a", 70.0, 3.0, 4)], 1)
    listener = ProgressListener()
    spark.streams.addListener(listener)
    try:
        src = read_topic(spark, "prices", source="files", path=f"{folder}/*", files_per_trigger=1)
        q1 = start_alert_job(src, f"{scratch}/ck1", sink="files", path=f"{scratch}/alerts",
                             threshold=0.0, available_now=True, name=f"alerts_{uuid.uuid4().hex[:6]}")
        q2 = start_latest_price_job(src, f"{scratch}/ck2", f"{scratch}/latest", available_now=True)
        q1.awaitTermination()
        q2.awaitTermination()
        spark.streams.awaitAnyTermination(1)
    finally:
        import time
        time.sleep(1)
        spark.streams.removeListener(listener)
    latest = {r.symbol: r.price for r in read_latest_version(spark, f"{scratch}/latest").collect()}
    assert latest == {"a": 3.0, "b": 5.0}
    assert alerts_in(spark, f"{scratch}/alerts") == [("a", dt.datetime(2024, 1, 1, 0, 0), 1.0, 2.0)]
    rows = q1.recentProgress
    m = progress_metrics(progress_frame(spark, rows)).collect()
    assert m and m[0].batches == len(rows) and m[0].input_rows == 4


def test_sinks_are_idempotent_per_batch(spark, scratch):
    table = f"{scratch}/latest"
    f = upsert_latest(table)
    b0 = spark.createDataFrame([("a", 1.0, 10, 11, 1), ("a", 2.0, 20, 21, 2)],
                               "symbol string, price double, binance_timestamp long, received_timestamp long, "
                               "offset long")
    f(b0, 0)
    b1 = spark.createDataFrame([("a", 5.0, 50, 51, 3), ("b", 7.0, 70, 71, 4)], b0.schema)
    f(b1, 1)
    f(b1, 1)   # a replayed batch rewrites its own version
    got = {r.symbol: r.price for r in read_latest_version(spark, table).collect()}
    assert got == {"a": 5.0, "b": 7.0}
    log = f"{scratch}/log"
    g = append_trim(log, 3)
    rows = [("s%d" % i, dt.datetime(2024, 1, 1, 0, i), dt.datetime(2024, 1, 1, 0, i + 1), 1.0, 2.0, 1.0, "SELL")
            for i in range(5)]
    schema = ("symbol string, window_start timestamp, window_end timestamp, open_price double, "
              "close_price double, percent_change double, alert_type string")
    g(spark.createDataFrame(rows[:2], schema), 0)
    g(spark.createDataFrame(rows[2:], schema), 1)
    g(spark.createDataFrame(rows[2:], schema), 1)
    kept = sorted(r.symbol for r in read_latest_version(spark, log).collect())
    assert kept == ["s2", "s3", "s4"]


ALERT_ROWS = ("symbol string, window_start timestamp, window_end timestamp, open_price double, "
              "close_price double, percent_change double, alert_type string")


def alert_row(symbol, minute):
    t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    return (symbol, t, t + dt.timedelta(minutes=1), 1.0, 2.0, 1.0, "SELL")


def test_a_trimmed_alert_that_comes_again_pushes_out_nothing(spark, scratch):
    """Redelivery after trimming: in the same batch form, in pieces, and mixed with
    new alerts; a symbol that comes late for the first time is stored."""
    log = f"{scratch}/log"
    put = append_trim(log, 4)
    first = [alert_row(s, m) for m in range(10) for s in ("a", "b")]

    def stored():
        return sorted((r.symbol, r.window_start.minute) for r in read_latest_version(spark, log).collect())

    put(spark.createDataFrame(first, ALERT_ROWS), 0)
    newest = [("a", 8), ("a", 9), ("b", 8), ("b", 9)]
    assert stored() == newest
    put(spark.createDataFrame(first, ALERT_ROWS), 1)             # all of it again
    assert stored() == newest
    for b, piece in enumerate((first[:6], first[6:], first[:6])):  # again, in pieces
        put(spark.createDataFrame(piece, ALERT_ROWS), 2 + b)
        assert stored() == newest
    put(spark.createDataFrame(first[:3] + [alert_row("a", 20)], ALERT_ROWS), 5)
    assert stored() == [("a", 8), ("a", 9), ("a", 20), ("b", 9)]   # symbol ascending within a window end
    put(spark.createDataFrame([alert_row("c", 1)], ALERT_ROWS), 6)  # unseen symbol: no mark
    assert ("c", 1) in stored() and ("a", 20) in stored()
    put(spark.createDataFrame([alert_row("c", 1)], ALERT_ROWS), 6)  # the same batch again
    assert ("c", 1) in stored() and len(stored()) == 4


def test_alert_json_and_progress_samples(spark):
    from candlewick.operators.alerts import alert_messages
    from candlewick.streaming.listener import progress_frame, progress_samples
    df = spark.createDataFrame(
        [("btc", dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 1), 100.0, 102.0, 0.02, "SELL")],
        "symbol string, window_start timestamp, window_end timestamp, open_price double, close_price double, "
        "percent_change double, alert_type string")
    r = alert_messages(df).first()
    assert r.key == "btc"
    assert json.loads(r.value) == {"symbol": "btc", "window_start": "2024-01-01T00:00:00.000Z",
                                   "window_end": "2024-01-01T00:01:00.000Z", "open_price": 100.0,
                                   "close_price": 102.0, "percent_change": 0.02, "alert_type": "SELL"}
    prog = progress_frame(spark, [("q", 0, "2024-01-01T00:00:00Z", 0.3, 10, 1),
                                  ("q", 1, "2024-01-01T00:00:05Z", 2.5, 5, -1)])
    s = {(x.family, x.part, x.le, x.ts): x.value for x in progress_samples(prog).collect()}
    t1 = 1704067205.0
    assert s[("spark_input_rows_total", "", None, t1)] == 15.0
    assert s[("spark_output_rows_total", "", None, t1)] == 1.0
    assert s[("spark_batch_duration_seconds", "bucket", 0.5, t1)] == 1.0
    assert s[("spark_batch_duration_seconds", "bucket", 5.0, t1)] == 2.0


def test_rocksdb_state_and_price_sink(spark, scratch):
    from candlewick.session import use_rocksdb_state
    from candlewick.sources.ticks import price_records, ticks_from_events
    from candlewick.streaming.jobs import write_ticks
    from tests.conftest import SF001
    recs = price_records(ticks_from_events(spark.read.parquet(f"{SF001}/events.parquet")))
    write_ticks(recs, path=f"{scratch}/prices")
    back = spark.read.parquet(f"{scratch}/prices")
    assert back.count() == recs.count()
    # a symbol's records stay together, as on a keyed topic partition
    per_file = back.select(F.input_file_name().alias("f"), "key").distinct().groupBy("key").count()
    assert per_file.where(F.col("count") > 1).count() == 0
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    use_rocksdb_state(spark)
    try:
        src = read_topic(spark, "prices", source="files", path=f"{scratch}/prices")
        q = start_alert_job(src, f"{scratch}/ck", sink="files", path=f"{scratch}/alerts", window="1 hour",
                            threshold=0.0025, available_now=True)
        q.awaitTermination()
        assert len(alerts_in(spark, f"{scratch}/alerts")) > 0
    finally:
        if old:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
        else:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_histogram_same_in_stream_and_batch(spark, scratch):
    """The consumer's latency histogram as a live aggregate equals the batch one."""
    from candlewick.config import BOUNDS_E2E_LATENCY
    from candlewick.functions import latency as L
    from candlewick.functions import normalize as N
    from candlewick.operators.histogram import histogram
    from candlewick.plans.planted import consumer_records
    from candlewick.sources.ticks import ticks_from_events
    from tests.conftest import SF001
    recs = consumer_records(ticks_from_events(spark.read.parquet(f"{SF001}/events.parquet")))
    recs.repartition(3).write.parquet(f"{scratch}/m")

    def lat(df):
        ok = N.good(N.classify_price_records(df))
        return histogram(ok.select("symbol", L.e2e_latency("stored_timestamp", "binance_timestamp").alias("e2e")),
                         "e2e", BOUNDS_E2E_LATENCY)
    name = f"hist_{uuid.uuid4().hex[:6]}"
    src = spark.readStream.schema(spark.read.parquet(f"{scratch}/m").schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{scratch}/m")
    q = lat(src).writeStream.outputMode("complete").format("memory").queryName(name) \
        .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (r.symbol, r.le, r.bucket_count, round(r.sum, 9), r["count"])
    streamed = sorted(map(key, spark.table(name).collect()))
    batch = sorted(map(key, lat(spark.read.parquet(f"{scratch}/m")).collect()))
    assert streamed == batch and len(batch) == 5 * (len(BOUNDS_E2E_LATENCY) + 1)


def test_sink_versions_are_pruned(spark, scratch):
    from candlewick.streaming.sinks import KEEP_VERSIONS, committed_versions
    table = f"{scratch}/latest"
    f = upsert_latest(table)
    schema = "symbol string, price double, binance_timestamp long, received_timestamp long, offset long"
    for b in range(KEEP_VERSIONS + 3):
        f(spark.createDataFrame([("a", float(b), b, b, b)], schema), b)
    assert committed_versions(spark, table) == list(range(3, KEEP_VERSIONS + 3))
    assert read_latest_version(spark, table).first().price == float(KEEP_VERSIONS + 2)


def test_live_metric_increments_equal_batch(spark, scratch):
    """Streamed per-scrape increments, filled onto the grid, equal the same
    derivation in batch on every closed scrape interval."""
    from candlewick.operators.series import Grid
    from candlewick.sources.samples import fill_grid
    from candlewick.plans.planted import consumer_records, started_us
    from candlewick.sources.ticks import ticks_from_events
    from candlewick.streaming.metrics import LATENCIES, start_metrics_job, tick_increments
    from tests.conftest import SF01
    timed = ticks_from_events(spark.read.parquet(f"{SF01}/events.parquet")).withColumn("processing_start", started_us())
    recs = consumer_records(timed, "processing_start")
    # One file per quarter of the tape, written in time order: the file
    # source replays files by modification time, one per micro-batch.
    from candlewick.sources.streams import write_in_time_order
    write_in_time_order(recs, f"{scratch}/m", 4)
    schema = spark.read.parquet(f"{scratch}/m").schema
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/m")
    origin = BASE_US // 1_000_000
    q = start_metrics_job(src, f"{scratch}/ck", f"{scratch}/inc", 3600, origin=origin, available_now=True)
    q.awaitTermination()
    dropped = sum(o.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for o in p["stateOperators"])
    assert dropped == 0
    grid = Grid(origin, 3600, 1, 720)
    streamed = fill_grid(spark.read.parquet(f"{scratch}/inc"), grid)
    batch = fill_grid(tick_increments(spark.read.parquet(f"{scratch}/m"), 3600, origin), grid)
    last = spark.read.parquet(f"{scratch}/inc").agg(F.max("k")).first()[0]
    key = lambda r: (r.family, r.part, r.series, r.le, r.ts, r.value)
    cut = origin + last * 3600
    s = sorted(map(key, streamed.where(F.col("ts") <= cut).collect()))
    b = sorted(map(key, batch.where(F.col("ts") <= cut).collect()))
    assert len(s) > 1000 and s == b
    assert {r[0] for r in s} == {"ticks_total"} | {x[0] for x in LATENCIES}


def test_latencies_without_one_of_their_times_are_not_observed(spark):
    from candlewick.streaming.metrics import tick_increments
    rows = [("a", '{"price": 1.0, "binance_timestamp": 1704067200000000, "received_timestamp": %s}' % r, s, p)
            for r, s, p in [("1704067200020000", 1704067200100000, 1704067200099000), ("0", 1704067200200000, None),
                            ("null", None, 0)]]
    recs = spark.createDataFrame(rows, "key string, value string, stored_timestamp long, processing_start long")

    def seen(df):
        got = tick_increments(df, 3600).where("part in ('count', 'sum')").select("family", "part", "inc").collect()
        return {(r.family, r.part): r.inc for r in got}

    short = {("e2e_latency_seconds", "count"): 2, ("e2e_latency_seconds", "sum"): 300_000,
             ("network_latency_seconds", "count"): 1, ("network_latency_seconds", "sum"): 20_000,
             ("system_latency_seconds", "count"): 1, ("system_latency_seconds", "sum"): 80_000}
    assert seen(recs.drop("processing_start")) == short
    assert seen(recs) == short | {("processing_latency_seconds", "count"): 1,
                                  ("processing_latency_seconds", "sum"): 1_000}
    low = tick_increments(recs, 3600).where("family = 'network_latency_seconds' and part = 'bucket'")
    assert {r.le: r.inc for r in low.collect()}[0.01] == 0 and {r.le: r.inc for r in low.collect()}[0.025] == 1
