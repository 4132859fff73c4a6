"""Live operators: sliding ranges, repeats dropped in the stream, equal trade times."""

import datetime as dt
import random

from pyspark.sql import functions as F

from candlewick.operators.candles import candles, tick_order
from candlewick.operators.sliding import sliding_rates, sliding_totals
from candlewick.streaming.jobs import alert_stream, start_distinct_alerts_job
from tests.test_streaming import ALERT_ROWS, alert_row

START = dt.datetime(2024, 1, 1)


def made(n=400, seed=1):
    rnd = random.Random(seed)
    return [(rnd.choice("ab"), START + dt.timedelta(microseconds=rnd.choice([0, 5_000_000 * rnd.randint(0, 40),
                                                                             rnd.randint(0, 200_000_000)])), i)
            for i in range(n)]


def test_ranges_are_open_on_the_left_and_closed_on_the_right(spark):
    rows = made()
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp, v long")
    got = {(r.symbol, r.t.replace(tzinfo=None)): (r.n, r.v) for r in sliding_totals(df, 60, 5, sums=("v",)).collect()}
    want = {}
    for j in range(0, 60):
        t = START + dt.timedelta(seconds=5 * j)
        for s in "ab":
            inside = [v for q, at, v in rows if q == s and t - dt.timedelta(seconds=60) < at <= t]
            if inside:
                want[(s, t)] = (len(inside), sum(inside))
    assert got == want
    rates = sliding_rates(df, 60, 5).where("symbol = 'a'").orderBy("t").first()
    assert rates.per_second == rates.n / 60


def test_streamed_ranges_equal_batch_on_closed_points(spark, scratch):
    rows = sorted(made(600, 2), key=lambda r: r[1])
    schema = "symbol string, event_time timestamp, v long"
    for k in range(3):
        spark.createDataFrame(rows[k * 200:(k + 1) * 200], schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        src = spark.readStream.schema(schema).parquet(f"{scratch}/in")
        sliding_totals(src, 60, 5, watermark="1 second").writeStream.format("parquet").outputMode("append") \
            .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start(f"{scratch}/out").awaitTermination()
    live = {tuple(r) for r in spark.read.parquet(f"{scratch}/out").collect()}
    last = rows[-1][1] - dt.timedelta(seconds=1)
    batch = {tuple(r) for r in sliding_totals(spark.createDataFrame(rows, schema), 60, 5).collect()
             if r.t.replace(tzinfo=None) <= last}
    assert live == batch and len(batch) > 50


def test_repeats_are_dropped_in_the_stream_with_bounded_state(spark, scratch):
    from candlewick.operators.alerts import alert_messages
    rows = [alert_row(s, m) for m in range(0, 600, 10) for s in ("a", "b")]

    def deliver(part):
        recs = alert_messages(spark.createDataFrame(part, ALERT_ROWS))
        recs.selectExpr("cast(key as binary) key", "cast(value as binary) value").write.mode("append").parquet(f"{scratch}/topic")
        src = spark.readStream.schema("key binary, value binary").parquet(f"{scratch}/topic")
        q = start_distinct_alerts_job(src, f"{scratch}/ck", f"{scratch}/out", delay="1 hour", available_now=True,
                                      state_partitions=2)
        q.awaitTermination()
        return [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]

    state = []
    for k in range(0, len(rows), 24):
        state += deliver(rows[k:k + 24] * 2 + rows[max(0, k - 4):k])     # twice, and some of the last once more
    state += deliver(rows)                                               # everything again
    out = spark.read.parquet(f"{scratch}/out")
    assert out.count() == len(rows) == out.distinct().count()
    assert state[-1] <= 24 + 16                  # keys of about the delay, not of all 120 alerts


def test_equal_times_are_ordered_by_offset_in_a_hash_aggregate(spark):
    rows = [("a", START, 10 ** 15, o, float(p)) for p, o in enumerate([7, 3, 10 ** 18, 5])] + [("a", START, 10 ** 15 + 1, 0, 9.0)]
    df = spark.createDataFrame(rows, "symbol string, event_time timestamp, binance_timestamp long, offset long, price double")
    c = candles(df.withColumn("o", tick_order()), "1 hour", order_col="o")
    r = c.first()
    assert (r.open_price, r.close_price) == (1.0, 9.0)
    assert "SortAggregate" not in c._jdf.queryExecution().executedPlan().toString()
    r = candles(df.where("price < 9").withColumn("o", tick_order()), "1 hour", order_col="o").first()
    assert (r.open_price, r.close_price) == (1.0, 2.0)


def test_the_alert_job_stays_a_hash_aggregate(spark):
    recs = spark.createDataFrame([], "key binary, value binary, offset long")
    assert "SortAggregate" not in alert_stream(recs)._jdf.queryExecution().executedPlan().toString()
