"""Unit fixtures for candles and alerts (FIXTURES.md part 3)."""

import datetime as dt

from pyspark.sql import functions as F

from candlewick.operators.alerts import alerts, alert_log, newest_alerts
from candlewick.operators.candles import candles

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def tape(spark, rows):
    """rows: (symbol, seconds after T0 or None, price, order)"""
    data = [(s, None if t is None else T0 + dt.timedelta(seconds=t), p, o) for s, t, p, o in rows]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp_ntz, price double, o long")
    return df.withColumn("binance_timestamp", F.col("o"))


def test_open_close(spark):
    df = tape(spark, [("btc", 1, 100.0, 1), ("btc", 58, 101.0, 2), ("btc", 59, 102.0, 3)])
    r = candles(df, "1 minute").collect()
    assert len(r) == 1
    assert (r[0].open_price, r[0].close_price) == (100.0, 102.0)
    assert abs(r[0].percent_change - 0.02) < 1e-12
    assert r[0].window_start == T0 and r[0].window_end == T0 + dt.timedelta(minutes=1)


def test_order_not_arrival(spark):
    # open/close follow the trade time, not row order
    df = tape(spark, [("btc", 59, 102.0, 3), ("btc", 1, 100.0, 1), ("btc", 58, 101.0, 2)])
    r = candles(df.repartition(3), "1 minute").collect()[0]
    assert (r.open_price, r.close_price) == (100.0, 102.0)


def test_zero_open_no_alert(spark):
    df = tape(spark, [("x", 1, 0.0, 1), ("x", 2, 5.0, 2)])
    c = candles(df, "1 minute")
    assert c.collect()[0].percent_change is None
    assert alerts(c, 0.0025).count() == 0


def test_threshold_is_strict(spark):
    # binary-exact: (5 - 4) / 4 = 0.25 exactly
    df = tape(spark, [("x", 1, 4.0, 1), ("x", 2, 5.0, 2)])
    c = candles(df, "1 minute")
    assert alerts(c, 0.25).count() == 0
    assert alerts(c, 0.2499).count() == 1


def test_labels_contrarian(spark):
    df = tape(spark, [("up", 1, 4.0, 1), ("up", 2, 5.0, 2), ("dn", 1, 5.0, 1), ("dn", 2, 4.0, 2)])
    a = {r.symbol: r.alert_type for r in alerts(candles(df, "1 minute"), 0.01).collect()}
    assert a == {"up": "SELL", "dn": "BUY"}


def test_null_time_and_price(spark):
    df = tape(spark, [("x", None, 1.0, 1), ("x", 1, None, 2), ("x", 2, 3.0, 3)])
    r = candles(df, "1 minute").collect()
    assert len(r) == 1  # the NULL-time row reaches no window
    assert r[0].open_price is None and r[0].close_price == 3.0
    assert r[0].percent_change is None


def test_ties_broken_by_order_key(spark):
    df = tape(spark, [("x", 1, 1.0, 7), ("x", 1, 2.0, 3), ("x", 1, 3.0, 9)])
    r = candles(df, "1 minute").collect()[0]
    assert (r.open_price, r.close_price) == (2.0, 3.0)


def test_alert_log_trim(spark):
    rows = [("s%03d" % i, T0 + dt.timedelta(minutes=i), T0 + dt.timedelta(minutes=i + 1), 1.0, 2.0, 1.0, "SELL")
            for i in range(205)]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp_ntz, window_end timestamp_ntz, "
                                     "open_price double, close_price double, percent_change double, "
                                     "alert_type string")
    log = alert_log(df, 200).collect()
    assert len(log) == 200 and {r.symbol for r in log} == {"s%03d" % i for i in range(5, 205)}
    view = newest_alerts(df, 20).collect()
    assert [r.symbol for r in view] == ["s%03d" % i for i in range(204, 184, -1)]


def test_row_order_and_partitioning_do_not_matter(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    from candlewick.sources.ticks import ticks_from_events
    t = ticks_from_events(ev)
    a = sorted(map(tuple, candles(t, "1 hour").collect()))
    b = sorted(map(tuple, candles(t.repartition(7).orderBy(F.rand(1)), "1 hour").collect()))
    assert a == b
