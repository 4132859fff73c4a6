"""Feed/consumer validation, symbol lists, latencies, presentation."""

import json

from pyspark.sql import functions as F

from candlewick.functions import normalize as N
from candlewick.functions import present as P
from candlewick.functions.symbols import symbol_list
from candlewick.operators.latest import configured_symbols
from candlewick.sources.catalog import load_catalog, spot_symbol_list


def test_envelope_classes(spark):
    rows = [
        ('{bad',),
        ('{"stream":"x"}',),
        ('{"data":null}',),
        ('{"data":{"s":"BTCUSDT","p":"1.5","T":1704067200000000}}',),
        ('{"data":{"p":"1.5","T":1704067200000000}}',),
        ('{"data":{"s":null,"p":"1.5","T":1704067200000000}}',),
        ('{"data":{"s":"A","p":"abc","T":1704067200000000}}',),
        ('{"data":{"s":"A","p":"1","T":1704067200000}}',),
        ('{"data":{"s":"A","p":2.5,"T":"1704067200000001"}}',),
    ]
    out = N.classify_envelopes(spark.createDataFrame(rows, "value string")).collect()
    got = [(r.error_type, r.symbol, r.price) for r in out]
    assert got == [("json_decode", None, None), ("processing", None, None),
                   (None, "btcusdt", 1.5), (None, "unknown", 1.5), ("processing", None, None),
                   ("processing", None, None), ("processing", None, None), (None, "a", 2.5)]


def test_consumer_validation(spark):
    rows = [(None, json.dumps({"price": 1.0, "binance_timestamp": 5})),
            ("", json.dumps({"price": 1.0, "binance_timestamp": 5})),
            ("btc", "[1, 2]"),
            ("btc", json.dumps({"price": 1.0, "binance_timestamp": 0})),
            ("btc", json.dumps({"price": 1.0})),
            ("btc", json.dumps({"price": 1.0, "binance_timestamp": 7, "received_timestamp": 3}))]
    df = spark.createDataFrame(rows, "key string, value string").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    got = [r.error_type for r in N.classify_price_records(df).collect()]
    assert got == ["invalid_message", "invalid_message", "invalid_message",
                   "missing_timestamp", "missing_timestamp", None]


def test_symbol_list(spark):
    r = spark.range(1).select(symbol_list(F.lit(" btcusdt,, ETHUSDT ")).alias("s")).first()
    assert r.s == ["btcusdt", "ethusdt"]
    pos = configured_symbols(spark, "b, a ,b").orderBy("pos").collect()
    assert [(x.pos, x.symbol) for x in pos] == [(0, "b"), (1, "a")]


def test_spot_symbols(spark, scratch):
    p = f"{scratch}/info.json"
    with open(p, "w") as f:
        json.dump({"symbols": [{"symbol": "BTCUSDT", "isSpotTradingAllowed": True},
                               {"symbol": "XYZ", "isSpotTradingAllowed": False},
                               {"symbol": "ETHUSDT"},
                               {"symbol": "BNBUSDT", "isSpotTradingAllowed": True}]}, f)
    assert spot_symbol_list(spark, p).first().symbols == "btcusdt,bnbusdt"


def test_catalog_file(spark, scratch):
    from candlewick.plans.catalog import CATALOG
    doc = {}
    for s in CATALOG:
        doc.setdefault(s.component, {})[s.metric] = {"query": s.kind, "description": "", "unit": s.unit}
    p = f"{scratch}/metrics.json"
    with open(p, "w") as f:
        json.dump(doc, f)
    c = load_catalog(spark, p)
    assert c.count() == 52
    assert c.select("name").distinct().count() == 52
    assert {r.name for r in c.collect()} == {s.name for s in CATALOG}


def test_presentation(spark):
    df = spark.createDataFrame([(95000.0, 0.02134, "BUY"), (12.31, -0.004, "SELL"), (1234567.5, 0.0, "X")],
                               "p double, c double, t string")
    r = df.select(P.money("p").alias("m"), P.signed_fixed2(F.col("c") * 100).alias("s"),
                  P.alert_colour("t").alias("k")).collect()
    assert [(x.m, x.s, x.k) for x in r] == [("$95,000.0", "+2.13", "green"), ("$12.31", "-0.40", "red"),
                                            ("$1,234,567.5", "+0.00", "gray")]
    st = spark.createDataFrame([(0.0,), (0.009,), (0.01,), (0.5,)], "v double").select(P.status_of("v").alias("s"))
    assert [x.s for x in st.collect()] == ["green", "green", "yellow", "red"]


def test_e2e_is_network_plus_system(spark):
    from candlewick.functions import latency as L
    from candlewick.sources.ticks import ticks_from_events
    t = ticks_from_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    bad = t.where(F.abs(L.e2e_latency("stored_timestamp", "binance_timestamp")
                        - L.network_latency("received_timestamp", "binance_timestamp")
                        - L.system_latency("stored_timestamp", "received_timestamp")) > 1e-9)
    assert bad.count() == 0


def test_step_latency_and_clock_skew(spark):
    from candlewick.functions import latency as L
    df = spark.createDataFrame([(1_000_000, 1_250_000, 1000.0, 1010.0, 1002)],
                               "start long, finish long, before double, after double, server long")
    r = df.select(L.step_latency("finish", "start").alias("step"),
                  L.clock_skew("before", "after", "server").alias("skew"),
                  L.round_trip("before", "after").alias("rtt")).first()
    assert r.step == 0.25 and r.skew == 0.003 and r.rtt == 0.01
