"""Values come out as they went in: prices, labels, card texts, long tapes."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from candlewick.functions import normalize as N
from candlewick.functions import present as P
from candlewick.operators import series as SE
from candlewick.operators.alerts import alert_log, alerts
from candlewick.operators.metrics import evaluate, panel_series
from candlewick.plans.catalog import PanelSeries, Spec
from candlewick.plans.q_candles import alerts_1h
from candlewick.sources.catalog import load_specs
from candlewick.sources.samples import scrape_grid, source_series
from candlewick.sources.tables import load
from tests.conftest import SF001


@pytest.mark.parametrize("query, table, price", [
    ("candles_1m", "events", "value"), ("candles_1h", "events", "value"), ("candles_1d", "events", "value"),
    ("candles_orders_1w", "orders", "o_totalprice")])
def test_every_candle_price_is_a_traded_price(spark, query, table, price):
    traded = {r[0] for r in load(spark, SF001, table).select(F.col(price).cast("double")).collect()}
    for r in E.queries()[query](spark, SF001).collect():
        assert r.open_price in traded and r.close_price in traded


def test_nan_and_infinite_prices_are_rejected(spark):
    rows = [(json.dumps({"data": {"s": "A", "p": p, "T": 1704067200000000}}),) for p in ("1.5", "NaN", "Infinity", "x")]
    got = N.classify_envelopes(spark.createDataFrame(rows, "value string"))
    assert [(r.price, r.error_type) for r in got.collect()] == [(1.5, None)] + [(None, "processing")] * 3


def test_a_change_that_is_no_number_never_alerts(spark):
    rows = [("a", 0, 1, 1.0, 2.0, c) for c in (1.0, float("nan"), None, 0.0)]
    df = spark.createDataFrame(rows, "symbol string, window_start long, window_end long, open_price double, "
                                     "close_price double, percent_change double")
    assert [r.percent_change for r in alerts(df).collect()] == [1.0]


def test_alert_log_counts_a_repeated_window_once(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 0, 1), ("b", 0, 1), ("a", 1, 2)],
                               "symbol string, window_start long, window_end long")
    assert [(r.symbol, r.window_start) for r in alert_log(df, 2).collect()] == [("a", 1), ("a", 0)]


def test_card_texts_follow_python_formats(spark):
    xs = [1.115, 0.125, 0.375, -0.125, 2.675, 0.0, -0.001, 1e15 + 0.5, 123456.785, 0.005, 0.015, 1.005, 99.995]
    xs += [1.23e-11, 1e30, 1e16, 9999999999999998.0, 0.0001, 0.00012345678901234567, 95000.0, 12.31, 1234567.891]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select("x", P.money("x").alias("m"), F.when(F.abs("x") < 1e17, P.signed_fixed2("x")).alias("s"))
    for r in rows.collect():
        assert r.m == "$" + f"{r.x:,}", r
        assert r.s is None or r.s == f"{r.x:+.2f}", r
    assert spark.range(1).select(P.money(F.lit(float("nan"))), P.money(F.lit(float("inf")))).first()[:] == ("$nan", "$inf")


def sample_frame(spark, rows):
    return spark.createDataFrame(rows, "family string, part string, labels map<string,string>, le double, ts double, "
                                       "value double")


def test_labels_survive_any_text(spark):
    labels = [{"name": "a,b"}, {"name": "a=b"}, {"name": None}, {}, {"x": "1", "name": 'q"\u00e9'}]
    df = spark.createDataFrame([(x,) for x in labels], "labels map<string,string>")
    back = df.select(SE.labels_of(SE.series_key(F.col("labels"))).alias("l")).collect()
    assert [r.l for r in back] == labels
    rows = [("c", "", x, None, float(t), float(t)) for x in labels[:2] for t in (1, 2, 3)]
    rates = SE.range_rate(sample_frame(spark, rows), 10, SE.Grid(0, 1, 3, 3))
    assert {r.labels["name"] for r in rates.collect()} == {"a,b", "a=b"}


def test_bare_selectors_keep_series_apart(spark):
    rows = [(f, "", {"s": s}, None, float(t), float(t * k)) for f in ("c", "g") for s, k in (("a", 1), ("b", 3))
            for t in (1, 2, 3)]
    specs = [Spec("x", "rate", "rate", "c"), Spec("x", "gauge", "gauge", "g"),
             Spec("x", "both", "rate_sum", "c", tuple(("s", "!=", v) for v in "uvwxyz"))]
    df, grid = sample_frame(spark, rows), SE.Grid(0, 1, 3, 3)
    mapping = [("c", "c", ()), ("g", "g", ())]
    m = evaluate(spark, df.where("family = 'c'"), df.where("family = 'g'"), grid, 10, 10, specs=specs, mapping=mapping)
    count = {r["metric"]: r["n"] for r in m.groupBy("metric").agg(F.count("*").alias("n")).collect()}
    assert count == {"x_rate": 2, "x_gauge": 2, "x_both": 1}
    lines = panel_series(spark, m, grid, [PanelSeries("p", "g", "ref", ("x_gauge",))]).collect()
    assert sorted(r.value for r in lines) == [3.0, 9.0] and len({r.series for r in lines}) == 2


def test_a_tape_beyond_a_month_keeps_every_event(spark):
    start = dt.datetime(2023, 12, 30, 23, 30)
    rows = [(i, start + dt.timedelta(hours=7 * i), i % 9, "view" if i % 3 else "buy", 1.0 + i, "{}") for i in range(200)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                         "value double, props string")
    grid = scrape_grid(events)
    assert grid.origin < start.replace(tzinfo=dt.timezone.utc).timestamp() <= grid.origin + 3600
    counters, _ = source_series(events)
    last = counters.where("family = 'ticks_total'").groupBy(F.col("labels")["symbol"]).agg(F.max("value")).collect()
    assert sum(v for _, v in last) == 200
    assert max(r.ts for r in counters.select("ts").collect()) >= rows[-1][1].replace(tzinfo=dt.timezone.utc).timestamp()


def test_histograms_use_their_own_bounds(spark):
    from candlewick import config as C
    events = load(spark, SF001, "events")
    counters, _ = source_series(events, alerts_1h(spark, SF001))
    got = {}
    for r in counters.where("part = 'bucket'").select("family", "le").distinct().collect():
        got.setdefault(r.family, []).append(r.le)
    want = {"e2e_latency_seconds": C.BOUNDS_E2E_LATENCY, "network_latency_seconds": C.BOUNDS_NETWORK_LATENCY,
            "system_latency_seconds": C.BOUNDS_SYSTEM_LATENCY, "producer_latency_seconds": C.BOUNDS_PRODUCER_LATENCY,
            "processing_latency_seconds": C.BOUNDS_PRICE_PROCESSING,
            "alert_processing_seconds": C.BOUNDS_ALERT_PROCESSING}
    assert {k: sorted(v) for k, v in got.items()} == {k: [*v, float("inf")] for k, v in want.items()}


def test_metric_files_are_checked(spark, scratch):
    good = {"component": "u", "metric": "m", "kind": "hist_q", "family": "f", "q": 0.9,
            "matchers": [{"label": "a", "op": "!=", "value": ""}]}
    for i, (change, ok) in enumerate([({}, True), ({"q": None}, False), ({"kind": "sum"}, False),
                                      ({"matchers": [{"label": "a", "op": "~", "value": ""}]}, False)]):
        with open(f"{scratch}/m{i}.json", "w") as f:
            json.dump([good | change], f)
        if ok:
            assert load_specs(spark, f"{scratch}/m{i}.json") == [
                Spec("u", "m", "hist_q", "f", (("a", "!=", ""),), 0.9, "")]
        else:
            with pytest.raises(ValueError):
                load_specs(spark, f"{scratch}/m{i}.json")
