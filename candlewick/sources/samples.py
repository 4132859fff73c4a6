"""Metric samples derived from the driver tables (FIXTURES.md part 2: S R C G).

A scrape k (1..K) happens at t_k = origin + k*step and sees every event with
trade time <= t_k. Counters are cumulative, gauges the last observed value.
A counter series exists from the first scrape on (zeros before its first
event); a labelled error counter exists once it has been incremented.

Work: the events are read once and collapse in ONE aggregation per
(symbol, k) that yields every counter increment and gauge observation; a
second, tiny aggregation does the same for alerts. The scrape grid is then
filled by a two-level prefix scan: windows within (series, block of scrapes),
and one row per block that carries the running sum and the next observation
across blocks - so no task holds a whole series, however long it is. An explode
repeats each value until the next observation; no grid join, no distinct.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from candlewick.config import (BOUNDS_ALERT_PROCESSING, BOUNDS_E2E_LATENCY, BOUNDS_NETWORK_LATENCY,
                               BOUNDS_PRICE_PROCESSING, BOUNDS_PRODUCER_LATENCY, BOUNDS_SYSTEM_LATENCY,
                               FIXTURE_STEP)
from candlewick.functions import latency as L
from candlewick.functions import normalize as N
from candlewick.operators.series import BLOCK_POINTS, Grid, labels_of, series_key, with_series
from candlewick.session import checkpoint_root
from candlewick.sources.ticks import epoch_micros, price_value, ticks_from_events, trade_envelope

INF = float("inf")
FEED_ERRORS = ("json_decode", "processing")
CONSUMER_ERRORS = ("invalid_message", "missing_timestamp")
# Families whose series exist only once they were incremented (labelled errors).
ON_FIRST_USE = ("feed_errors_total", "consumer_rejects_total", "time_request_errors_total",
                "alert_rejects_total")
GAUGE_FAMILIES = ("memory_working_set_bytes", "clock_skew_seconds", "api_round_trip_seconds",
                  "partition_lag", "alert_lag")
SERIES_COLS = ("family", "part", "series", "le")


@dataclass(frozen=True)
class Messages:
    """The messages as they arrive, as columns over ticks (and alerts): the raw feed
    envelope, the consumer's record key and value, whether the clock request failed,
    and whether an alert record is invalid; and the times of its steps in µs: when the
    producer had sent it, when the consumer began with it, how long an alert took. The
    defaults are well-formed messages whose steps were not timed."""
    envelope: Callable[[], Column] = trade_envelope
    key: Callable[[], Column] = lambda: F.col("symbol")
    value: Callable[[], Column] = price_value
    request_failed: Callable[[], Column] = lambda: F.lit(False)
    alert_invalid: Callable[[], Column] = lambda: F.lit(False)
    sent: Callable[[], Column] = lambda: F.lit(None).cast("long")
    started: Callable[[], Column] = lambda: F.lit(None).cast("long")
    alert_us: Callable[[], Column] = lambda: F.lit(None).cast("long")


def scrape_of(micros: Column, origin: int = 0, step: int = FIXTURE_STEP) -> Column:
    """First scrape index k whose time t_k is at or after the event."""
    return F.ceil((micros - F.lit(origin * 1_000_000)) / F.lit(float(step) * 1_000_000)).cast("long")


def scrape_grid(events: DataFrame, step: int = FIXTURE_STEP) -> Grid:
    """The scrapes 1..K that cover every event and every window that ends within
    a step of the last one, from the smallest and the largest event time."""
    us = epoch_micros("ts")
    r = events.agg(F.min(us).alias("a"), F.max(us).alias("z")).first()
    if r["a"] is None:
        return Grid(0, step, 1, 1)
    width = step * 1_000_000
    first = -(-r["a"] // width)
    return Grid((first - 1) * step, step, 1, r["z"] // width + 2 - first)


def _ntz(epoch_s: int) -> str:
    """A timestamp_ntz literal for an epoch second (UTC wall time)."""
    import datetime as dt
    wall = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=epoch_s)
    return f"timestamp_ntz'{wall:%Y-%m-%d %H:%M:%S}'"


def _lab(**kv) -> Column:
    if not kv:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for k, v in kv.items() for x in (F.lit(k), v)]).cast("map<string,string>")


def _hist(family: str, v: Column, v_us: Column, labels: Column, bounds):
    """Increments of one histogram on ``v`` (seconds): cumulative buckets,
    the sum kept exactly in integer µs (scale 1e6), and the count."""
    out = [(family, "bucket", labels, float(b), F.count_if(v <= F.lit(b)), 1.0) for b in bounds]
    out.append((family, "bucket", labels, INF, F.count(v), 1.0))
    out.append((family, "sum", labels, None, F.coalesce(F.sum(v_us), F.lit(0)), 1e6))
    out.append((family, "count", labels, None, F.count(v), 1.0))
    return out


def _counter_entries():
    """(family, part, labels, le, aggregate, scale): every counter increment
    per (symbol, k). Increments are integers (counts, µs, cents) so running
    sums are exact and a counter never dips by rounding."""
    sym = _lab(symbol=F.col("symbol"))
    name = _lab(name=F.col("symbol"))
    n = F.count(F.lit(1))
    e = [("ticks_total", "", sym, None, n, 1.0)]
    e += _hist("e2e_latency_seconds", F.col("e2e"), F.col("e2e_us"), sym, BOUNDS_E2E_LATENCY)
    e += _hist("network_latency_seconds", F.col("net"), F.col("net_us"), sym, BOUNDS_NETWORK_LATENCY)
    e += _hist("system_latency_seconds", F.col("sys"), F.col("sys_us"), sym, BOUNDS_SYSTEM_LATENCY)
    e += _hist("producer_latency_seconds", F.col("prod"), F.col("prod_us"), sym, BOUNDS_PRODUCER_LATENCY)
    e += _hist("processing_latency_seconds", F.col("proc"), F.col("proc_us"), sym, BOUNDS_PRICE_PROCESSING)
    e += [
        ("cpu_seconds_total", "", name, None, F.coalesce(F.sum("cents"), F.lit(0)), 100000.0),
        ("network_receive_bytes_total", "", name, None, F.coalesce(F.sum("user_id"), F.lit(0)), 1.0),
        ("network_transmit_bytes_total", "", name, None, n, 1.0),
        ("fs_reads_bytes_total", "", name, None, F.coalesce(F.sum("cents"), F.lit(0)), 100.0),
        ("fs_writes_bytes_total", "", name, None, n * F.lit(512), 1.0),
    ]
    e += [("feed_errors_total", "", _lab(error_type=F.lit(c)), None,
           F.count_if(F.col("feed_error") == c), 1.0) for c in FEED_ERRORS]
    e += [("consumer_rejects_total", "", _lab(error_type=F.lit(c)), None,
           F.count_if(F.col("consumer_error") == c), 1.0) for c in CONSUMER_ERRORS]
    e += [("time_request_errors_total", "", _lab(), None, F.count_if("request_failed"), 1.0)]
    return e


def _gauge_entries():
    """(family, labels, aggregate value, observation time, mode): 'last' keeps
    the latest observation, 'sum' adds observations of the same scrape."""
    last_t = F.max("binance_timestamp")
    return [
        ("memory_working_set_bytes", _lab(name=F.col("symbol")),
         F.max_by("user_id", "binance_timestamp").cast("double"), last_t, "last"),
        ("clock_skew_seconds", _lab(), F.max_by("skew", "binance_timestamp"), last_t, "last"),
        ("api_round_trip_seconds", _lab(), F.max_by("rtt", "binance_timestamp"), last_t, "last"),
        ("partition_lag", _lab(partition=F.col("partition").cast("string")),
         F.count(F.lit(1)).cast("double"), last_t, "sum"),
    ]


def scrape_rows(events: DataFrame, grid: Grid, messages: Messages = Messages()) -> DataFrame:
    """Events -> per-event columns every series needs (one projection)."""
    # k in 1..K  <=>  origin < ts <= origin + K*step: stated on ``ts`` so the
    # range reaches the parquet reader.
    lo, hi = _ntz(grid.origin), _ntz(grid.end)
    events = events.where((F.col("ts") > F.expr(lo)) & (F.col("ts") <= F.expr(hi)))
    t = ticks_from_events(events)
    t = t.withColumn("k", scrape_of(F.col("binance_timestamp"), grid.origin, grid.step))
    bts, rts, sts = F.col("binance_timestamp"), F.col("received_timestamp"), F.col("stored_timestamp")
    before = bts / F.lit(1000.0)
    after = before + F.lit(5) + F.col("event_id") % 40
    server = F.floor(before) + (F.col("event_id") * 31) % 20
    # Each message is built and parsed once, in its own projection.
    t = N.with_envelope_maps(t.withColumn("_env", messages.envelope()), F.col("_env"))
    t = N.with_value_map(t.withColumn("_cval", messages.value()), F.col("_cval"))
    t = t.withColumn("prod_us", messages.sent() - rts).withColumn("proc_us", sts - messages.started())
    feed_error = N.envelope_fields(F.col("_env_top"), F.col("_env_data"))[0]
    return t.select(
        "symbol", "k", "event_id", "user_id", "partition", "binance_timestamp",
        F.round(F.col("price") * F.lit(100.0)).cast("long").alias("cents"),
        (sts - bts).alias("e2e_us"), (rts - bts).alias("net_us"),
        F.when(F.coalesce(rts, F.lit(0)) != 0, sts - rts).alias("sys_us"),
        L.e2e_latency(sts, bts).alias("e2e"), L.network_latency(rts, bts).alias("net"),
        L.system_latency(sts, rts).alias("sys"), "prod_us", "proc_us",
        (F.col("prod_us") / F.lit(L.MICROS)).alias("prod"), (F.col("proc_us") / F.lit(L.MICROS)).alias("proc"),
        L.clock_skew(before, after, server).alias("skew"), L.round_trip(before, after).alias("rtt"),
        feed_error.alias("feed_error"), messages.request_failed().alias("request_failed"),
        N.price_record_error(messages.key(), F.col("_obj")).alias("consumer_error"),
    )


def _with_texts(wide: DataFrame, label_sets) -> tuple[DataFrame, Callable[[Column], Column]]:
    """``wide`` with the series text of every label set, and the look-up of a set's
    text: JSON is made once per row of ``wide``, not once per increment taken from it."""
    names = {key: f"_l{i}" for i, key in enumerate(dict.fromkeys(id(x) for x in label_sets))}
    wide = wide.withColumns({names[id(x)]: series_key(x) for x in label_sets})
    return wide, lambda x: F.col(names[id(x)]).alias("series")


def increments(events: DataFrame, alerts_df: DataFrame | None, grid: Grid,
               messages: Messages = Messages()) -> DataFrame:
    """One aggregation per (symbol, k) -> counter increments and gauge
    observations in one long frame (``kind`` 'c' / 'g', labels as their ``series``
    text): a single ``inline`` over the aggregated row, never split into branches,
    so the events are scanned and aggregated once."""
    rows = scrape_rows(events, grid, messages)
    ce, ge = _counter_entries(), _gauge_entries()
    aggs = [e[4].alias(f"_c{i}") for i, e in enumerate(ce)]
    aggs += [x for i, (_, _, v, ot, _) in enumerate(ge) for x in (v.alias(f"_g{i}"), ot.alias(f"_o{i}"))]
    wide, series = _with_texts(rows.groupBy("symbol", "partition", "k").agg(*aggs),
                               [e[2] for e in ce] + [e[1] for e in ge])
    none_l, none_d = F.lit(None).cast("long"), F.lit(None).cast("double")
    structs = [F.struct(F.lit("c").alias("kind"), F.lit(f).alias("family"), F.lit(p).alias("part"),
                        series(lab), F.lit(le).cast("double").alias("le"),
                        F.col(f"_c{i}").cast("long").alias("inc"), F.lit(float(sc)).alias("scale"),
                        none_d.alias("value"), none_l.alias("obs"), F.lit(None).cast("string").alias("mode"))
               for i, (f, p, lab, le, _, sc) in enumerate(ce)]
    structs += [F.struct(F.lit("g").alias("kind"), F.lit(f).alias("family"), F.lit("").alias("part"),
                         series(lab), none_d.alias("le"), none_l.alias("inc"), none_d.alias("scale"),
                         F.col(f"_g{i}").cast("double").alias("value"), F.col(f"_o{i}").alias("obs"),
                         F.lit(mode).alias("mode"))
                for i, (f, lab, _, _, mode) in enumerate(ge)]
    long = wide.select("k", F.inline(F.array(*structs)))
    if alerts_df is not None:
        a = alerts_df.withColumn("k", scrape_of(epoch_micros("window_end"), grid.origin, grid.step)) \
            .where(F.col("k").between(grid.first, grid.last))
        a = a.withColumn("invalid", messages.alert_invalid()).withColumn("us", messages.alert_us())
        of_alert, of_type = _lab(symbol=F.col("symbol")), _lab(alert_type=F.col("alert_type"), symbol=F.col("symbol"))
        of_reject, of_all = _lab(error_type=F.lit("invalid_message")), _lab()
        steps = _hist("alert_processing_seconds", F.col("us") / F.lit(L.MICROS), F.col("us"), of_alert,
                      BOUNDS_ALERT_PROCESSING)
        a, text = _with_texts(a.groupBy("alert_type", "symbol", "k").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("invalid").alias("bad"),
            *[e[4].alias(f"_s{i}") for i, e in enumerate(steps)]), [of_alert, of_type, of_reject, of_all])

        def counter(family, labels, inc, part="", le=None, scale=1.0):
            return F.struct(F.lit("c").alias("kind"), F.lit(family).alias("family"), F.lit(part).alias("part"),
                            text(labels), F.lit(le).cast("double").alias("le"), inc.cast("long").alias("inc"),
                            F.lit(float(scale)).alias("scale"),
                            none_d.alias("value"), none_l.alias("obs"), F.lit(None).cast("string").alias("mode"))

        lag = F.struct(F.lit("g").alias("kind"), F.lit("alert_lag").alias("family"), F.lit("").alias("part"),
                       text(of_all), none_d.alias("le"), none_l.alias("inc"), none_d.alias("scale"),
                       F.col("n").cast("double").alias("value"), F.col("k").alias("obs"), F.lit("sum").alias("mode"))
        long = long.unionByName(a.select("k", F.inline(F.array(
            counter("alerts_total", of_type, F.col("n")),
            counter("alert_rejects_total", of_reject, F.col("bad")), lag,
            *[counter(f, lab, F.col(f"_s{i}"), p, le, sc) for i, (f, p, lab, le, _, sc) in enumerate(steps)]))))
    return long


_FILL_KEYS = ["kind", "family", "part", "series", "le"]


def per_scrape(long: DataFrame) -> DataFrame:
    """One row per (series, scrape) of ``increments`` (or of increments with label maps). Combined map-side: a series
    without a symbol label (clock gauges, error counters) gets a row per (symbol,
    scrape), which never meet in one task unaggregated."""
    from candlewick.operators.series import series_id
    u = long.withColumn("additive", F.coalesce((F.col("mode") == "sum").cast("int"), F.lit(0)))
    per_k = with_series(u).groupBy(*_FILL_KEYS, "k").agg(
        F.sum("inc").alias("inc"), F.first("scale").alias("scale"),
        F.max_by("value", "obs").alias("last"), F.sum("value").alias("total"),
        F.max("additive").alias("additive"))
    gval = F.when(F.col("additive") == 1, F.col("total")).otherwise(F.col("last"))
    return per_k.withColumn("gval", gval).where((F.col("kind") == "c") | F.col("gval").isNotNull()) \
        .select(series_id(*_FILL_KEYS).alias("_sk"), *_FILL_KEYS, "k", "inc", "scale", "gval")


def cumulative(long: DataFrame, grid: Grid, block: int = BLOCK_POINTS) -> DataFrame:
    """Counter increments and gauge observations on the scrape grid, exact: kind,
    family, part, series, labels, le, k, cum (whole units, ``scale`` of them to one), gval.
    The samples carry only their series' key until they meet the blocks, which have the
    rest: the label maps are read from the series' texts once per block, not per sample.

    Counters: running sum from the first scrape (zeros before the first event).
    Gauges: the last observation repeated until the next one."""
    checkpoint_root(long.sparkSession)
    # read twice below: the small per-scrape table is cut off from the events
    rows = per_scrape(long).withColumn("_b", F.floor(F.col("k") / F.lit(block)).cast("long")).checkpoint()
    blocks = rows.groupBy("_sk", *_FILL_KEYS, "_b").agg(F.sum("inc").alias("inc"), F.min("k").alias("k"), F.max("inc").alias("most"))
    over = Window.partitionBy("_sk").orderBy("_b")          # one row per block of a series
    whole = Window.partitionBy("_sk")
    blocks = blocks.select(
        "_sk", "_b", *_FILL_KEYS, labels_of(F.col("series")).alias("labels"),
        F.sum("inc").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.lead("k").over(over).alias("_next"), F.min("k").over(whole).alias("k0"), F.max("most").over(whole).alias("used"))
    w = Window.partitionBy("_sk", "_b").orderBy("k")
    is_c = F.col("kind") == "c"
    # windowed before the join: one sort of the narrow samples serves both
    x = (rows.drop(*_FILL_KEYS)
         .withColumn("_within", F.sum("inc").over(w)).withColumn("_after", F.lead("k").over(w))
         .join(blocks, ["_sk", "_b"])
         .withColumn("cum", F.coalesce("_before", F.lit(0)) + F.col("_within"))
         .withColumn("nk", F.coalesce("_after", "_next")))
    x = x.where(~(is_c & F.col("family").isin(*ON_FIRST_USE)) | (F.col("used") > 0))
    lo = F.when(is_c & (F.col("k") == F.col("k0")), F.lit(1)).otherwise(F.col("k"))
    hi = F.coalesce(F.col("nk") - 1, F.lit(grid.last))
    e = x.select("_sk", *_FILL_KEYS, "labels", "k", "cum", "scale", "gval", F.explode(F.sequence(lo, hi)).alias("kk"))
    return e.select("_sk", *_FILL_KEYS, "labels", "scale", "gval", F.col("kk").alias("k"),
                    F.when(F.col("kk") < F.col("k"), F.lit(0)).otherwise(F.col("cum")).alias("cum"))


def as_samples(exact: DataFrame, grid: Grid) -> DataFrame:
    """``cumulative`` -> kind ('c' counter / 'g' gauge), family, part, labels, series,
    le, ts, value."""
    value = F.when(F.col("kind") == "c", F.col("cum").cast("double") / F.col("scale")).otherwise(F.col("gval"))
    return exact.select("kind", "family", "part", "labels", "series", "le",
                        grid.t(F.col("k")).alias("ts"), value.alias("value"))


def fill_grid(long: DataFrame, grid: Grid, block: int = BLOCK_POINTS) -> DataFrame:
    """Counter increments + gauge observations (``increments``) -> samples on the grid."""
    return as_samples(cumulative(long, grid, block), grid)


def source_samples(events: DataFrame, alerts_df: DataFrame | None = None,
                   grid: Grid | None = None) -> DataFrame:
    """All derived series, long form: kind, family, part, labels, series, le, ts, value."""
    grid = grid or scrape_grid(events)
    return fill_grid(increments(events, alerts_df, grid), grid)


def split(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(counter samples, gauge samples) by family, so a family-partitioned
    store is pruned rather than filtered."""
    gf = F.col("family").isin(*GAUGE_FAMILIES)
    cols = ["family", "part", "labels", "series", "le", "ts", "value"]
    return samples.where(~gf).select(*cols), samples.where(gf).select(*cols)


def source_series(events: DataFrame, alerts_df: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(counter samples, gauge samples) derived from the events (+ alerts)."""
    return split(source_samples(events, alerts_df))
