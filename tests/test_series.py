"""Rate, quantile and as-of operators against an independent plain-Python evaluator."""

import math

import pytest
import random


from candlewick.operators import series as SE

INF = float("inf")


def py_rate(samples, t, rng):
    """Plain-Python extrapolated rate over (t - rng, t] for one series."""
    pts = sorted((ts, v) for ts, v in samples if t - rng < ts <= t)
    if len(pts) < 2:
        return None
    inc = pts[-1][1] - pts[0][1]
    for (_, a), (_, b) in zip(pts, pts[1:]):
        if b < a:
            inc += a
    t0, v0 = pts[0]
    t1 = pts[-1][0]
    si = t1 - t0
    av = si / (len(pts) - 1)
    ds = t0 - (t - rng)
    if ds >= av * 1.1:
        ds = av / 2
    if inc > 0 and v0 >= 0:
        ds = min(ds, si * (v0 / inc))
    de = t - t1
    if de >= av * 1.1:
        de = av / 2
    return inc * (si + ds + de) / si / rng


def frame(spark, series):
    rows = []
    for name, pts in series.items():
        for ts, v in pts:
            rows.append(("c", "", {"s": name}, None, float(ts), float(v)))
    return spark.createDataFrame(rows, "family string, part string, labels map<string,string>, le double, "
                                       "ts double, value double")


def test_rate_matches_python(spark):
    rnd = random.Random(7)
    series = {}
    for name in ("a", "b", "c"):
        v, ts, pts = 0.0, 1000.0, []
        for i in range(300):
            ts += 5 + rnd.choice([-1, 0, 0, 1])  # jittered scrapes
            if rnd.random() < 0.05:
                continue                          # gaps
            v = 0.0 if rnd.random() < 0.02 else v + rnd.randint(0, 9)   # resets
            pts.append((ts, v))
        series[name] = pts
    series["single"] = [(1500.0, 3.0)]           # one sample -> never a point
    grid = SE.Grid(0, 5, 200, 600)
    got = {(r.labels["s"], r.t): r.value for r in SE.range_rate(frame(spark, series), 60, grid).collect()}
    want = {}
    for name, pts in series.items():
        for j in range(grid.first, grid.last + 1):
            t = grid.origin + j * grid.step
            r = py_rate(pts, t, 60)
            if r is not None:
                want[(name, t)] = r
    assert set(got) == set(want)
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)
    assert not any(k[0] == "single" for k in got)


def buckets(spark, rows):
    return spark.createDataFrame(rows, "t long, le double, r double")


def test_quantile_edges(spark):
    rows = [(1, 0.1, 0.0), (1, 1.0, 0.0), (1, INF, 0.0),        # all zero -> NaN
            (2, 0.1, 0.0), (2, 1.0, 0.0), (2, INF, 5.0),        # +Inf only -> largest finite
            (3, 0.1, 4.0), (3, 1.0, 4.0), (3, INF, 4.0),        # first bucket -> from 0
            (4, 0.1, 1.0), (4, 1.0, 3.0), (4, INF, 4.0),        # interpolation
            (5, 0.1, 1.0), (5, 1.0, 3.0)]                       # no +Inf bucket -> NaN
    out = {r.t: r.value for r in SE.bucket_quantile(buckets(spark, rows), ["t"], 0.5).collect()}
    assert math.isnan(out[1]) and math.isnan(out[5])
    assert out[2] == 1.0
    assert math.isclose(out[3], 0.05)
    assert math.isclose(out[4], 0.1 + 0.9 * (2.0 - 1.0) / (3.0 - 1.0))


def test_quantile_non_monotonic_fixed(spark):
    rows = [(1, 0.1, 2.0), (1, 0.5, 1.9), (1, 1.0, 4.0), (1, INF, 4.0)]
    v = SE.bucket_quantile(buckets(spark, rows), ["t"], 0.25).first().value
    assert math.isclose(v, 0.1 * 1.0 / 2.0)


def test_asof_lookback_and_next_sample(spark):
    rows = [("g", "", {}, None, 10.0, 1.0), ("g", "", {}, None, 30.0, 2.0)]
    df = spark.createDataFrame(rows, "family string, part string, labels map<string,string>, le double, "
                                     "ts double, value double")
    grid = SE.Grid(0, 5, 0, 20)
    got = {r.t: r.value for r in SE.asof(df, 15, grid).collect()}
    # 10 serves 10..20 (until 25 would exceed lookback), 30 serves 30..40
    assert got == {10: 1.0, 15: 1.0, 20: 1.0, 30: 2.0, 35: 2.0, 40: 2.0}


def test_rate_mean_nan_is_a_point(spark):
    rows = [(1, "sum", 0.0), (1, "count", 0.0), (2, "sum", 1.0), (2, "count", 4.0), (3, "sum", 1.0)]
    df = spark.createDataFrame(rows, "t long, part string, value double")
    got = {r.t: r.value for r in SE.rate_mean(df).collect()}
    assert set(got) == {1, 2} and math.isnan(got[1]) and got[2] == 0.25


def test_no_range_join_in_plan(spark):
    series = {"a": [(float(t), float(t)) for t in range(0, 600, 5)]}
    plan = SE.range_rate(frame(spark, series), 60, SE.Grid(0, 5, 0, 100))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_ratio_one_to_one(spark):
    num = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, 1.0)], "t long, value double")
    den = spark.createDataFrame([(1, 4.0), (2, 0.0), (4, 1.0)], "t long, value double")
    got = {r.t: r.value for r in SE.ratio(num, den).collect()}
    assert set(got) == {1, 2} and got[1] == 0.5 and math.isnan(got[2])


def test_rate_invariant_to_row_order_and_partitioning(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(3)
    series = {n: [(float(1000 + 5 * i), float(i * rnd.randint(1, 3))) for i in range(200)] for n in "xyz"}
    grid = SE.Grid(0, 5, 200, 400)
    base = frame(spark, series)
    a = sorted((r.labels["s"], r.t, r.value) for r in SE.range_rate(base, 60, grid).collect())
    shuffled = base.repartition(11).orderBy(F.rand(5))
    b = sorted((r.labels["s"], r.t, r.value) for r in SE.range_rate(shuffled, 60, grid).collect())
    assert a == b


def test_since_keeps_the_retention_horizon(spark):
    import datetime as dt
    from candlewick.sources.streams import since
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, t0 + dt.timedelta(minutes=i)) for i in range(60)],
                               "id long, event_time timestamp_ntz")
    kept = sorted(r.id for r in since(df, 15).collect())
    assert kept == list(range(44, 60))   # max is minute 59; minute 44 is exactly 15 minutes before


def _disc(vals, q):
    s = sorted(vals)
    return s[max(1, math.ceil(q * len(s))) - 1]


@pytest.mark.parametrize("limit", [10_000, 40])
def test_exact_quantiles_against_brute_force(spark, limit):
    from candlewick.operators.quantiles import exact_quantiles
    rnd = random.Random(11)
    rows = []
    for k, n in (("hot", 3000), ("cold", 50), ("dup", 600), ("one", 1)):
        for _ in range(n):
            if k == "dup":
                v = 7.0 if rnd.random() < 0.8 else rnd.random()      # a heavy duplicate run
            else:
                v = rnd.random() * 100
            rows.append((k, v))
    df = spark.createDataFrame(rows, "symbol string, v double")
    got = {r.symbol: (r.p50, r.p95, r.p99) for r in exact_quantiles(df, "v", limit=limit, accuracy=200).collect()}
    for k in ("hot", "cold", "dup", "one"):
        vals = [v for s, v in rows if s == k]
        assert got[k] == tuple(_disc(vals, q) for q in (0.5, 0.95, 0.99)), k


def test_sketch_quantiles_exact_for_small_groups(spark):
    from candlewick.operators.histogram import quantiles
    rows = [("a", float(i)) for i in range(1, 101)]
    r = quantiles(spark.createDataFrame(rows, "symbol string, v double"), "v").first()
    assert (r.p50, r.p95, r.p99) == (50.0, 95.0, 99.0)


def test_exact_quantiles_null_key_is_a_group(spark):
    from candlewick.operators.quantiles import exact_quantiles
    rows = [(None, float(i)) for i in range(1, 101)] + [("a", float(i)) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "symbol string, v double")
    got = {r.symbol: r.p50 for r in exact_quantiles(df, "v", qs=(0.5,), limit=20, accuracy=100).collect()}
    assert got == {None: 50.0, "a": 5.0}


def test_bare_gauge_keeps_series_apart_and_export_refuses_it(spark):
    from candlewick.operators.export import single_series
    from candlewick.operators.metrics import evaluate
    from candlewick.plans.catalog import Spec
    rows = [("g", "", {"name": n}, None, float(ts), v) for n, v in (("a", 1.0), ("b", 2.0)) for ts in (10, 20)]
    gauges = spark.createDataFrame(rows, "family string, part string, labels map<string,string>, le double, "
                                         "ts double, value double")
    counters = gauges.limit(0)
    specs = [Spec("c", "bare", "gauge", "fam"), Spec("c", "total", "gauge_sum", "fam")]
    out = evaluate(spark, counters, gauges, SE.Grid(0, 10, 1, 2), 60, 30, specs=specs,
                   mapping=[("fam", "g", ())])
    got = sorted((r.metric, r.by_value, r.t, r.value) for r in out.collect())
    a, b = ('[{"key":"name","value":"%s"}]' % n for n in "ab")
    assert got == [("c_bare", a, 10, 1.0), ("c_bare", a, 20, 1.0), ("c_bare", b, 10, 2.0), ("c_bare", b, 20, 2.0),
                   ("c_total", "", 10, 3.0), ("c_total", "", 20, 3.0)]
    with pytest.raises(ValueError):
        single_series(out.where("metric = 'c_bare'"))
    single_series(out.where("metric = 'c_total'"))


def test_blocks_give_what_the_whole_series_gives(spark):
    """Rates, as-of lookups and grid filling in blocks of any length, over jittered
    samples with gaps and resets."""
    import random
    from candlewick.sources.samples import cumulative
    rnd = random.Random(8)
    rows = []
    for s in ("a", "b"):
        t, v = 1000, 0.0
        for _ in range(300):
            t += rnd.choice([1, 4, 5, 5, 6, 5, 40 if rnd.random() < 0.1 else 5])
            v = 0.0 if rnd.random() < 0.03 else v + rnd.randint(0, 5)
            rows.append(("f", "", {"s": s}, None, t, v))
    df = spark.createDataFrame(rows, "family string, part string, labels map<string,string>, le double, ts long, "
                                     "value double").repartition(4)
    grid = SE.Grid(1000, 5, 1, 400)

    def of(x):
        return sorted((r.series, r.t, r.value) for r in x.collect())

    for f, width in ((SE.range_rate, 60), (SE.asof, 30)):
        whole = of(f(df, width, grid, block=10 ** 6))
        assert len(whole) > 300
        for block in (1, 7, 64):
            assert of(f(df, width, grid, block=block)) == whole
    inc = [("c", "f", "", {"s": s}, None, k, rnd.randint(0, 3), 1.0, None, None, None)
           for s in ("a", "b") for k in sorted(rnd.sample(range(1, 200), 40))]
    inc += [("g", "h", "", {"s": "a"}, None, k, None, None, float(k), k, "last") for k in (3, 50, 51, 170)]
    long = spark.createDataFrame(inc, "kind string, family string, part string, labels map<string,string>, le double, "
                                      "k long, inc long, scale double, value double, obs long, mode string")
    filled = [sorted((r.family, r.series, r.k, r.cum, r.gval) for r in cumulative(long, SE.Grid(0, 5, 1, 200), block).collect())
              for block in (10 ** 6, 3, 50)]
    assert len(filled[0]) > 500 and filled[1] == filled[0] and filled[2] == filled[0]
