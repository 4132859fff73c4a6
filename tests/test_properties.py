"""Property tests: random inputs against plain-Python brute force."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings, strategies as st

from candlewick.operators.candles import candles
from candlewick.operators.quantiles import exact_quantiles

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

ticks_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 600), st.floats(0.0, 100.0, width=32)),
    min_size=1, max_size=60, unique_by=lambda x: (x[0], x[1]))


@SETTINGS
@given(ticks_st)
def test_candles_match_brute_force(spark, rows):
    df = spark.createDataFrame(
        [(s, T0 + dt.timedelta(seconds=sec), float(p), sec) for s, sec, p in rows],
        "symbol string, event_time timestamp_ntz, price double, binance_timestamp long")
    got = {(r.symbol, r.window_start): (r.open_price, r.close_price) for r in candles(df, "1 minute").collect()}
    want = {}
    for s, sec, p in rows:
        key = (s, T0 + dt.timedelta(seconds=sec - sec % 60))
        lo, hi = want.get(key, ((math.inf, None), (-math.inf, None)))
        lo = min(lo, (sec, float(p)))
        hi = max(hi, (sec, float(p)))
        want[key] = (lo, hi)
    assert got == {k: (lo[1], hi[1]) for k, (lo, hi) in want.items()}


values_st = st.lists(st.tuples(st.sampled_from(["x", "y"]),
                               st.one_of(st.integers(-5, 5).map(float), st.floats(-1e3, 1e3, width=32))),
                     min_size=1, max_size=120)


@SETTINGS
@given(values_st, st.integers(3, 50))
def test_exact_quantiles_match_brute_force(spark, rows, limit):
    df = spark.createDataFrame([(k, float(v)) for k, v in rows], "symbol string, v double")
    got = {r.symbol: (r.p50, r.p95, r.p99)
           for r in exact_quantiles(df, "v", limit=limit, accuracy=50).collect()}
    for k in {k for k, _ in rows}:
        vals = sorted(float(v) for kk, v in rows if kk == k)
        want = tuple(vals[max(1, math.ceil(q * len(vals))) - 1] for q in (0.5, 0.95, 0.99))
        assert got[k] == want


def py_bucket_quantile(q, buckets):
    """Plain-Python histogram quantile over (le, cumulative count) pairs."""
    if q < 0:
        return -math.inf
    if q > 1:
        return math.inf
    b = sorted(buckets)
    if len(b) < 2 or b[-1][0] != math.inf:
        return math.nan
    mono, top = [], -math.inf
    for le, r in b:
        top = max(top, r)
        mono.append((le, top))
    total = mono[-1][1]
    if total == 0 or math.isnan(total):
        return math.nan
    rank = q * total
    i = next(i for i, (_, r) in enumerate(mono) if r >= rank)
    if i == len(mono) - 1:
        return mono[-2][0]
    le, r = mono[i]
    if i == 0 and le <= 0:
        return le
    lo, r_lo = (mono[i - 1][0], mono[i - 1][1]) if i > 0 else (0.0, 0.0)
    return lo + (le - lo) * ieee_div(rank - r_lo, r - r_lo)


def ieee_div(a, b):
    if b != 0:
        return a / b
    return math.nan if a == 0 else math.copysign(math.inf, a)


bucket_sets = st.lists(
    st.tuples(st.sampled_from([0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 5.0, math.inf]), st.integers(0, 50).map(float)),
    min_size=1, max_size=8, unique_by=lambda x: x[0])


@SETTINGS
@given(st.lists(bucket_sets, min_size=1, max_size=6), st.sampled_from([0.0, 0.25, 0.5, 0.9, 0.99, 1.0]))
def test_bucket_quantile_matches_python(spark, sets, q):
    from candlewick.operators.series import bucket_quantile
    rows = [(t, float(le), float(r)) for t, bs in enumerate(sets) for le, r in bs]
    df = spark.createDataFrame(rows, "t long, le double, r double")
    got = {r.t: r.value for r in bucket_quantile(df, ["t"], q).collect()}
    for t, bs in enumerate(sets):
        want = py_bucket_quantile(q, bs)
        g = got[t]
        assert (math.isnan(want) and math.isnan(g)) or math.isclose(g, want, rel_tol=1e-12, abs_tol=1e-12), \
            (t, bs, q, g, want)


series_st = st.lists(st.tuples(st.integers(0, 400), st.integers(0, 30)), min_size=1, max_size=40,
                     unique_by=lambda x: x[0])


def _frame(spark, pts):
    rows = [("c", "", {"s": "a"}, None, float(ts), float(v)) for ts, v in pts]
    return spark.createDataFrame(rows, "family string, part string, labels map<string,string>, le double, "
                                       "ts double, value double")


@SETTINGS
@given(series_st, st.integers(10, 120))
def test_range_rate_matches_python(spark, pts, rng):
    from candlewick.operators.series import Grid, range_rate
    from tests.test_series import py_rate
    grid = Grid(0, 7, 0, 70)
    got = {r.t: r.value for r in range_rate(_frame(spark, pts), rng, grid).collect()}
    want = {}
    for j in range(grid.first, grid.last + 1):
        r = py_rate([(float(t), float(v)) for t, v in pts], j * 7, rng)
        if r is not None:
            want[j * 7] = r
    assert set(got) == set(want)
    assert all(math.isclose(got[t], want[t], rel_tol=1e-9, abs_tol=1e-12) for t in want)


@SETTINGS
@given(series_st, st.integers(5, 100))
def test_asof_matches_python(spark, pts, lookback):
    from candlewick.operators.series import Grid, asof
    grid = Grid(0, 7, 0, 70)
    got = {r.t: r.value for r in asof(_frame(spark, pts), lookback, grid).collect()}
    want = {}
    for j in range(grid.first, grid.last + 1):
        t = j * 7
        seen = [(ts, v) for ts, v in pts if t - lookback < ts <= t]
        if seen:
            want[t] = float(max(seen)[1])
    assert got == want
