"""DuckDB formulation of the metric samples and their evaluation.

Independent of the Spark path on purpose: labels are plain columns, a rate
is evaluated with a band join of the grid against the samples, an as-of
lookup with a band join + arg_max, and quantiles with window functions.
"""

from __future__ import annotations

from candlewick.config import (BOUNDS_ALERT_PROCESSING, BOUNDS_E2E_LATENCY, BOUNDS_NETWORK_LATENCY,
                               BOUNDS_PRICE_PROCESSING, BOUNDS_PRODUCER_LATENCY, BOUNDS_SYSTEM_LATENCY,
                               FIXTURE_LOOKBACK, FIXTURE_RANGE, FIXTURE_STEP)
from candlewick.plans import sql as S
from candlewick.plans.catalog import ALL_SPECS, FAMILY_SOURCES, GAUGE_SOURCES

STEP, R, LB = FIXTURE_STEP, FIXTURE_RANGE, FIXTURE_LOOKBACK
# The scrape grid covers the events: its origin and its last scrape are in ``s_g``.
O, K = "(SELECT o FROM s_g)", "(SELECT k FROM s_g)"
SCRAPES = f"(SELECT unnest(range(1, {K} + 1)) AS k)"
GRID_CTE = f"""s_g AS (SELECT o, z // {STEP * 1_000_000} + 1 - o // {STEP} AS k FROM (
    SELECT ((min(epoch_us(ts)) - 1) // {STEP * 1_000_000}) * {STEP} AS o, max(epoch_us(ts)) AS z FROM events))"""
LABELS = ("symbol", "name", "error_type", "alert_type", "pno")
SER = ("family", "part", "le") + LABELS


def _kexpr(us: str) -> str:
    return f"CAST(ceil(({us} - {O} * 1000000) / {float(STEP) * 1_000_000!r}) AS BIGINT)"


def _sel(family, part, le, inc, group, src="s_tk", scale=1.0, **labels):
    cols = {c: labels.get(c, "NULL") for c in LABELS}
    who = labels.get("who", "NULL")
    lab = ", ".join(f"CAST({v} AS VARCHAR) AS {c}" for c, v in cols.items())
    return (f"SELECT '{family}' AS family, '{part}' AS part, CAST({le} AS DOUBLE) AS le, {lab}, "
            f"CAST({who} AS VARCHAR) AS who, k, CAST({inc} AS BIGINT) AS inc, {scale!r} AS scale "
            f"FROM {src} GROUP BY {group}")


def _hist(family, col, bounds, src="s_tk"):
    les = ", ".join(f"({b!r})" for b in bounds) + ", ('inf'::DOUBLE)"
    sym = dict(symbol="symbol", who="symbol")
    return [
        _sel(family, "bucket", "b.le", f"count({col}) FILTER (WHERE {col} <= b.le)", "symbol, k, b.le",
             src=f"{src} CROSS JOIN (VALUES {les}) b(le)", **sym),
        _sel(family, "sum", "NULL", f"coalesce(sum({col}_us), 0)", "symbol, k", src=src, scale=1e6, **sym),
        _sel(family, "count", "NULL", f"count({col})", "symbol, k", src=src, **sym),
    ]


def samples_ctes(alerts_sql: str) -> str:
    """CTEs ending in ``samples(family, part, le, <labels>, who, ts, value)``."""
    incs = [_sel("ticks_total", "", "NULL", "count(*)", "symbol, k", symbol="symbol", who="symbol")]
    incs += _hist("e2e_latency_seconds", "e2e", BOUNDS_E2E_LATENCY)
    incs += _hist("network_latency_seconds", "net", BOUNDS_NETWORK_LATENCY)
    incs += _hist("system_latency_seconds", "sys", BOUNDS_SYSTEM_LATENCY)
    incs += _hist("producer_latency_seconds", "prod", BOUNDS_PRODUCER_LATENCY)
    incs += _hist("processing_latency_seconds", "proc", BOUNDS_PRICE_PROCESSING)
    incs += _hist("alert_processing_seconds", "took", BOUNDS_ALERT_PROCESSING, src="s_alerts")
    nm = dict(name="symbol", who="symbol")
    incs += [
        _sel("cpu_seconds_total", "", "NULL", "coalesce(sum(cents), 0)", "symbol, k", scale=100000.0, **nm),
        _sel("network_receive_bytes_total", "", "NULL", "coalesce(sum(user_id), 0)", "symbol, k", **nm),
        _sel("network_transmit_bytes_total", "", "NULL", "count(*)", "symbol, k", **nm),
        _sel("fs_reads_bytes_total", "", "NULL", "coalesce(sum(cents), 0)", "symbol, k", scale=100.0, **nm),
        _sel("fs_writes_bytes_total", "", "NULL", "count(*) * 512", "symbol, k", **nm),
        _sel("feed_errors_total", "", "NULL", "count(*)", "error_type, k", src="s_feed", error_type="error_type"),
        _sel("consumer_rejects_total", "", "NULL", "count(*)", "error_type, k", src="s_cons",
             error_type="error_type"),
        _sel("time_request_errors_total", "", "NULL", "count(*)", "k", src="s_probe_fail"),
        _sel("alerts_total", "", "NULL", "count(*)", "alert_type, symbol, k", src="s_alerts",
             alert_type="alert_type", symbol="symbol", who="symbol"),
        _sel("alert_rejects_total", "", "NULL", "count(*)", "error_type, k", error_type="error_type",
             src="(SELECT k, 'invalid_message' AS error_type FROM s_alerts WHERE hr % 53 = 0)"),
    ]
    inc_sql = "\n    UNION ALL ".join(incs)
    on = " AND ".join(f"x.{c} IS NOT DISTINCT FROM i.{c}" for c in SER)
    part_by = ", ".join(f"i.{c}" for c in SER)
    part_by2 = ", ".join(SER)
    gaps = "NOT (coalesce(who, '') = 'view' AND k % 50 BETWEEN 1 AND 6)"
    gon = " AND ".join(f"o.{c} IS NOT DISTINCT FROM i.{c}" for c in ("family",) + LABELS)
    gpart = ", ".join(f"i.{c}" for c in ("family",) + LABELS)
    return f"""
{GRID_CTE},
s_t AS (SELECT t.*, e.user_id FROM ({S.TICKS}) t JOIN events e USING (event_id)),
s_t2 AS (SELECT *, sts - bts AS e2e_us, rts - bts AS net_us, CASE WHEN rts <> 0 THEN sts - rts END AS sys_us,
           (sts - bts) / 1e6 AS e2e, (rts - bts) / 1e6 AS net,
           CASE WHEN rts <> 0 THEN (sts - rts) / 1e6 END AS sys,
           CAST(round(price * 100.0) AS BIGINT) AS cents, {_kexpr('bts')} AS k FROM s_t),
s_tk AS (SELECT *, (sts - rts) * (10 + event_id * 7 % 40) // 100 AS prod_us, prod_us / 1e6 AS prod,
           (sts - rts) * (5 + event_id * 11 % 30) // 100 AS proc_us, proc_us / 1e6 AS proc
         FROM s_t2 WHERE k BETWEEN 1 AND {K}),
s_feed AS (SELECT * FROM (
    SELECT {_kexpr('epoch_us(ts)')} AS k,
      CASE WHEN event_id % 97 = 0 THEN 'json_decode' WHEN event_id % 89 = 0 THEN 'processing'
           WHEN event_id % 83 = 0 THEN 'processing' WHEN event_id % 79 = 0 THEN 'ignored'
           WHEN value IS NULL OR ts IS NULL THEN 'processing' END AS error_type
    FROM events) WHERE error_type IS NOT NULL AND error_type <> 'ignored' AND k BETWEEN 1 AND {K}),
s_cons AS (SELECT * FROM (
    SELECT {_kexpr('bts')} AS k,
      CASE WHEN event_id % 71 = 0 OR symbol IS NULL OR symbol = '' THEN 'invalid_message'
           WHEN event_id % 67 = 0 OR bts IS NULL THEN 'missing_timestamp' END AS error_type
    FROM s_t) WHERE error_type IS NOT NULL AND k BETWEEN 1 AND {K}),
s_probe_fail AS (SELECT * FROM s_tk WHERE event_id % 40 >= 38),
s_alerts AS (SELECT * FROM (SELECT alert_type, symbol, {_kexpr('epoch_us(window_end)')} AS k,
           epoch_us(window_end) // 3600000000 AS hr, 40 + hr * 7919 % 60000 AS took_us, took_us / 1e6 AS took
    FROM ({alerts_sql})) WHERE k BETWEEN 1 AND {K}),
s_inc AS (
    {inc_sql}),
s_ids AS (SELECT DISTINCT family, part, le, {', '.join(LABELS)}, who, scale FROM s_inc),
s_cum AS (
  SELECT i.*, g.k, sum(coalesce(x.inc, 0)) OVER (PARTITION BY {part_by} ORDER BY g.k
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
  FROM s_ids i CROSS JOIN {SCRAPES} g
  LEFT JOIN s_inc x ON {on} AND x.k = g.k),
s_ctr AS (
  SELECT *, CAST(CASE WHEN who = 'click' THEN cum - coalesce(max(CASE WHEN k % 100 = 0 THEN cum END)
            OVER (PARTITION BY {part_by2} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
            ELSE cum END AS DOUBLE) / scale AS value
  FROM s_cum),
s_probe AS (
  SELECT k, bts, (b + (a - b) / 2.0 - sv) / 1000.0 AS skew, (a - b) / 1000.0 AS rtt FROM (
    SELECT k, bts, bts / 1000.0 AS b, bts / 1000.0 + 5 + event_id % 40 AS a,
           floor(bts / 1000.0) + (event_id * 31) % 20 AS sv FROM s_tk)),
s_gobs AS (
  SELECT 'memory_working_set_bytes' AS family, NULL::VARCHAR AS symbol, symbol AS name,
         NULL::VARCHAR AS error_type, NULL::VARCHAR AS alert_type, NULL::VARCHAR AS pno, symbol AS who,
         k, CAST(arg_max(user_id, bts) AS DOUBLE) AS value FROM s_tk GROUP BY symbol, k
  UNION ALL SELECT 'clock_skew_seconds', NULL, NULL, NULL, NULL, NULL, NULL, k, arg_max(skew, bts)
    FROM s_probe GROUP BY k
  UNION ALL SELECT 'api_round_trip_seconds', NULL, NULL, NULL, NULL, NULL, NULL, k, arg_max(rtt, bts)
    FROM s_probe GROUP BY k
  UNION ALL SELECT 'partition_lag', NULL, NULL, NULL, NULL, CAST(part AS VARCHAR), NULL, k,
    CAST(count(*) AS DOUBLE) FROM s_tk GROUP BY part, k
  UNION ALL SELECT 'alert_lag', NULL, NULL, NULL, NULL, NULL, NULL, k, CAST(count(*) AS DOUBLE)
    FROM s_alerts GROUP BY k),
s_gids AS (SELECT DISTINCT family, {', '.join(LABELS)}, who FROM s_gobs),
s_gfill AS (
  SELECT i.*, g.k, last_value(o.value IGNORE NULLS) OVER (PARTITION BY {gpart} ORDER BY g.k
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
  FROM s_gids i CROSS JOIN {SCRAPES} g
  LEFT JOIN s_gobs o ON {gon} AND o.k = g.k),
samples AS (
  SELECT family, part, le, {', '.join(LABELS)}, who, {O} + k * {STEP} AS ts, value FROM s_ctr WHERE {gaps}
  UNION ALL
  SELECT family, '' AS part, NULL::DOUBLE AS le, {', '.join(LABELS)}, who, {O} + k * {STEP} AS ts, value
  FROM s_gfill WHERE value IS NOT NULL AND {gaps})"""


def rate_ctes(src: str = "samples", name: str = "rates") -> str:
    """CTEs ending in ``{name}(family, part, le, <labels>, t, value)``: the
    extrapolated rate of every counter series of ``src`` on the grid."""
    lab = ", ".join(LABELS)
    gauge_list = ", ".join(f"'{g}'" for g in sorted(GAUGE_SOURCES))
    return f"""
{name}_lag AS (
  SELECT family, part, le, {lab}, CAST(ts AS DOUBLE) AS ts, value,
         lag(value) OVER w AS pv, CAST(lag(ts) OVER w AS DOUBLE) AS pts
  FROM {src} WHERE family NOT IN ({gauge_list})
  WINDOW w AS (PARTITION BY family, part, le, {lab} ORDER BY ts)),
{name}_grid AS (SELECT CAST({O} + k * {STEP} AS DOUBLE) AS t FROM {SCRAPES}),
{name}_agg AS (
  SELECT family, part, le, {lab}, g.t, count(*) AS n, min(ts) AS t0, max(ts) AS t1,
         arg_min(value, ts) AS v0, arg_max(value, ts) AS v1,
         sum(CASE WHEN pts > g.t - {float(R)!r} AND value < pv THEN pv ELSE 0.0 END) AS resets
  FROM {name}_grid g JOIN {name}_lag l ON l.ts > g.t - {float(R)!r} AND l.ts <= g.t
  GROUP BY family, part, le, {lab}, g.t HAVING count(*) >= 2),
{name}_x AS (
  SELECT *, v1 - v0 + resets AS inc, t1 - t0 AS si, (t1 - t0) / (n - 1) AS av,
         t0 - (t - {float(R)!r}) AS ds0, t - t1 AS de0 FROM {name}_agg),
{name}_y AS (
  SELECT *, CASE WHEN ds0 >= av * 1.1 THEN av / 2 ELSE ds0 END AS ds1,
         CASE WHEN de0 >= av * 1.1 THEN av / 2 ELSE de0 END AS de,
         si * (v0 / inc) AS dz FROM {name}_x),
{name} AS (
  SELECT family, part, le, {lab}, CAST(t AS BIGINT) AS t,
         inc * ((si + CASE WHEN inc > 0 AND v0 >= 0 AND dz < ds1 THEN dz ELSE ds1 END + de) / si
                / {float(R)!r}) AS value
  FROM {name}_y)"""


def asof_ctes(src: str = "samples", name: str = "gpts") -> str:
    lab = ", ".join(LABELS)
    gauge_list = ", ".join(f"'{g}'" for g in sorted(GAUGE_SOURCES))
    return f"""
{name}_grid AS (SELECT {O} + k * {STEP} AS t FROM {SCRAPES}),
{name} AS (
  SELECT family, part, le, {lab}, g.t, arg_max(value, ts) AS value
  FROM {name}_grid g JOIN {src} s ON s.ts > g.t - {LB} AND s.ts <= g.t
  WHERE family IN ({gauge_list})
  GROUP BY family, part, le, {lab}, g.t)"""


def quantile_ctes(src: str, keys: str, name: str = "hq") -> str:
    """``src(keys..., q, le, r)`` -> ``{name}(keys..., value)``: histogram_quantile."""
    return f"""
{name}_m AS (
  SELECT {keys}, q, le, max(r) OVER (PARTITION BY {keys} ORDER BY le
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r FROM {src}),
{name}_w AS (
  SELECT *, lag(le) OVER w AS ple, lag(r) OVER w AS pr, row_number() OVER w AS idx,
         count(*) OVER (PARTITION BY {keys}) AS nb,
         max(CASE WHEN le = 'inf'::DOUBLE THEN r END) OVER (PARTITION BY {keys}) AS total,
         max(CASE WHEN le <> 'inf'::DOUBLE THEN le END) OVER (PARTITION BY {keys}) AS max_finite,
         max(le) OVER (PARTITION BY {keys}) AS top
  FROM {name}_m WINDOW w AS (PARTITION BY {keys} ORDER BY le)),
{name}_all AS (SELECT DISTINCT {keys}, q, nb, total, max_finite, top FROM {name}_w),
{name}_pick AS (
  SELECT {keys}, min(idx) AS idx, arg_min(le, idx) AS le_b, arg_min(r, idx) AS r_b,
         arg_min(coalesce(ple, 0.0), idx) AS lo, arg_min(coalesce(pr, 0.0), idx) AS r_lo
  FROM {name}_w WHERE r >= q * total GROUP BY {keys}),
{name} AS (
  SELECT {', '.join('a.' + k.strip() for k in keys.split(','))},
    CASE WHEN a.nb < 2 THEN 'nan'::DOUBLE
         WHEN a.top <> 'inf'::DOUBLE THEN 'nan'::DOUBLE
         WHEN a.total = 0 OR isnan(a.total) THEN 'nan'::DOUBLE
         WHEN p.idx = a.nb THEN a.max_finite
         WHEN p.idx = 1 AND p.le_b <= 0 THEN p.le_b
         ELSE p.lo + (p.le_b - p.lo) * ((a.q * a.total - p.r_lo) / (p.r_b - p.r_lo)) END AS value
  FROM {name}_all a LEFT JOIN {name}_pick p USING ({keys}))"""


# Canonical text of a sample's own labels: JSON entries, keys in sorted order.
SERIES_TEXT = "'[' || concat_ws(',', " + ", ".join(
    f"CASE WHEN {col} IS NOT NULL THEN '{{\"key\":\"{key}\",\"value\":\"' || {col} || '\"}}' END"
    for key, col in sorted([("alert_type", "alert_type"), ("error_type", "error_type"), ("name", "name"),
                            ("partition", "pno"), ("symbol", "symbol")])) + ") || ']'"


def _matcher_sql(matchers) -> str:
    out = []
    for key, op, val in matchers:
        out.append(f"coalesce({key}, '') {'=' if op == '=' else '<>'} '{val}'")
    return " AND ".join(out) if out else "TRUE"


def catalog_ctes(specs=ALL_SPECS) -> str:
    """CTEs ending in ``catalog(metric, by_value, t, value)`` (after samples)."""
    lab = ", ".join(LABELS)
    mapping = ", ".join(
        "('{}', '{}', {}, {}, {})".format(
            c, s, *[f"'{dict(e)[k]}'" if k in dict(e) else "NULL" for k in ("consumer", "consumergroup", "topic")])
        for c, s, e in FAMILY_SOURCES)
    parts = []
    for sp in specs:
        if sp.kind in ("rate_sum", "rate"):
            fit = "src_kind = 'rate' AND part = ''"
        elif sp.kind == "rate_mean":
            fit = "src_kind = 'rate' AND part IN ('sum', 'count')"
        elif sp.kind == "hist_q":
            fit = "src_kind = 'rate' AND part = 'bucket'"
        else:
            fit = "src_kind = 'gauge'"
        if sp.by:
            by = f"coalesce({sp.by}, '')"
        elif sp.kind in ("gauge", "rate"):
            by = f"coalesce(nullif({SERIES_TEXT}, '[]'), '')"
        else:
            by = "''"
        q = repr(sp.q) if sp.q is not None else "NULL"
        parts.append(
            f"SELECT '{sp.name}' AS metric, '{sp.kind}' AS kind, CAST({q} AS DOUBLE) AS q, {by} AS by_value, "
            f"t, le, part, value FROM kpts WHERE family = '{sp.family}' AND {fit} AND {_matcher_sql(sp.matchers)}")
    union = "\n    UNION ALL ".join(parts)
    return f"""{rate_ctes()},{asof_ctes()},
pts AS (SELECT family, part, le, {lab}, t, value, 'rate' AS src_kind FROM rates
        UNION ALL SELECT family, part, le, {lab}, t, value, 'gauge' FROM gpts),
kpts AS (
  SELECT m.cat_family AS family, p.part, p.le, {', '.join('p.' + c for c in LABELS)},
         m.consumer, m.consumergroup, m.topic, p.t, p.value, p.src_kind
  FROM pts p JOIN (VALUES {mapping}) m(cat_family, source, consumer, consumergroup, topic)
    ON p.family = m.source),
sel AS (
    {union}),
lvl1 AS (
  SELECT metric, kind, q, by_value, t, le, sum(value) AS v,
         sum(value) FILTER (WHERE part = 'sum') AS s, sum(value) FILTER (WHERE part = 'count') AS c
  FROM sel GROUP BY metric, kind, q, by_value, t, le),
hsrc AS (SELECT metric, by_value, t, q, le, v AS r FROM lvl1 WHERE kind = 'hist_q'),
{quantile_ctes('hsrc', 'metric, by_value, t', 'hq')},
catalog AS (
  SELECT metric, by_value, t,
         CASE WHEN kind = 'rate_mean' THEN CASE WHEN s IS NOT NULL AND c IS NOT NULL THEN s / c END
              ELSE v END AS value
  FROM (SELECT metric, kind, by_value, t, sum(v) AS v, sum(s) AS s, sum(c) AS c
        FROM lvl1 WHERE kind <> 'hist_q' GROUP BY metric, kind, by_value, t)
  WHERE kind <> 'rate_mean' OR (s IS NOT NULL AND c IS NOT NULL)
  UNION ALL SELECT metric, by_value, t, value FROM hq)"""
